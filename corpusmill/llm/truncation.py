"""Text values that were cut off.

A value that ends with a mark of cutting was cut; one that ends a sentence wasn't. Of the others the last token decides:

* the vocabulary of the corpus (all tokens but the last of each text) is held as a trie, a table of the proper prefixes
  of its words; a last token that is no known word but a proper prefix of one was cut (reason "prefix");
* lengths (in characters or bytes) at which unfinished values pile up are limits of a field: a value of such a length was
  cut unless its last words mostly end a sentence ("limit").

A value that was cut after a whole word, away from a limit, shows neither. It counts if a bracket or a comma is left open
("open"), or if texts hardly ever end a sentence or themselves after its last words ("context"): the trie is continued
from words to sentences, and the share of ends is counted for the last four, three or two tokens, rare words standing for
their class.

Vocabulary, contexts and lengths are counted over all texts, per task first. Only words above a share of all tokens,
whose number is bounded by that share, are sent to the tasks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import WS_CHARS, ends_in_space, rstrip
from corpusmill.operators.quality import Limits, closed_form, is_short
from corpusmill.session import checkpointed

# Stops, closing signs that may follow them, and marks of cutting.
STOPS = (".", "!", "?", "。", "！", "？")
CLOSERS = """"'»”’)]""" + WS_CHARS
MARK = (
    r"(?i)(?:\.{3,}|…|[\[(<{](?:\s*\.{2,}\s*|\s*…\s*|(?:read |see )?more|[^\[\](){}<>]{0,40}\b(?:truncat\w*|cut|cont(?:\.|inued|d)?|abridged|shortened|incomplete)(?![\w-])[^\[\](){}<>]{0,40})[\])>}])"
    + r"""["'»”’)\]\s\p{Z}.!?。]*$"""
)

#: Words above this share of all tokens are told apart in contexts; there are at most 1 / share of them.
_COMMON = 2e-4
#: Distinct keys that a task counts before it hands them on.
_FLUSH = 300_000
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
# Abbreviations whose stop ends no sentence.
_SHORT = r"(?:no|nos|vs|cf|al|fig|figs|eq|ref|refs|vol|pp|dr|st|approx|ca|e\.g|i\.e)"
_NO_END = re.compile(rf"^\W*{_SHORT}\.$", re.I)
#: Ends of a text whose stop ends no sentence: after an open bracket, or after an abbreviation that is followed by something.
_OPEN_STOP = r"[(\[][^()\[\]]{0,400}[.!?]$|(?i)(?:^|[\s(\[])(?:vs|cf|figs?|eq|refs?|vol|pp|approx|ca|e\.g|i\.e)\.$"
#: Characters at the end of a text that marks and open stops can span.
_TAIL = 600
_END = re.compile(r"""[.!?]["'»”’)\]]*$""")


def _token_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: Counter[str] = Counter()
    for batch in batches:
        for text in batch["text"]:
            seen.update(text.split()[:-1])
            if len(seen) > _FLUSH:
                yield pd.DataFrame({"token": list(seen), "n": list(seen.values())})
                seen = Counter()
    if seen:
        yield pd.DataFrame({"token": list(seen), "n": list(seen.values())})


def vocabulary(texts: DataFrame) -> DataFrame:
    """word (lower case, without signs at its ends) and n of all tokens but the last of each text."""
    word = F.lower(F.regexp_replace("token", r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    return texts.mapInPandas(_token_counts, "token string, n bigint").groupBy(word.alias("word")).agg(F.sum("n").alias("n")).filter("word <> ''")


def proper_prefixes(words: DataFrame) -> DataFrame:
    """The inner nodes of the trie of words, as prefix."""
    inner = F.expr("transform(sequence(1, length(word) - 1), i -> substring(word, 1, i))")
    return words.filter(F.length("word") > 1).select(F.explode(inner).alias("prefix")).distinct()


class _Masks:
    """Class of a raw token and whether it ends a sentence, cached."""

    def __init__(self, common: frozenset[str]):
        self.common, self.cache = common, {}

    def __call__(self, raw: str) -> tuple[str, bool]:
        found = self.cache.get(raw)
        if found is None:
            if len(self.cache) > _FLUSH:
                self.cache.clear()
            core = _EDGE.sub("", raw)
            low = core.lower()
            if low in self.common and not any(c.isdigit() for c in low):
                mask = low
            elif not core:
                mask = raw[:1]
            elif any(c.isdigit() for c in core):
                mask = "<a9>" if any(c.isalpha() for c in core) else "<9>"
            else:
                mask = "<Aa>" if core[0].isupper() else "<a>"
            found = self.cache[raw] = mask, bool(_END.search(raw)) and not _NO_END.search(raw)
        return found


def _contexts(common: frozenset[str], limits: frozenset[int], byte_limits: frozenset[int]):
    """context, total and ends of every token and the three before it in its sentence.

    The end of a text counts as an end, too, unless the text ends openly at a length that is a limit.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask = _Masks(common)
        get = mask.cache.get
        total: Counter[tuple] = Counter()
        ends: Counter[tuple] = Counter()

        def rows() -> pd.DataFrame:
            return pd.DataFrame({"context": [" ".join(k) for k in total], "total": list(total.values()), "ends": [ends[k] for k in total]})

        for batch in batches:
            for text in batch["text"]:
                a = b = c = "^"
                tokens = text.split()
                text = text.rstrip()
                for raw in tokens:
                    d, end = get(raw) or mask(raw)
                    key = (a, b, c, d)
                    total[key] += 1
                    if end:
                        ends[key] += 1
                        a = b = c = "^"
                    else:
                        a, b, c = b, c, d
                if tokens and not end and len(text) not in limits and len(text.encode()) not in byte_limits:
                    ends[key] += 1
                if len(total) > _FLUSH:
                    yield rows()
                    total.clear()
                    ends.clear()
        if total:
            yield rows()

    return run


def _finals(common: frozenset[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask = _Masks(common)
        for batch in batches:
            out = []
            for key, text, at_limit in zip(batch["id"], batch["text"], batch["at_limit"]):
                tokens = text.split()
                sentence: list[str] = []
                for raw in reversed(tokens):
                    if sentence and mask(raw)[1]:
                        break
                    sentence.insert(0, raw)
                masks = ["^", "^", "^", *(mask(t)[0] for t in sentence)][-4:]
                tail = " ".join(sentence)
                last = sentence[-1] if sentence else ""
                dangling = bool(_NO_END.match(last)) and text.endswith(STOPS) or last[-1:] in tuple(",;:(=<>-–—/+±&") or tail.count("(") > tail.count(")") or tail.count("[") > tail.count("]")
                out.append((key, at_limit, " ".join(masks), _EDGE.sub("", last).lower(), masks[-1], dangling, text.rstrip(CLOSERS).endswith(STOPS)))
            yield pd.DataFrame(out, columns=["id", "at_limit", "context", "last", "mask", "dangling", "stopped"])

    return run


def _shorter(c: Column) -> tuple[Column, Column]:
    return F.substring_index(c, " ", -3), F.substring_index(c, " ", -2)


def _limits(lengths: DataFrame, name: str) -> DataFrame:
    """Lengths at which unfinished values pile up: five more than four times the fifth largest count of the twenty around."""
    n = lengths.groupBy(name).agg(F.count_distinct("same").alias("n"))  # copies of one text are one value
    around = n.select(F.explode(F.expr(f"transform(filter(sequence(-10, 10), i -> i <> 0), i -> {name} + i)")).alias(name), F.col("n").alias("m"))
    usual = around.groupBy(name).agg(F.coalesce(F.get(F.sort_array(F.collect_list("m"), asc=False), 4), F.lit(0)).alias("usual"))
    return n.join(usual, name, "left").filter(F.col("n") >= 5 + 4 * F.coalesce("usual", F.lit(0))).select(name)


def truncated(df: DataFrame, *, key: str = "pmid", text: str = "abstract", least: int = 5, ends: float = 0.08, ends_at_limit: float = 0.5) -> DataFrame:
    """key and reason (mark, open, prefix, context or limit) of the values that were cut.

    Null and blank values, stand-ins and values of hardly any words don't count, nor does a missing final stop alone.
    least: occurrences of a context that it takes to believe its share of ends; ends and ends_at_limit: the shares of
    ends below which a value is taken as cut, elsewhere and at a length that is a limit. Repeated keys are judged each.
    """
    v, tail = F.col("text"), F.col("tail")
    raw = df.filter(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    # stripped once a row: a filter over a plain projection would be pushed below it and strip again for each mention
    once = F.transform(F.array(F.when(ends_in_space(text), rstrip(text)).otherwise(F.col(text))), lambda t: F.struct(t.alias("text"), F.right(t, F.lit(_TAIL)).alias("tail")))
    texts = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.inline_outer(once)).filter(v != "")
    stem = F.rtrim(tail, F.lit(CLOSERS))
    dots = stem.endswith("...") | stem.endswith("…")
    # what these patterns can match is at the end and shorter than that
    marked = dots | tail.rlike(MARK)
    open_end = texts.filter(~F.right(stem, F.lit(1)).isin(*STOPS) | marked | tail.rlike(_OPEN_STOP))
    # values of few words count if they carry a mark and aren't p4's
    short = is_short(v, Limits().few_words)
    open_end = open_end.filter(~short | (marked & ~closed_form(v, short)))
    open_end = checkpointed(open_end.select("id", "text", marked.alias("mark"), F.length("text").alias("chars"), F.octet_length("text").alias("bytes"), F.xxhash64("text").alias("same")))
    kind = dict(open_end.dtypes)["id"]

    words = checkpointed(vocabulary(raw))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = frozenset(r["word"] for r in words.filter(F.col("n") >= max(1.0, _COMMON * total)).select("word").toLocalIterator())

    unmarked = open_end.filter(~F.col("mark"))
    # lengths that stand out are few: each holds a fixed share more than its surroundings
    limits = [frozenset(r[0] for r in _limits(unmarked, c).select(c).toLocalIterator()) for c in ("chars", "bytes")]
    at_limit = F.lit(False)
    for c, values in zip(("chars", "bytes"), limits):
        at_limit = at_limit | F.col(c).isin(*values) if values else at_limit
    found = raw.mapInPandas(_contexts(common, *limits), "context string, total bigint, ends bigint")
    four = checkpointed(found.groupBy("context").agg(F.sum("total").alias("total"), F.sum("ends").alias("ends")))
    three_of, two_of = _shorter(F.col("context"))
    grouped = lambda c: four.groupBy(c.alias("context")).agg(F.sum("total").alias("total"), F.sum("ends").alias("ends"))
    finals = checkpointed(
        unmarked.select("id", "text", at_limit.alias("at_limit")).mapInPandas(_finals(common), f"id {kind}, at_limit boolean, context string, last string, mask string, dangling boolean, stopped boolean")
    )
    tried = finals.select("context").distinct()
    three, two = _shorter(tried["context"])
    tried = tried.select("context", three.alias("three"), two.alias("two"))
    # leave one out: the value itself is one of the ends that were counted
    own = F.when(F.col("at_limit"), 0).otherwise(1)
    share = lambda t, e: F.when(F.col(t) - 1 >= least, (F.col(e) - own) / (F.col(t) - 1))
    tried = tried.join(four.select("context", F.col("total").alias("t4"), F.col("ends").alias("e4")), "context", "left")
    tried = tried.join(grouped(three_of).select(F.col("context").alias("three"), F.col("total").alias("t3"), F.col("ends").alias("e3")), "three", "left")
    tried = tried.join(grouped(two_of).select(F.col("context").alias("two"), F.col("total").alias("t2"), F.col("ends").alias("e2")), "two", "left")

    lasts = finals.select(F.col("last").alias("word")).filter("last <> ''").distinct()
    known = lasts.join(words.select("word", F.lit(True).alias("known")), "word", "left").join(proper_prefixes(words).select(F.col("prefix").alias("word"), F.lit(True).alias("prefix")), "word", "left")
    known = known.select(F.col("word").alias("last"), F.coalesce("known", F.lit(False)).alias("known"), F.coalesce("prefix", F.lit(False)).alias("prefix"))

    judged = finals.join(tried, "context", "left").join(known, "last", "left")
    judged = judged.withColumn("ends", F.coalesce(share("t4", "e4"), share("t3", "e3"), share("t2", "e2")))
    unknown = ~F.coalesce("known", F.lit(False))
    code = F.col("mask").isin("<a9>", "<9>")
    at_limit = F.col("at_limit") & (code | unknown | F.col("ends").isNull() | (F.col("ends") < ends_at_limit))
    # trie and length first, then what they can't see: a sentence that stops after a whole word
    reason = (
        F.when(F.col("stopped"), F.when(F.col("dangling"), "open"))
        .when(unknown & F.coalesce("prefix", F.lit(False)) & ~code, "prefix")
        .when(at_limit, "limit")
        .when(F.col("dangling"), "open")
        .when(F.col("ends") < ends, "context")
    )
    cut = judged.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select("id", "reason")
    return open_end.filter("mark").select("id", F.lit("mark").alias("reason")).unionByName(cut).select(F.col("id").alias(key), "reason")


def by_source(df: DataFrame, cut: DataFrame, *, key: str = "pmid", source: str = "journal", text: str = "abstract") -> DataFrame:
    """source (trimmed, lower case, single blanks; null as its own), texts, cut and share of the values that were cut."""
    name = F.lower(F.trim(F.regexp_replace(F.col(source), r"[\s\p{Z}]+", " "))).alias(source)
    rows = df.filter(F.col(text).isNotNull()).select(F.col(key), name).join(cut.select(key, F.lit(1).alias("was_cut")).distinct(), key, "left")
    return rows.groupBy(source).agg(F.count("*").alias("texts"), F.count("was_cut").alias("cut"), F.round(F.count("was_cut") / F.count("*"), 6).alias("share"))
