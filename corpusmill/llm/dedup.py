"""Near-duplicate texts by SetSketch.

A text is the bag of its words; the k-th occurrence of a word is an element. Each register of a sketch holds the largest
value, over the elements, of an exponentially spaced, truncated rank of a random number. Sketches of parts merge by
maximum, and the chance that two registers are equal is the Jaccard similarity of the bags (up to the spacing).

1. Rows with the very same texts become one class; only its least key goes on.
2. Bands of registers are hashed; texts that share a bucket are candidates. Rows of a bucket are counted where they
   meet: one alone is dropped, and a bucket with many is split into blocks, each pair of which is a piece of work of its
   own, so that no task compares more than a fixed number of rows of one bucket with each other.
3. The last bits of registers outside the bucket's own band travel with each row. A meeting counts if enough of them are
   equal. Over all such buckets of a pair, the count of equal ones and the two sizes give the joint likelihood of the
   similarity; pairs whose best estimate lies clearly below the threshold are dropped.
4. What is left is verified by the texts, word by word, and classes are expanded.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain, count, islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import WS, strip
from corpusmill.session import checkpointed

# Bags that share four fifths of the longer one have a Jaccard similarity of two thirds at least, wherever they differ:
# sketches hold whole bags, so that this bound is theirs, too. A pair at the bound is missed with a chance of 0.016.
BANDS, ROWS = 28, 5
_REGISTERS = BANDS * ROWS
#: Spacing of the ranks, and the largest rank.
_BASE, _TOP = 1.1, 255
#: Registers of the next bands that travel with a row, in two numbers, and the last bits kept of each; the first number
#: ends with ten bits of size.
_FIRST, _SECOND, _BITS = 26, 32, 2
_EXTRA = _FIRST + _SECOND
#: Step of the sizes that travel: a size is known to one part in fifty.
_STEP = 1.02
#: Standard errors below what the least similarity leads to, down to which a meeting counts.
_SLACK = 2.0
#: Rows of one bucket that one task compares with each other at most, on average.
_BLOCK = 2_000
#: Rows up to which pairs or ids are broadcast (24 bytes each).
_BROADCAST_ROWS = 500_000
_WORD = re.compile(r"[^\W_]+")
_DOCS = 2000


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_SEEDS = _mix(np.arange(1, _REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def ranks(elements: np.ndarray) -> np.ndarray:
    """Register values (elements x registers) of 64-bit element hashes."""
    u = (_mix(elements[:, None] ^ _SEEDS) >> np.uint64(40)).astype(np.float32)
    x = np.maximum(-np.log((u + np.float32(0.5)) / np.float32(2**24)), np.float32(2**-25))
    k = np.floor(1 - np.log(x) / np.float32(np.log(_BASE)))
    return np.clip(k + 30, 0, _TOP).astype(np.uint8)


class Bags:
    """Element hashes of texts; words and register rows are cached up to a bound."""

    def __init__(self, most: int = 60_000, most_rows: int = 400_000):
        self.most, self.most_rows = most, most_rows
        self._forget()

    def _forget(self) -> None:
        self.words: defaultdict[str, int] = defaultdict(count().__next__)
        self.rows: dict[int, int] = {}
        self.hashes = np.zeros(0, np.uint64)
        self.values = np.zeros((0, _REGISTERS), np.uint8)

    def elements(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, word number and occurrence (from 0) of all elements, by text."""
        if len(self.words) > self.most or len(self.rows) > self.most_rows:
            self._forget()
        words = self.words
        lengths = [len(t) for t in texts]
        ids = np.fromiter(map(words.__getitem__, chain.from_iterable(texts)), np.int64, sum(lengths))
        if len(words) > len(self.hashes):
            new = list(islice(words, len(self.hashes), None))
            self.hashes = np.concatenate([self.hashes, pd.util.hash_array(np.array(new, object), categorize=False).astype(np.uint64)])
        doc = np.repeat(np.arange(len(texts)), lengths)
        key, n = np.unique(doc * (len(words) + 1) + ids, return_counts=True)
        occurrence = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(key // (len(words) + 1), n), np.repeat(key % (len(words) + 1), n), occurrence

    def hash(self, word: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mix(self.hashes[word] + occurrence.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def sketches(self, texts: list[list[str]]) -> np.ndarray:
        """Registers (texts x registers); no text may be empty."""
        doc, word, occurrence = self.elements(texts)
        code = (word << 32) + occurrence
        different, back = np.unique(code, return_inverse=True)
        rows = self.rows
        unseen = [c for c in different.tolist() if c not in rows]
        if unseen:
            c = np.array(unseen)
            for i, x in enumerate(unseen, len(rows)):
                rows[x] = i
            self.values = np.concatenate([self.values, ranks(self.hash(c >> 32, c & 0xFFFFFFFF))])
        at = np.array([rows[c] for c in different.tolist()], np.int64)[back]
        # one element of every text at a time, longest texts first
        n = np.bincount(doc, minlength=len(texts))
        order = np.argsort(-n, kind="stable")
        begin, still = (np.cumsum(n) - n)[order], np.searchsorted(-n[order], -np.arange(n.max()), side="left")
        s = np.zeros((len(texts), _REGISTERS), np.uint8)
        for i, rest in enumerate(still.tolist()):
            np.maximum(s[:rest], self.values[at[begin[:rest] + i]], out=s[:rest])
        out = np.empty_like(s)
        out[order] = s
        return out


def words_of(title: str | None, abstract: str | None) -> list[str]:
    """The words of both texts, without regard to case and punctuation."""
    return _WORD.findall(f"{title or ''} {abstract or ''}".lower())


def _texts(batch: pd.DataFrame) -> list[list[str]]:
    return [words_of(t, a) for t, a in zip(batch["title"], batch["abstract"])]


def _bands(min_words: int):
    """bucket, id, extra and more of every band: the last bits of registers of the next bands and the size of the text."""
    powers = np.array([pow(0x100000001B3, i, 2**64) for i in range(ROWS)], np.uint64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bags = Bags()
        for batch in batches:
            batch = batch[[len(a.split()) >= min_words for a in batch["abstract"]]]
            for begin in range(0, len(batch), _DOCS):
                part = batch.iloc[begin : begin + _DOCS]
                texts = _texts(part)
                real = [i for i, t in enumerate(texts) if t]
                if not real:
                    continue
                texts = [texts[i] for i in real]
                s = bags.sketches(texts).reshape(len(texts), BANDS, ROWS)
                with np.errstate(over="ignore"):
                    bucket = _mix((s.astype(np.uint64) * powers).sum(2, dtype=np.uint64) * np.uint64(64) + np.arange(BANDS, dtype=np.uint64)) >> np.uint64(24)
                sizes = np.rint(np.log([len(t) for t in texts]) / math.log(_STEP)).astype(np.int64)
                extra = np.repeat(sizes[:, None] << (_BITS * _FIRST), BANDS, axis=1), np.zeros((len(texts), BANDS), np.int64)
                for i in range(_EXTRA):
                    last = np.roll(s[:, :, i % ROWS], -1 - i // ROWS, axis=1).astype(np.int64) & (2**_BITS - 1)
                    np.bitwise_or(extra[i >= _FIRST], last << (_BITS * (i if i < _FIRST else i - _FIRST)), out=extra[i >= _FIRST])
                yield pd.DataFrame({"bucket": bucket.view(np.int64).ravel(), "id": np.repeat(part["id"].to_numpy()[real], BANDS), "extra": extra[0].ravel(), "more": extra[1].ravel()})

    return run


def _text_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """id and words: the words of the text, compressed."""
    for batch in batches:
        yield pd.DataFrame({"id": batch["id"], "words": [zlib.compress(" ".join(t).encode(), 1) for t in _texts(batch)]})


def likeliest(less: np.ndarray, equal: np.ndarray, more: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, bits: int | None = None) -> np.ndarray:
    """The Jaccard similarity under which these register comparisons of two bags of known sizes are most likely.

    bits: only so many last bits were compared; less and more together are the unequal ones.
    """
    grid = np.linspace(0, 1, 65)
    u, v = (n_a / (n_a + n_b))[:, None], (n_b / (n_a + n_b))[:, None]
    chance = lambda x: -np.log1p(-np.clip(x, 0, 1) * (_BASE - 1) / _BASE) / np.log(_BASE)
    j = np.minimum(grid, np.minimum(u / v, v / u))
    p_more, p_less = chance(u - v * j), chance(v - u * j)
    tiny = 1e-6
    p_equal = np.maximum(1 - p_more - p_less, tiny)
    if bits is None:
        fit = more[:, None] * np.log(p_more + tiny) + less[:, None] * np.log(p_less + tiny) + equal[:, None] * np.log(p_equal)
    else:
        p_same = p_equal + (1 - p_equal) / 2**bits
        fit = (more + less)[:, None] * np.log(1 - p_same + tiny) + equal[:, None] * np.log(p_same)
    return np.take_along_axis(j, fit.argmax(1)[:, None], 1)[:, 0]


def _meetings(bands: DataFrame, counts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What counts makes of a, ea, ma, b, eb, mb of all rows that share a bucket, each pair once per bucket and in any order.

    The rows are shuffled by bucket once. Small buckets are joined where they lie; of a large one each pair of blocks is
    joined under a key of its own.
    """
    held = bands.withColumn("n", F.count("*").over(Window.partitionBy("bucket"))).filter("n > 1")
    side = lambda df, k: df.select(*[c for c in df.columns if c not in ("id", "extra", "more", "n")], F.col("id").alias(k), F.col("extra").alias(f"e{k}"), F.col("more").alias(f"m{k}"))
    small = held.filter(F.col("n") <= _BLOCK)
    within = counts(side(small, "a").join(side(small, "b"), "bucket").filter("a < b"))
    large = held.filter(F.col("n") > _BLOCK).withColumn("of", F.ceil(F.col("n") / _BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("id"), F.col("of")).cast("int"))
    left = large.select("bucket", "id", "extra", "more", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("of") - 1)).alias("j"))
    right = large.select("bucket", "id", "extra", "more", F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"))
    across = counts(side(left, "a").join(side(right, "b"), ["bucket", "i", "j"]).filter("i < j or a < b"))
    return within.unionByName(across)


def _candidates(bands: DataFrame, share: float) -> DataFrame:
    """a < b of the pairs that share buckets and whose likeliest similarity may reach the share of the longer one."""
    size = lambda c: F.shiftright(c, _BITS * _EXTRA)

    def unequal(x: str, y: str, n: int) -> Column:
        differ = F.col(x).bitwiseXOR(F.col(y))
        differ = reduce(Column.bitwiseOR, [F.shiftrightunsigned(differ, i) for i in range(1, _BITS)], differ)
        mask = sum(1 << (_BITS * i) for i in range(n))
        return F.bit_count(differ.bitwiseAND(F.lit(mask)))

    equal = F.lit(_EXTRA) - unequal("ea", "eb", _FIRST) - unequal("ma", "mb", _SECOND)
    # chance meetings end here, before anything is shuffled
    least = share / (2 - share)
    same = least + (1 - least) / 2**_BITS
    enough = math.ceil(_EXTRA * same - _SLACK * math.sqrt(_EXTRA * same * (1 - same)))
    # sizes are rounded, each by half a step at most
    apart = math.ceil(-math.log(share) / math.log(_STEP)) + 1

    def counts(met: DataFrame) -> DataFrame:
        met = met.filter((equal >= enough) & (F.abs(size("ea") - size("eb")) <= apart))
        return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), equal.alias("equal"), F.least(size("ea"), size("eb")).alias("na"), F.greatest(size("ea"), size("eb")).alias("nb"))

    seen = _meetings(bands, counts).groupBy("a", "b").agg(F.sum("equal").alias("equal"), F.count("*").alias("bands"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    na, nb = F.pow(F.lit(_STEP), "na"), F.pow(F.lit(_STEP), "nb")

    @F.pandas_udf("double")
    def similarity(equal: pd.Series, bands: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        equal, n = equal.to_numpy(float), bands.to_numpy(float) * _EXTRA
        return pd.Series(likeliest(n - equal, equal, np.zeros(len(n)), na.to_numpy(float), nb.to_numpy(float), _BITS))

    needed = F.least(share * nb / (na + nb - share * nb), F.lit(1.0))
    # standard errors of an estimate from so many registers, of which neighbouring bands may share some
    slack = 2.5 * F.sqrt(needed * (1 - needed) / _EXTRA) * 2**_BITS / (2**_BITS - 1)
    return seen.filter(similarity("equal", "bands", na, nb) >= needed - slack).select("a", "b")


def _overlap(x: pd.Series, y: pd.Series) -> np.ndarray:
    """The shared words' part of the longer text, counted with repeats."""
    number: defaultdict[str, int] = defaultdict(count().__next__)
    found = []
    for column in (x, y):
        texts = [zlib.decompress(raw).decode().split(" ") for raw in column]
        sizes = np.array([len(t) for t in texts])
        found.append((sizes, np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, sizes.sum())))
    # how often each word stands in each text, then the lesser of both
    (keys_x, n_x), (keys_y, n_y) = (np.unique(np.repeat(np.arange(len(sizes)), sizes) * len(number) + ids, return_counts=True) for sizes, ids in found)
    both, i, j = np.intersect1d(keys_x, keys_y, assume_unique=True, return_indices=True)
    shared = np.bincount(both // len(number), np.minimum(n_x[i], n_y[j]), len(x))
    return shared / np.maximum(found[0][0], found[1][0])


def _verified(pairs: DataFrame, texts: DataFrame, share: float) -> DataFrame:
    """a, b and overlap (the shared words' part of the longer text) of the pairs that reach the share. pairs are written already."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    few = pairs.count() <= _BROADCAST_ROWS // 2
    sides = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("id"))
    packed = texts.join(F.broadcast(ids) if few else ids, "id", "left_semi").mapInPandas(_text_rows, "id bigint, words binary")
    held = packed.join(F.broadcast(sides) if few else sides, "id")
    both = held.groupBy("a", "b").agg(F.max(F.when(F.col("id") == F.col("a"), F.col("words"))).alias("x"), F.max(F.when(F.col("id") == F.col("b"), F.col("words"))).alias("y"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), _DOCS):
                part = batch.iloc[begin : begin + _DOCS]
                out = part[["a", "b"]].assign(overlap=_overlap(part["x"], part["y"]))
                yield out[out["overlap"] >= share]

    return both.filter(F.col("x").isNotNull() & F.col("y").isNotNull()).mapInPandas(run, "a bigint, b bigint, overlap double")


def similar_representatives(docs: DataFrame, *, key: str = "pmid", title: str = "title", abstract: str = "abstract", min_words: int = 40, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(pairs, copies): a < b and overlap of the class representatives that share enough words, and rep, id of all rows in
    classes of more than one.

    Texts count whose abstract has at least min_words words; rows with a null key don't. Two are similar if they share at
    least the given share of the words of the longer one, title and abstract together, counted with repeats, without
    regard to case, punctuation and order.
    """
    v = F.col("abstract")
    texts = docs.select(F.col(key).cast("bigint").alias("id"), F.col(title).alias("title"), F.col(abstract).alias("abstract")).filter(F.col("id").isNotNull() & v.isNotNull())
    same = F.concat_ws("\u0000", F.coalesce("title", F.lit("")), v)
    hashed = texts.select("id", F.xxhash64(same).alias("h1"), F.xxhash64(F.lit(1), same).alias("h2")).distinct()
    equal = hashed.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("n")).filter("n > 1")
    copies = checkpointed(hashed.join(equal, ["h1", "h2"]).select("rep", "id"))
    few = copies.count() <= _BROADCAST_ROWS
    later = copies.filter("id <> rep").select("id")
    firsts = texts.join(F.broadcast(later) if few else later, "id", "left_anti")
    # of a class all texts are long enough or none is
    reps = copies.select(F.col("rep").alias("id")).distinct()
    long = texts.join(F.broadcast(reps) if few else reps, "id", "left_semi").filter(F.size(F.split(strip(v), f"{WS}+")) >= min_words).select(F.col("id").alias("rep")).distinct()
    copies = checkpointed(copies.join(long, "rep", "left_semi"))
    bands = firsts.mapInPandas(_bands(min_words), "bucket bigint, id bigint, extra bigint, more bigint")
    pairs = checkpointed(_candidates(bands, share))
    return _verified(pairs, firsts, share), copies


def expanded(pairs: DataFrame, copies: DataFrame, *, key: str = "pmid") -> DataFrame:
    """key_a < key_b of all similar rows: pairs of representatives spread over their classes, and the pairs within classes."""
    a = copies.select(F.col("rep").alias("a"), F.col("id").alias("ia"))
    b = copies.select(F.col("rep").alias("b"), F.col("id").alias("ib"))
    spread = pairs.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ia", "a").alias("x"), F.coalesce("ib", "b").alias("y"))
    within = a.join(b.withColumnRenamed("b", "a"), "a").filter("ia < ib").select(F.col("ia").alias("x"), F.col("ib").alias("y"))
    return spread.unionByName(within).select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """id and label (the least id of its component) of all ids in the edges a, b.

    Each round takes the least label among the neighbours and then the label of that label, so chains halve; rounds end
    when nothing changes. Labels are written after every round.
    """
    both = checkpointed(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    labels = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id")
    labels = checkpointed(labels)
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("least"))
        lower = labels.join(near.withColumnRenamed("a", "id"), "id", "left").select("id", F.col("label").alias("was"), F.least("label", F.coalesce("least", "label")).alias("label"))
        jump = lower.select(F.col("id").alias("label"), F.col("label").alias("far"))
        after = checkpointed(lower.join(jump, "label", "left").select("id", "was", F.least("label", F.coalesce("far", "label")).alias("label")))
        if not after.filter("label <> was").limit(1).count():
            return after.select("id", "label")
        labels = after.select("id", "label")


def groups(pairs: DataFrame, copies: DataFrame, *, key: str = "pmid") -> DataFrame:
    """key, group (the least key of its near-duplicates, links taken on) and links (to other texts of representatives)."""
    edges = pairs.select("a", "b").unionByName(copies.filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b")))
    edges = checkpointed(edges)
    links = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("links"))
    rep = copies.select("id", "rep")
    found = components(edges).join(rep, "id", "left").withColumn("of", F.coalesce("rep", "id"))
    out = found.join(links.withColumnRenamed("id", "of"), "of", "left")
    return out.select(F.col("id").alias(key), F.col("label").alias("group"), F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))
