"""Bringing text that looks alike into one form.

Every character stands for a look: width, kind of blank, ligature and way of writing an accent are undone, invisible
characters are dropped, and letters or signs that can't be told apart get one prototype. A look can be written in some
scripts. For each token (a run of letters, marks and joining signs) the sets of scripts that its looks allow are
intersected:

* it holds scripts: the token is spelt in the first of them in the order of SCRIPTS (a single-script token stays as it
  is unless another script can spell all of it: a whole-script confusable);
* it is empty: every look is spelt in the first script that has it.

The spelling is a function of the looks alone. So two texts have the same form exactly if they have the same looks.
script_kind tells single, mixed and whole-script tokens apart. Characters are exchanged by one table per worker, tokens
are looked at only if they aren't plain ASCII then.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import checkpointed

SCRIPTS = ("Latin", "Cyrillic", "Greek", "Armenian", "Cherokee", "Lisu")

# Letters that look alike, a line per script: each letter stands under what it looks like in the first line,
# "." where a script has none.
LETTERS = [
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyzäëïö",
    "АВС.Е.ԌНІЈК.М.ОРԚ.ЅТ.ѴԜХҮ.а.сԁе..һіј.ӏ..орԛ.ѕ..ѵԝху.ӓёїӧ",
    "ΑΒϹ.ΕϜ.ΗΙͿΚ.ΜΝΟΡ...Τ...ΧΥΖα.ϲ.....ιϳ....ορ....υν......ϊ.",
    "...........Լ..Օ...Տ.Ս...........ցհ.յ...ոօ.զ...ս.........",
    "ᎪᏴᏟᎠᎬ.ᏀᎻ.ᎫᏦᏞᎷ..Ꮲ.ᎡᏚᎢ.ᏙᎳ..Ꮓ..............................",
    "ꓮꓐꓚꓓꓰꓝꓖꓧꓲꓙꓗꓡꓟꓠꓳꓑ.ꓣꓢꓔꓴꓦꓪꓫꓬꓜ..............................",
]
#: Letters that look alike in scripts other than Latin only.
NOT_LATIN = ["...", "ГПФ", "ΓΠΦ"]


# Signs that look alike; the first of each is the form.
SIGNS = [
    "-‐‑−﹣",
    "'’‘ʼ＇′",
    '"“”„″',
    "µμ",
    "·∙⋅•",
    "/∕⁄",
    ":∶ː",
    "~∼˜",
    "*∗",
    "|∣ǀ",
    ",‚",
    "<‹",
    ">›",
    "×✕",
    "°˚",
    "–‒",
]

# Characters beyond letters' compatibility forms that stand for several others.
JOINED = {"…": "...", "‥": "..", "℃": "°C", "℉": "°F", "№": "No", "Å": "Å", "Ω": "Ω", "K": "K"}

#: Ways of decomposition that don't change the look; raised, lowered, circled and fraction forms do.
_SAME_LOOK = ("<wide>", "<narrow>", "<compat>", "<noBreak>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>")

#: Code points without any look, as ranges: soft hyphen, joiners and marks of direction, variation selectors, fillers, tags.
_INVISIBLE = [(0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF)]

_ROWS = [tuple(c if c != "." else "" for c in column) for columns in (zip(*LETTERS, strict=True), zip(*NOT_LATIN, strict=True)) for column in columns]
_LOOK = {c: i for i, row in enumerate(_ROWS) for c in row if c}
_SPELL = {(i, s): c for i, row in enumerate(_ROWS) for s, c in zip(SCRIPTS, row) if c}
_SIGN = {c: row[0] for row in SIGNS for c in row[1:]}
# a token: letters, and the accents on them that have no composed form
_WORD = re.compile("[^\\W\\d_]+(?:[\u0300-\u036f\u0483-\u0489\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff]+[^\\W\\d_]*)*")


class _Plain(dict):
    """For str.translate: code points and what stands for them, found once each."""

    def __missing__(self, cp: int) -> str:
        self[cp] = found = _plain(chr(cp))
        return found


_TABLE = _Plain()


def _plain(ch: str) -> str:
    """A character without what doesn't change its look, apart from look-alike letters."""
    cp = ord(ch)
    if any(a <= cp <= b for a, b in _INVISIBLE):
        return ""
    if ch in JOINED:
        return JOINED[ch]
    if ch in _SIGN:
        return _SIGN[ch]
    if unicodedata.category(ch) == "Zs":
        return " "
    kind, _, points = unicodedata.decomposition(ch).partition(" ")
    if kind in _SAME_LOOK:
        parts = [chr(int(p, 16)) for p in points.split()]
        # a spacing accent stays one sign
        return ch if parts[0] == " " else "".join(map(_plain, parts))
    return ch


@lru_cache(maxsize=100_000)
def _script(ch: str) -> str:
    name = unicodedata.name(ch, "")
    return next((s for s in SCRIPTS if name.startswith(s.upper())), "Common" if not ch.isalpha() else "Other")


@lru_cache(maxsize=200_000)
def _spelling(token: str) -> str:
    """A token of letters in its one spelling."""
    looks = [_LOOK.get(c) for c in token]
    allowed = set(SCRIPTS)
    for c, look in zip(token, looks):
        if look is not None:
            allowed &= {s for s in SCRIPTS if (look, s) in _SPELL}
        elif (own := _script(c)) in SCRIPTS:
            allowed &= {own}
    order = [s for s in SCRIPTS if s in allowed] or list(SCRIPTS)
    return "".join(c if look is None else next(_SPELL[look, s] for s in (*order, *SCRIPTS) if (look, s) in _SPELL) for c, look in zip(token, looks))


def script_kind(token: str) -> str:
    """single, mixed or whole (written in one script but spellable in another): what a check of scripts says of a token."""
    own = {_script(c) for c in token} & set(SCRIPTS)
    if len(own) > 1:
        return "mixed"
    return "whole" if own and own != {"Latin"} and _token(token) != token else "single"


def normalize(text: str) -> str:
    """The one form of all texts that look like this one. Case, accents, raised digits and line breaks stay."""
    if text.isascii():
        return text
    plain = unicodedata.normalize("NFC", text.translate(_TABLE))
    if plain.isascii():
        return plain
    # composed letters may hide look-alikes (an accent on a Cyrillic base), so the letters are compared decomposed
    spelt = _WORD.sub(lambda m: m[0] if m[0].isascii() else _token(m[0]), plain)
    return unicodedata.normalize("NFC", spelt)


@lru_cache(maxsize=200_000)
def _token(token: str) -> str:
    parts: list[list[str]] = []
    for ch in token:
        if ch in _LOOK:
            parts.append([ch, ""])
            continue
        d = unicodedata.normalize("NFD", ch)
        parts.append([d[0], d[1:]] if len(d) > 1 and d[0] in _LOOK else [ch, ""])
    bases = _spelling("".join(p[0] for p in parts))
    return "".join(b + marks for b, (_, marks) in zip(bases, parts))


def normalized(df: DataFrame, *, text: str = "text", to: str = "form") -> DataFrame:
    """df with the form of its text in another column. Null stays null, empty stays empty; other columns aren't read."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: normalize(t) if isinstance(t, str) else None)

    # plain ASCII is its own form and never leaves the JVM
    needs = df[text].rlike(r"[^\x00-\x7f]")
    return df.withColumn(to, F.when(needs, run(F.when(needs, df[text]))).otherwise(df[text]))


def look_classes(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, look_id, text_id of the texts that aren't blank: equal looks share look_id, equal texts text_id.

    The ids are pairs of 64-bit hashes, so that no text is shuffled.
    """
    rows = normalized(df.select(df[key].alias("key"), df[text].alias("text")), text="text", to="form").filter(F.trim(F.col("form")).rlike(r"[^\s\p{Z}]"))
    two = lambda c: F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit(1), c).alias("b"))
    return rows.select(F.col("key").alias(key), two(F.col("form")).alias("look_id"), two(F.col("text")).alias("text_id"))


def look_alikes(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key_a < key_b of all rows whose texts look the same but differ in a character.

    Looks that are written in one way only are dropped in an aggregation first; texts are then paired once per pair of
    spellings and expanded by their rows. Null, empty and blank texts are in no pair.
    """
    rows = checkpointed(look_classes(df, key=key, text=text))  # two hashes a row; texts are normalised once
    spelt = rows.groupBy("look_id").agg(F.min("text_id").alias("least"), F.max("text_id").alias("most")).filter(F.col("least") != F.col("most"))
    kept = rows.join(spelt.select("look_id"), "look_id", "left_semi")
    # pairs of spellings first: many copies of one spelling never meet each other
    ways = kept.select("look_id", "text_id").distinct()
    met = ways.withColumnRenamed("text_id", "ta").join(ways.withColumnRenamed("text_id", "tb"), "look_id").filter(F.col("ta") < F.col("tb"))
    side = lambda t, k: kept.select("look_id", F.col("text_id").alias(t), F.col(key).alias(k))
    both = met.join(side("ta", "x"), ["look_id", "ta"]).join(side("tb", "y"), ["look_id", "tb"]).filter(F.col("x") != F.col("y"))
    return both.select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b")).distinct()


def look_groups(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, look (the least key with the same look), members, spellings and links of all texts that aren't blank.

    members are the rows of a look, spellings its different texts and links the members that are spelt in another way.
    Spellings are counted before they are joined back, so that a look with a third of all rows is one row there.
    """
    rows = checkpointed(look_classes(df, key=key, text=text))
    ways = rows.groupBy("look_id", "text_id").agg(F.count("*").alias("same"), F.min(key).alias("least"))
    looks = ways.groupBy("look_id").agg(F.min("least").alias("look"), F.sum("same").alias("members"), F.count("*").alias("spellings"))
    out = rows.join(ways.drop("least"), ["look_id", "text_id"]).join(looks, "look_id")
    return out.select(key, "look", "members", "spellings", (F.col("members") - F.col("same")).alias("links"))


def script_tokens(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, mixed and whole: how many tokens of a text mix scripts, or are written in one script but spellable in another.

    Texts without such tokens give no row.
    """

    @F.pandas_udf("mixed int, whole int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            kinds = [[script_kind(t) for t in _WORD.findall(unicodedata.normalize("NFC", x.translate(_TABLE))) if not t.isascii()] for x in texts]
            yield pd.DataFrame({k: [found.count(k) for found in kinds] for k in ("mixed", "whole")})

    rows = df.select(df[key].alias("key"), df[text].alias("text")).filter(F.col("text").rlike(r"[^\x00-\x7f]"))
    found = rows.select("key", run("text").alias("n")).select(F.col("key").alias(key), "n.mixed", "n.whole")
    return found.filter((F.col("mixed") > 0) | (F.col("whole") > 0))
