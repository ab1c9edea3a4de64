"""Text expressions; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space that Unicode-aware strip() and split() know, as a Java character class.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
#: The same as single characters: trimming them looks at the ends of a text only.
WS_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(_col(c), F.lit(WS_CHARS))


def rstrip(c: Column | str) -> Column:
    return F.rtrim(_col(c), F.lit(WS_CHARS))


def ends_in_space(c: Column | str) -> Column:
    """Whether the last character is white space; tells cheaply that there is nothing to strip from most texts."""
    return F.right(_col(c), F.lit(1)).isin(*WS_CHARS)


def is_blank(c: Column | str) -> Column:
    """Null, or nothing but white space of any kind: the profile's notion of a missing value."""
    c = _col(c)
    # trimming looks at every character of a text, so only those are trimmed that begin with a blank
    return c.isNull() | (c == "") | (F.left(c, F.lit(1)).isin(*WS_CHARS) & (strip(c) == ""))


def is_eligible(c: Column | str) -> Column:
    """Neither null nor only U+0020: the embedding step's notion, which lets a tab pass."""
    return _col(c).isNotNull() & (F.trim(_col(c)) != "")


def combined_words(title: Column | str, abstract: Column | str) -> Column:
    """Words of both texts together; 0 if both are blank."""
    parts = F.array(strip(title), strip(abstract))
    joined = F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), " ")
    return F.when(joined == "", F.lit(0)).otherwise(F.size(F.split(joined, f"{WS}+")))


def sanitized(c: Column | str) -> Column:
    """Without NUL characters, stripped."""
    return strip(F.regexp_replace(_col(c), "\\x00", ""))


def clipped(c: Column | str, max_chars: int | None) -> Column:
    """Sanitized, then cut to max_chars code points if that is given."""
    return sanitized(c) if max_chars is None else F.substring(sanitized(c), 1, max_chars)


def prompt(title: Column | str, abstract: Column | str, max_chars: int | None = None) -> Column:
    """What is embedded: both texts, stripped, with a space between."""
    return clipped(F.concat_ws(" ", strip(title), strip(abstract)), max_chars)


def preview(c: Column | str, n: int) -> Column:
    """At most n characters of the text on one line, cut at a word if that loses little, with "..." at the end if cut.

    Null for a null text and for n < 1. White space is collapsed first. n <= 3 leaves no room for the dots.
    """
    if n < 1:
        return F.lit(None).cast("string")
    flat = F.array_join(F.filter(F.split(_col(c), f"{WS}+"), lambda x: x != ""), " ")
    if n <= 3:
        return F.substring(flat, 1, n)
    head = rstrip(F.substring(flat, 1, n - 3))
    tail = F.substring_index(head, " ", -1)
    before = F.substring(head, F.lit(1), F.length(head) - F.length(tail) - 1)
    at_word = (F.instr(head, " ") > 0) & (before != "") & (F.length(tail) < max(8, n // 4))
    return F.when(F.length(flat) <= n, flat).otherwise(F.concat(F.when(at_word, before).otherwise(head), F.lit("...")))


def year_in(c: Column | str) -> Column:
    """The first year of 1900 to 2099 that stands alone in a text, or null."""
    found = F.regexp_extract(_col(c), r"\b(?:19|20)\d{2}\b", 0)
    return F.when(found != "", found.cast("int"))


def slug(c: Column | str, default: str = "model") -> Column:
    """A name for folders: other characters become hyphens, none at the ends, lower case."""
    s = F.lower(F.regexp_replace(F.regexp_replace(_col(c), "[^a-zA-Z0-9._-]+", "-"), "^-+|-+$", ""))
    return F.when(s == "", F.lit(default)).otherwise(s)
