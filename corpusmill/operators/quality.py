"""Column-level quality profile by character-class masks.

Every value is generalised to masks: a fine one (runs of letters, digits and blanks collapsed, other characters kept)
and a coarse one (what its length, letters, end and breaks look like). All text columns are measured in one pass, which
keeps hashes and masks and no text. Masks are counted over the whole table; dominant ones describe the column, and

* values with a rare fine mask that hold hardly a word, values with a form that is no text, values that repeat although
  their length is rare, and values outside a range, are violations;
* loads are compared by null rate, distinct values, length or position of values and the divergence of their mask
  distribution from that of the whole column, each against the spread that loads usually have.

Values under violations are left out of the comparison of loads. All statistics come from partially aggregated counts;
only what the share of a rare mask bounds, and one row per load and field, is ever joined back to values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import is_blank
from corpusmill.session import checkpointed

#: Markup and escape codes that don't belong into a plain text.
MARKUP = r"<\s*/?\s*[A-Za-z][^<>]*>|&(?:amp;)*#?[A-Za-z0-9]+;|\\[nrt\"'/]|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|%2[0-9A-F]|%3[0-9A-F]|\\[a-z]+\{|<!\[CDATA\["
#: Forms that are no text however frequent they are: no letter, an address, an identifier, a date, a stand-in.
_MONTH = r"(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
CLOSED = (
    r"(?i)^(?:[^\p{L}]*|(?:https?://|ftp://|www\.)\S+|(?:mailto:)?\S+@\S+\.\w+"
    r"|(?:doi:?\s*)?10\.\d{4,}\S*/\S+|(?:doi|pmid|pmcid|pmc|issn|isbn|nct|id)[:#\s-]*[a-z]{0,3}\d[\dx-]*|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"
    rf"|(?:{_MONTH}[ .,-]*)?\d{{1,4}}(?:st|nd|rd|th)?[ .,-]*(?:{_MONTH})?[ .,-]*\d{{0,4}}|{_MONTH}[ .,-]+\d{{1,4}}[ .,-]*\d{{0,4}}|\d{{4}}-\d\d-\d\dt[\d:.]+(?:z|[+-][\d:]+)?"
    r"|[\W_]*(?:(?:n[/.]?a\.?|unknown|null|nil|none|nan|undefined|untitled|unavailable|missing|blank|empty|tb[acd]|todo|asdf\w{0,8}|qwert\w{0,8}|title|abstract|text|test|sample|dummy|placeholder|not[ _](?:applicable|available|provided|known))[\W_]*){1,4})$"
)
#: One unit of up to 12 characters, three times or more and perhaps begun once more, over the whole value.
#: A unit starts with no separator and has a letter, digit or mark (CLOSED has what has no letter at all), so it fits in one
#: way only: the loops are possessive, which takes one pass of a long value and no stack.
_APART = r"[\s_.,;-]*+"
_UNIT = "((.)" + "(?:(.)" * 11 + ")??" * 11 + ")"
_BEGUN = "".join(rf"(?:\{i}" for i in range(2, 13)) + ")?" * 10 + ")?+"
REPEATED = rf"(?iU)^[\W_]*(?=[\W_]{{0,11}}[^\W_])(?![\s_.,;-]){_UNIT}(?:{_APART}\1){{2,}}+{_APART}{_BEGUN}[\W_]*+$"
_BEGINNING = 240


@dataclass(frozen=True)
class Limits:
    """When a value or a load stands out. Parameters, equal at every size.

    rare: share of a column's values below which a mask or a class of lengths is rare. few_words: values with at most so
    many different words are short. copies and copied: rows, and share of the column, from which a longer value of a rare
    length counts as repeated. spread: robust standard deviations of a load from the others. The rest are the least departures that
    matter: of a rate, of the share of different values, the chance that two are equal and the share of the top value, of the mean logarithm of
    lengths, of the divergence of masks, and of the mean of numbers.
    """

    rare: float = 0.02
    few_words: int = 6
    copies: int = 5
    copied: float = 0.0002
    spread: float = 8.0
    rate: float = 0.12
    distinct: float = 0.12
    length: float = 0.15
    divergence: float = 0.10
    position: float = 5.0


def fine_mask(c: Column) -> Column:
    """Letters as a, digits as 9, blanks as one space, runs collapsed, words in a row as W."""
    m = F.regexp_replace(c, r"\p{L}[\p{L}\p{M}]*", "a")
    m = F.regexp_replace(m, r"\p{N}+", "9")
    m = F.regexp_replace(m, r"[\s\x1c-\x1f\x85\p{Z}]+", " ")
    m = F.regexp_replace(m, r"([^a9 ])\1+", "$1")
    return F.regexp_replace(m, r"a(?: a)+", "W")


def distinct_words(c: Column) -> Column:
    """Different words of two letters or more."""
    return F.size(F.array_distinct(F.split(F.lower(F.regexp_replace(F.regexp_replace(c, r"[^\p{L}]+", " "), r"(?:^| )\p{L}(?= |$)|^ +| +$", "")), " +")))


def is_short(c: Column, few: int) -> Column:
    """Whether a text has at most few different words; of a long one the beginning mostly tells that it has more."""
    n = lambda x: distinct_words(x)
    # a word that is cut at the end of the beginning counts one too many at most
    return F.when(F.length(c) <= _BEGINNING, n(c) <= few).when(n(F.substring(c, 1, _BEGINNING)) > few + 1, False).otherwise(n(c) <= few)


def coarse_mask(c: Column) -> Column:
    """Length by powers of two, case, first and last character's class, breaks, other signs."""
    lower, upper, last = c == F.lower(c), c == F.upper(c), F.right(c, F.lit(1))
    return F.concat_ws(
        "|", length_class(c).cast("string"), F.when(lower & upper, "0").when(upper, "A").when(lower, "a").otherwise("Aa"), F.when(c.rlike(r"^\p{Lu}"), "A").when(c.rlike(r"^\p{L}"), "a").otherwise("-"),
        F.when(last.isin(".", "!", "?"), ".").when(last.rlike(r"[\p{L}\p{N}]"), "a").otherwise("-"), F.when(c.contains("\n"), "n").otherwise(""), F.when(c.rlike(r"[<>&\\{}|^~#]"), "s").otherwise(""),
    )


def length_class(c: Column) -> Column:
    return F.floor(F.log2(F.greatest(F.length(c), F.lit(1)).cast("double"))).cast("int")


def closed_form(c: Column, short: Column) -> Column:
    """Whether a short value has a form that is no text."""
    return F.when(short, c.rlike(CLOSED) | c.rlike(REPEATED)).otherwise(False)


def measured(df: DataFrame, fields: dict[str, bool], *, load: str, key: str | None = None, limits: Limits = Limits()) -> DataFrame:
    """field, load, key, id, size, x, form, short, mask and no_text of every value of the text columns, nulls included, written once.

    fields: the columns, and whether markup is a violation there. id is a hash of the value, size its class of lengths
    and x the logarithm of its length; mask is the fine mask of short values, no_text tells blank values, closed forms
    and markup. A column of the same name as one of these doesn't matter.
    """
    names = list(fields)
    rows = df.select(F.col(load).alias("load"), (F.col(key) if key else F.lit(None).cast("bigint")).alias("key"), *[F.col(f).alias(f"v{i}") for i, f in enumerate(names)])
    rows = rows.select("*", *[is_short(F.col(f"v{i}"), limits.few_words).alias(f"short{i}") for i in range(len(names))])

    def one(i: int) -> Column:
        v, short = F.col(f"v{i}"), F.col(f"short{i}")
        no_text = is_blank(v) | closed_form(v, short) | (v.rlike(MARKUP) if fields[names[i]] else F.lit(False))
        return F.struct(
            F.lit(names[i]).alias("field"), F.when(v.isNotNull(), F.xxhash64(v)).alias("id"), length_class(v).alias("size"), F.log(F.length(v).cast("double")).alias("x"), coarse_mask(v).alias("form"),
            short.alias("short"), F.when(short, fine_mask(v)).alias("mask"), (v.isNotNull() & no_text).alias("no_text"),
        )

    packed = rows.select("load", "key", *[one(i).alias(f"s{i}") for i in range(len(names))])
    # inline_outer, since for a plain inline the optimiser adds a filter that computes the array again
    return checkpointed(packed.select("load", "key", F.inline_outer(F.array(*[f"s{i}" for i in range(len(names))]))))


def judged(values: DataFrame, limits: Limits = Limits()) -> tuple[DataFrame, DataFrame]:
    """(suspects, others): the measured non-null values that may be violations, with bad, and all that can't be.

    Bad is a value that is no text of itself; a short one whose mask is rare in its column, unless more values of its load
    are short than a load's rate may depart by, without being no text; and a longer one that repeats, in more loads than
    one, although hardly any value of the column has such a length.
    """
    given = values.filter(F.col("id").isNotNull())
    total = F.broadcast(given.groupBy("field").agg(F.count("*").alias("total")))  # one row per column
    share = lambda by: given.groupBy("field", by).agg(F.count("*").alias("n")).join(total, "field")
    # 1 / rare masks per column at most, and a class of lengths per power of two
    usual = share("mask").filter(F.col("mask").isNotNull() & (F.col("n") >= limits.rare * F.col("total"))).select("field", "mask", F.lit(True).alias("usual"))
    odd = share("size").filter(F.col("n") < limits.rare * F.col("total")).select("field", "size", F.lit(True).alias("odd"))
    known = given.join(F.broadcast(odd), ["field", "size"], "left")
    may = F.col("short") | F.col("no_text") | F.col("odd").isNotNull()
    few = checkpointed(known.filter(may))
    loads = given.groupBy("field", "load").agg(F.count("*").alias("of"))
    short = few.filter(F.col("short") & ~F.col("no_text")).groupBy("field", "load").agg(F.count("*").alias("n")).join(loads, ["field", "load"])
    short = short.filter(F.col("n") > limits.rate * (F.col("of") + 6 * F.sqrt("of"))).select("field", "load", F.lit(True).alias("short_load"))
    copies = few.filter(~F.col("short")).groupBy("field", "id").agg(F.count("*").alias("n"), F.min("load").alias("a"), F.max("load").alias("b"))
    many = F.greatest(F.lit(limits.copies), limits.copied * F.col("total"))
    copies = copies.join(total, "field").filter((F.col("n") >= many) & (F.col("a") < F.col("b"))).select("field", "id", F.lit(True).alias("repeated"))
    joined = few.join(F.broadcast(usual), ["field", "mask"], "left").join(short, ["field", "load"], "left").join(copies, ["field", "id"], "left")
    rare = F.col("short") & F.col("usual").isNull() & F.col("short_load").isNull()
    again = ~F.col("short") & F.col("odd").isNotNull() & F.col("repeated").isNotNull()
    return checkpointed(joined.withColumn("bad", F.col("no_text") | rare | again).select(*values.columns, "bad")), known.filter(~may).select(*values.columns)


def violations(suspects: DataFrame) -> DataFrame:
    """field, load, key of the suspects that are bad."""
    return suspects.filter("bad").select("field", "load", "key")


def text_violations(df: DataFrame, field: str, *, key: str, load: str, markup: bool = False, limits: Limits = Limits()) -> DataFrame:
    """field, load, key of the non-null values that aren't texts: blank, stand-ins, or no text at all.

    A value is one if it is blank, has few different words and a closed form (a number, identifier, address, date, one
    repeated unit) or a mask that is rare in its column (unless short values are the form of its load), or repeats at a
    length that is rare in the column. markup adds values with markup or escape codes. Nulls are no violations; an empty
    table has none.
    """
    return violations(judged(measured(df, {field: markup}, load=load, key=key, limits=limits), limits)[0])


def range_violations(df: DataFrame, field: str, low: int, high: int, *, key: str, load: str) -> DataFrame:
    """field, load, key of the values outside low to high."""
    return df.filter((F.col(field) < low) | (F.col(field) > high)).select(F.lit(field).alias("field"), F.col(load).alias("load"), F.col(key).alias("key"))


def value_counts(values: DataFrame, suspects: DataFrame, others: DataFrame) -> DataFrame:
    """field, load, form, rows, n, nulls, same, most, sum_x, different of measured and judged values.

    same sums n(n-1) over equal values, most is the count of the most frequent one. Violations count in rows only.
    """
    good = others.unionByName(suspects.filter(~F.col("bad")).drop("bad"))
    equal = good.groupBy("field", "load", "id").agg(F.count("*").alias("n"), F.max("form").alias("form"), F.max("x").alias("x"))
    # rows and nulls of a load stand in a row of their own, without a form
    whole = values.groupBy("field", "load").agg(F.count("*").alias("rows"), F.count_if(F.col("id").isNull()).alias("nulls"))
    none = F.lit(0).cast("bigint")
    return _by_form(equal.withColumn("rows", none).withColumn("nulls", none)).unionByName(
        whole.select("field", "load", F.lit(None).cast("string").alias("form"), "rows", none.alias("n"), "nulls", F.lit(0.0).alias("same"), none.alias("most"), F.lit(0.0).alias("sum_x"), none.alias("different"))
    )


def text_counts(df: DataFrame, field: str, *, load: str, markup: bool = False, limits: Limits = Limits()) -> DataFrame:
    """The counts of one text column by load and coarse mask."""
    values = measured(df, {field: markup}, load=load, limits=limits)
    return value_counts(values, *judged(values, limits))


def number_counts(df: DataFrame, field: str, low: int, high: int, *, load: str, width: int = 10) -> DataFrame:
    """The same counts of an integer column; a value's form is its class of the given width, its x the value itself."""
    v = F.col("value")
    rows = df.select(F.lit(field).alias("field"), F.col(load).alias("load"), F.col(field).alias("value"))
    used = F.coalesce(v.between(low, high), F.lit(False))
    values = rows.groupBy("field", "load", F.when(used, v).alias("id")).agg(
        F.count("*").alias("rows"), F.count_if(used).alias("n"), F.count_if(v.isNull()).alias("nulls"),
        F.max(F.when(used, F.floor(v / width).cast("string"))).alias("form"), F.max(F.when(used, v.cast("double"))).alias("x"),
    )
    return _by_form(values)


def _by_form(values: DataFrame) -> DataFrame:
    n = F.col("n").cast("double")
    return values.groupBy("field", "load", "form").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.sum(n * (n - 1)).alias("same"), F.max("n").alias("most"), F.sum(n * F.col("x")).alias("sum_x"), F.count_if(n > 0).alias("different"),
    )


def load_profile(counts: DataFrame, field: str | None = None) -> DataFrame:
    """field, load, n and the measures of each load: null_rate, distinct_share, repeats, top_share, center, divergence.

    counts may hold one field or many; field narrows it to one. divergence is the Jensen-Shannon divergence (in bits) of
    the load's masks from those of the whole column.
    """
    counts = counts if field is None else counts.filter(F.col("field") == field)
    formed = counts.filter(F.col("form").isNotNull())
    whole = formed.groupBy("field", "form").agg(F.sum("n").alias("whole_n"))
    total = whole.groupBy("field").agg(F.sum("whole_n").alias("all_n"))  # one row per column
    whole = whole.join(F.broadcast(total), "field").select("field", "form", (F.col("whole_n") / F.greatest("all_n", F.lit(1))).alias("q"))
    per = counts.groupBy("field", "load").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.sum("same").alias("same"), F.max("most").alias("most"), F.sum("sum_x").alias("sum_x"), F.sum("different").alias("different"),
    )
    both = formed.select("field", "load", "form", F.col("n").alias("m"), F.sum("n").over(Window.partitionBy("field", "load")).alias("load_n")).join(whole, ["field", "form"])
    p, q = F.col("m") / F.greatest("load_n", F.lit(1)), F.col("q")
    mid = (p + q) / 2
    # forms that the load lacks add q/2 each: all of q less what is summed here
    js = both.groupBy("field", "load").agg((F.sum(F.when(p > 0, p * F.log2(p / mid)).otherwise(0.0) + q * F.log2(q / mid)) / 2 + (1 - F.sum(q)) / 2).alias("divergence"))
    n = F.col("n").cast("double")
    return per.join(js, ["field", "load"], "left").select(
        "field", "load", "rows", "n", "different", (F.col("nulls") / F.col("rows")).alias("null_rate"),
        F.when(n > 0, F.col("different") / n).alias("distinct_share"), F.when(n > 1, F.col("same") / (n * (n - 1))).alias("repeats"), F.when(n > 0, F.col("most") / n).alias("top_share"), F.when(n > 0, F.col("sum_x") / n).alias("center"), "divergence",
    )


def departures(profile: DataFrame, floors: dict[str, float], limits: Limits = Limits(), *, own: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """field, load, measure, value, usual of the loads that clearly depart from most others.

    A measure departs if it differs from the median of all loads by more than the floor, or by the given number of robust
    standard deviations where that is more, plus what chance allows a load of its size. floors hold for every field, own
    adds those of single fields. Few loads have no usual: with fewer than four nothing departs.
    """
    measures = {m: F.lit(float(x)) for m, x in floors.items()}
    for field, more in (own or {}).items():
        for m, x in more.items():
            measures[m] = F.when(F.col("field") == field, float(x)).otherwise(measures.get(m, F.lit(None).cast("double")))
    long = profile.select("field", "load", "n", "rows", F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"), x.alias("floor")) for m, x in measures.items()])))
    long = long.filter(F.col("value").isNotNull() & F.col("floor").isNotNull())
    # one row per field and measure
    usual = long.groupBy("field", "measure").agg(F.percentile("value", 0.5).alias("usual"), F.count("*").alias("loads"))
    spread = long.join(F.broadcast(usual), ["field", "measure"]).withColumn("off", F.abs(F.col("value") - F.col("usual")))
    mad = spread.groupBy("field", "measure").agg((F.percentile("off", 0.5) * 1.4826).alias("mad"))
    scale = F.when(F.col("measure") == "null_rate", F.col("rows")).otherwise(F.col("n"))
    chance = F.col("floor") * 6 / F.sqrt(F.greatest(scale, F.lit(1)).cast("double"))
    return spread.join(F.broadcast(mad), ["field", "measure"]).filter((F.col("loads") >= 4) & (F.col("off") > F.greatest(F.col("floor"), limits.spread * F.col("mad")) + chance)).select("field", "load", "measure", "value", "usual")
