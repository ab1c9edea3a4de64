"""The profile of an article table: missing texts, years, words. Nothing but finished aggregates leaves the executors."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import combined_words, is_blank


def counts(articles: DataFrame) -> DataFrame:
    """One row: total, title_missing, abstract_missing, both_missing, both_present."""
    t, a = is_blank("title"), is_blank("abstract")
    return articles.agg(
        F.count("*").alias("total"), F.count_if(t).alias("title_missing"), F.count_if(a).alias("abstract_missing"),
        F.count_if(t & a).alias("both_missing"), F.count_if(~t & ~a).alias("both_present"),
    )


def per_year(articles: DataFrame) -> DataFrame:
    """year (as text, "unknown" for null) and articles."""
    return articles.groupBy(F.coalesce(F.col("year").cast("string"), F.lit("unknown")).alias("year")).agg(F.count("*").alias("articles"))


def word_stats(articles: DataFrame) -> DataFrame:
    """One row: min, max, mean and p995 of the words of title and abstract together; 0 for an empty table.

    The percentile is exact: word counts are aggregated to one row per count first, so what it reads stays small.
    """
    w = articles.select(combined_words("title", "abstract").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return w.agg(
        zero(F.min("w")).alias("words_min"), zero(F.max("w")).alias("words_max"), F.round(zero(F.sum(F.col("w") * F.col("n")) / F.sum("n")), 6).alias("words_mean"),
        F.round(zero(F.percentile("w", 0.995, F.col("n"))), 6).alias("words_p995"),
    )


def word_cap(p995: float, given: int | None = None) -> int:
    """End of the histogram: given, or the next 50 above the percentile, 500 at least."""
    return max(1, given if given is not None else max(500, math.ceil(p995 / 50) * 50))


def bin_of(v: Column, cap: int, bins: int) -> Column:
    """Equal-width bin of a clipped value; edges are multiples of cap / bins in double precision, the last bin is closed."""
    x = F.least(v, F.lit(cap)).cast("double")
    width = float(cap) / bins
    b = F.least(F.floor(x * bins / cap), F.lit(bins - 1))
    b = F.when(x < b * width, b - 1).otherwise(b)
    upper = F.when(b + 1 == bins, F.lit(float(cap))).otherwise((b + 1) * width)
    return F.when((x >= upper) & (b != bins - 1), b + 1).otherwise(b).cast("int")


def word_histogram(articles: DataFrame, *, bins: int = 30, cap: int | None = None) -> DataFrame:
    """bin, low, high, articles: every bin of the words of title and abstract, empty ones too.

    There are no more bins than articles, five at least.
    """
    w = articles.select(combined_words("title", "abstract").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    total, p995 = w.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.percentile("w", 0.995, F.col("n")), F.lit(0.0))).first()
    cap, bins = word_cap(p995, cap), min(bins, max(5, total))
    filled = w.groupBy(bin_of(F.col("w"), cap, bins).alias("bin")).agg(F.sum("n").alias("articles"))
    all_bins = articles.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(F.broadcast(filled), "bin", "left").select(
        "bin", F.round(F.col("bin") * (float(cap) / bins), 6).alias("low"), F.round((F.col("bin") + 1) * (float(cap) / bins), 6).alias("high"), F.coalesce("articles", F.lit(0)).cast("bigint").alias("articles"),
    )


def summary(articles: DataFrame) -> str:
    """The report as text: counts, words, and years in lexical order with the unknown last."""
    c, w = counts(articles).first(), word_stats(articles).first()
    lines = [f"{name.replace('_', ' ')}: {c[name]}" for name in c.asDict()]
    lines += [f"words: min {w.words_min}, max {w.words_max}, mean {w.words_mean:.2f}, p99.5 {w.words_p995:.2f}", "articles by year:"]
    years = per_year(articles).orderBy(F.col("year") == "unknown", "year")
    return "\n".join([*lines, *(f"  {r.year}: {r.articles}" for r in years.toLocalIterator())]) + "\n"
