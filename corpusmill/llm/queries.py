"""Queries of the problems for language-model data (p3, p5 to p9) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import dedup, lookalike, neighbors, packing, tokenizer, truncation
from corpusmill.plans.tables import table

#: Capacity of a container in tokens, given by the problem.
CAPACITY = 2048


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return dedup.expanded(*dedup.similar_representatives(table(spark, d, "articles")))


def p3_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of representatives of equal texts, with the share of words."""
    pairs, _ = dedup.similar_representatives(table(spark, d, "articles"))
    return pairs.select("a", "b", F.round("overlap", 6).alias("overlap"))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    return dedup.groups(*dedup.similar_representatives(table(spark, d, "articles")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "articles")).select("pmid").distinct()


def p5_reasons(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "articles"))


def p5_journals(spark: SparkSession, d: str) -> DataFrame:
    articles = table(spark, d, "articles")
    return truncation.by_source(articles, truncation.truncated(articles))


def p6_nearest(spark: SparkSession, d: str) -> DataFrame:
    return neighbors.nearest(table(spark, d, "article_vectors"), table(spark, d, "embedded_pmids"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return neighbors.pairs(p6_nearest(spark, d))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.encode(table(spark, d, "documents"))


def p7_decoded(spark: SparkSession, d: str) -> DataFrame:
    """The texts as they come back from their ids."""
    return tokenizer.decoded(tokenizer.encode(table(spark, d, "documents")))


def p7_offsets(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.encode(table(spark, d, "documents"), offsets=True)


def p8_bins(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(tokenizer.token_counts(table(spark, d, "documents")), CAPACITY)


def p8_unsound(spark: SparkSession, d: str) -> DataFrame:
    """How many containers hold too much, and how many documents aren't made up by their pieces: none may be."""
    wrong = packing.unsound(tokenizer.token_counts(table(spark, d, "documents")), CAPACITY)
    return wrong.agg(F.count("bin_id").alias("containers"), F.count("doc_id").alias("documents"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p8_bins(spark, d), CAPACITY)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.look_alikes(table(spark, d, "documents"))


def p9_normalized(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.normalized(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "form")


def p9_groups(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.look_groups(table(spark, d, "documents"))


def p9_scripts(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.script_tokens(table(spark, d, "documents"))


QUERIES = {
    "p3_found": p3_found,
    "p3_groups": p3_groups,
    "p3_overlaps": p3_overlaps,
    "p5_found": p5_found,
    "p5_reasons": p5_reasons,
    "p5_journals": p5_journals,
    "p6_found": p6_found,
    "p6_nearest": p6_nearest,
    "p7_ids": p7_ids,
    "p7_decoded": p7_decoded,
    "p7_offsets": p7_offsets,
    "p8_bins": p8_bins,
    "p8_fill": p8_fill,
    "p8_unsound": p8_unsound,
    "p9_found": p9_found,
    "p9_normalized": p9_normalized,
    "p9_groups": p9_groups,
    "p9_scripts": p9_scripts,
}

# All pairs by their shared (word, occurrence) elements: for a small scale, where every element may meet every other.
_WORDS = """
with t as (select pmid, regexp_extract_all(lower(coalesce(title, '') || ' ' || abstract), '[\\p{L}\\p{N}]+') w,
    abstract, coalesce(title, '') title from articles where pmid is not null
    and len(list_filter(regexp_split_to_array(abstract, '[\\s\\x1c-\\x1f\\x85\\p{Z}]+'), lambda x: x <> '')) >= 40),
e as (select pmid, word, row_number() over (partition by pmid, word) k from (select pmid, unnest(w) word from t)),
n as (select pmid, len(w) n from t),
s as (select a.pmid a, b.pmid b, count(*) c from e a join e b on a.word = b.word and a.k = b.k and a.pmid < b.pmid group by all),
p as (select a, b, c / greatest(x.n, y.n) overlap from s join n x on x.pmid = a join n y on y.pmid = b where c >= 0.8 * greatest(x.n, y.n))
"""
_NEAREST = """
with m as (select distinct pmid from embedded_pmids where pmid is not null),
v as (select distinct on (pmid) pmid, list_transform(embedding::double[], lambda x: x / sqrt(list_inner_product(embedding::double[], embedding::double[]))) x
  from article_vectors semi join m using (pmid) where len(embedding) = 64 and not list_bool_or(list_transform(embedding, lambda x: x is null or isnan(x)))
  and list_inner_product(embedding::double[], embedding::double[]) > 0),
r as (select a.pmid, b.pmid near, row_number() over (partition by a.pmid order by round(list_inner_product(a.x, b.x), 12) desc, b.pmid) rank from v a join v b on a.pmid <> b.pmid)
"""

ORACLES: dict[str, str] = {
    "p3_found": _WORDS + "select a pmid_a, b pmid_b from p",
    "p3_overlaps": _WORDS + """, c as (select min(pmid) over (partition by title, abstract) rep, pmid from t)
      select a, b, round(overlap, 6) overlap from p where a in (select rep from c where rep = pmid) and b in (select rep from c where rep = pmid)""",
    "p6_found": _NEAREST + "select distinct least(pmid, near) pmid_a, greatest(pmid, near) pmid_b from r where rank <= 10",
    "p7_decoded": "select doc_id, coalesce(text, '') text from documents",
    "p8_unsound": "select 0::bigint containers, 0::bigint documents",
}
