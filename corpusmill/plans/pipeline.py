"""Queries that run the file pipeline end to end on what Spark derives from the given tables, and their SQL."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import ingest
from corpusmill.operators.changes import file_sequence, op_kind
from corpusmill.plans.problems import CHANGES_SQL
from corpusmill.plans.tables import table
from corpusmill.session import shared_folder
from corpusmill.sources.citation_xml import parsed
from corpusmill.store import KeyedTable, VectorStore, merge_shards
from corpusmill.streaming.changes import follow

FIELDS = ("title", "abstract", "year", "journal")
#: Records of one made file, on average.
_PER_FILE = 2_000


def _scratch(spark: SparkSession) -> str:
    """A new folder in the one that the session's checkpoints share."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _xml(c: Column | str) -> Column:
    """A text as the content of an element; characters that XML doesn't have become blanks."""
    c = F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{FFFE}\x{FFFF}]", " ")
    for raw, written in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        c = F.replace(c, F.lit(raw), F.lit(written))
    return c


def _element(name: str, content: Column | str) -> Column:
    """An element, or nothing for a null content."""
    return F.coalesce(F.concat(F.lit(f"<{name}>"), content, F.lit(f"</{name}>")), F.lit(""))


def citation_files(articles: DataFrame) -> DataFrame:
    """basename and content of compressed citation files with these articles, some thousands each."""
    date = _element("JournalIssue", _element("PubDate", _element("Year", F.col("year").cast("string"))))
    article = F.concat(_element("ArticleTitle", _xml("title")), _element("Abstract", _element("AbstractText", _xml("abstract"))), _element("Journal", F.concat(_element("Title", _xml("journal")), date)))
    citation = _element("PubmedArticle", _element("MedlineCitation", F.concat(_element("PMID", F.col("pmid").cast("string")), _element("Article", article))))
    files = max(1, -(-articles.count() // _PER_FILE))
    name = F.concat(F.lit("made25n"), F.pmod(F.xxhash64("pmid"), F.lit(files)).cast("string"), F.lit(".xml.gz"))
    whole = articles.groupBy(name.alias("basename")).agg(F.array_join(F.collect_list(citation), "").alias("body"))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"basename": batch["basename"], "content": [gzip.compress(f"<?xml version='1.0'?><PubmedArticleSet>{b}</PubmedArticleSet>".encode(), 1) for b in batch["body"]]})

    return whole.mapInPandas(packed, "basename string, content binary")


def xml_articles(spark: SparkSession, d: str) -> DataFrame:
    """The articles written as citation files and read back."""
    return parsed(citation_files(table(spark, d, "articles"))).filter("op = 'update'").select("pmid", *FIELDS)


def _feed(spark: SparkSession, d: str) -> DataFrame:
    """The last delivery of every change."""
    c = table(spark, d, "article_changes").filter("pmid is not null").withColumn("kind", op_kind(F.col("op"))).filter("kind is not null")
    values = ["arrived_at", "kind", "pmid", *FIELDS]
    last = c.groupBy("basename", "ordinal").agg(F.max(F.struct(*values)).alias("c")).select("basename", "ordinal", "c.*")
    return last.withColumn("op", F.when(F.col("kind") == "d", "delete").otherwise("update"))


def ingested_state(spark: SparkSession, d: str) -> DataFrame:
    """The articles after all update files, taken as one run of the intake."""
    feed = _feed(spark, d)
    # a row per file
    names = [r["basename"] for r in feed.select("basename").distinct().orderBy(file_sequence(F.col("basename"))).collect()]
    order = spark.createDataFrame(list(zip(names, range(len(names)))), "basename string, number int")
    return ingest.merged(table(spark, d, "articles").select("pmid", *FIELDS), feed, order)


def followed_state(spark: SparkSession, d: str) -> DataFrame:
    """The change feed followed as a stream, from nothing."""
    root = _scratch(spark)
    follow(spark, f"{d}/article_changes.parquet*", f"{root}/log", f"{root}/state", f"{root}/check").awaitTermination()
    return KeyedTable(spark, f"{root}/state", "pmid").read().select("pmid", *FIELDS)


def merged_store(spark: SparkSession, d: str) -> DataFrame:
    """Vectors in three shard stores, brought together in one store; the vectors as they are read from it."""
    root, v = _scratch(spark), table(spark, d, "embeddings").select(F.col("vec_id").alias("pmid"), "embedding")
    parts = [VectorStore(spark, f"{root}/shards/{k}") for k in range(3)]
    for k, part in enumerate(parts):
        part.add(v.filter(F.pmod("pmid", F.lit(3)) == k))
    store = VectorStore(spark, root)
    merge_shards(store, [p.read() for p in parts])
    return store.read().select("pmid", F.size("embedding").alias("dim"), F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double")), 5).alias("total"))


QUERIES = {"xml_articles": xml_articles, "ingested_state": ingested_state, "followed_state": followed_state, "merged_store": merged_store}

_SQL_WS = r"[\t-\r\x1c-\x20\x85\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _sql_read(c: str) -> str:
    clean = rf"regexp_replace({c}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x{{FFFE}}\x{{FFFF}}]', ' ', 'g')"
    return f"nullif(regexp_replace({clean}, '^{_SQL_WS}+|{_SQL_WS}+$', '', 'g'), '')"


ORACLES = {
    "xml_articles": f'select pmid, {_sql_read("title")} title, {_sql_read("abstract")} abstract, "year", {_sql_read("journal")} journal from articles',
    "ingested_state": CHANGES_SQL + """,
last as (select * from seq qualify row_number() over (partition by pmid order by n desc) = 1)
select pmid, title, abstract, "year", journal from last where kind <> 'd'
union all select pmid, title, abstract, "year", journal from articles where pmid not in (select pmid from last)
""",
    "followed_state": CHANGES_SQL + """
select pmid, title, abstract, "year", journal from seq qualify row_number() over (partition by pmid order by n desc) = 1 and kind <> 'd'
""",
    "merged_store": "select vec_id pmid, len(embedding)::int dim, round(list_sum(embedding::double[]), 5) total from embeddings",
}
