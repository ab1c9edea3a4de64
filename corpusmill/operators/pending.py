"""Which rows still have to be embedded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import is_eligible


def eligible(articles: DataFrame) -> DataFrame:
    """Rows with a title and an abstract of more than plain spaces."""
    return articles.filter(is_eligible("title") & is_eligible("abstract"))


def check_shard(shard: tuple[int, int] | None) -> None:
    if shard is not None and not 0 <= shard[0] < shard[1]:
        raise ValueError("a shard is (k, n) with 0 <= k < n")


def pending(articles: DataFrame, *done: DataFrame, key: str = "pmid", limit: int | None = None, shard: tuple[int, int] | None = None, after: int | None = None) -> DataFrame:
    """Eligible rows whose key is in none of the done tables.

    limit keeps the first eligible rows by key, before anything else is filtered; a negative one means no limit. shard
    (k, n) keeps keys whose remainder by n is k, with the sign of the key. after keeps larger keys. Null keys never come.
    """
    check_shard(shard)
    rows = eligible(articles).filter(F.col(key).isNotNull())
    if limit is not None and limit >= 0:
        rows = rows.orderBy(key).limit(limit)
    if after is not None:
        rows = rows.filter(F.col(key) > after)
    if shard is not None:
        rows = rows.filter(F.col(key) % shard[1] == shard[0])
    return reduce(lambda df, d: df.join(d.select(key), key, "left_anti"), done, rows)


def batch(articles: DataFrame, *done: DataFrame, size: int, key: str = "pmid", **filters) -> DataFrame:
    """The next rows by key, at least one."""
    return pending(articles, *done, key=key, **filters).orderBy(key).limit(max(1, size))


def insert_if_absent(present: DataFrame, new: DataFrame, key: str = "pmid") -> DataFrame:
    """present and those rows of new whose key it lacks, one per key."""
    added = new.select(key).filter(F.col(key).isNotNull()).distinct().join(present.select(key), key, "left_anti")
    return present.select(key).distinct().unionByName(added)


def duplicated(ids: DataFrame, key: str = "pmid", part: str = "shard") -> DataFrame:
    """Keys that occur more than once over all parts, with the number of rows and of parts."""
    return ids.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct(part).alias("parts")).filter("n > 1")


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files of the listing that the ledger doesn't have with this name, size and time."""
    return listing.join(ledger.select("basename", "size_bytes", "mtime_ns"), ["basename", "size_bytes", "mtime_ns"], "left_anti")
