"""Taking files of changes into the article table, each file once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import changes
from corpusmill.operators.pending import new_files
from corpusmill.session import checkpointed
from corpusmill.sources.citation_xml import basename, read_changes
from corpusmill.store import KeyedTable, Table

FIELDS = ("title", "abstract", "year", "journal")
_LEDGER = "basename string, size_bytes bigint, mtime_ns bigint"


def listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Name, size and time of the given files, as the file system tells them (contents aren't read)."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select(basename().alias("basename"), F.col("length").alias("size_bytes"), (F.unix_micros("modificationTime") * 1000).alias("mtime_ns"))


def merged(current: DataFrame | None, feed: DataFrame, order: DataFrame) -> DataFrame:
    """The articles after the feed: files in the order of their number (basename, number), within one first the upserts,
    then the deletes. Files without a number don't count.

    The present articles count as a file before all others, so one aggregation by key does all.
    """
    # a row per file of the run, whose names the driver holds anyway
    rows = feed.join(F.broadcast(order), "basename").select(F.concat(F.lit("0n"), F.col("number") + 1).alias("basename"), "ordinal", "op", "pmid", *FIELDS, F.lit(None).cast("timestamp").alias("arrived_at"))
    if current is not None:
        rows = rows.unionByName(current.select(F.lit("0n0").alias("basename"), F.col("pmid").alias("ordinal"), F.lit("insert").alias("op"), "pmid", *FIELDS, F.lit(None).cast("timestamp").alias("arrived_at")))
    return changes.apply_changes(rows, "pmid", FIELDS, trace=False)


def ingest(spark: SparkSession, root: str, paths: list[str], *, resume: bool = True, delete_scope: str = "first", on_corrupt: str = "fail", refetch: Callable[[str], None] | None = None, attempts: int = 5) -> dict[str, int]:
    """files, skipped, corrupt, refetched, upserts, deletes: what went into the articles under root.

    Files go in by path; their names tell them apart. Articles are one version per run, and the ledger follows them: a
    crash between the two takes the files in again, which changes nothing. refetch is given the path of each corrupt file and replaces it, up to attempts readings in
    all. A file that stays corrupt raises, or with on_corrupt="quarantine" is left out and stays to be taken later.
    """
    articles, ledger = KeyedTable(spark, f"{root}/articles", "pmid"), Table(spark, f"{root}/ledger")
    out = {"files": 0, "skipped": 0, "corrupt": 0, "refetched": 0, "upserts": 0, "deletes": 0}
    if not paths:
        return out
    at = {p.rpartition("/")[2]: p for p in sorted(paths)}
    wanted = listing(spark, list(at.values()))
    done = ledger.read() if ledger.exists() else None
    todo = new_files(wanted, done) if resume and done is not None else wanted
    todo = sorted(at[r["basename"]] for r in todo.select("basename").collect())
    out["skipped"] = len(paths) - len(todo)
    if not todo:
        return out
    tolerant = on_corrupt == "quarantine" or refetch is not None
    for attempt in range(1, max(1, attempts) + 1):
        feed = checkpointed(read_changes(spark, todo, delete_scope=delete_scope, on_corrupt="quarantine" if tolerant else "fail"))
        bad = {r["basename"]: r["problem"] for r in feed.filter("problem is not null").select("basename", "problem").collect()}
        if not bad or refetch is None or attempt == attempts:
            break
        for name in sorted(bad):
            refetch(at[name])
            out["refetched"] += 1
    if bad and on_corrupt != "quarantine":
        raise OSError(f"corrupt: {bad}")
    # sizes and times as they were read, after any replacement
    taken = [r for r in listing(spark, todo).collect() if r["basename"] not in bad]
    taken = sorted(taken, key=lambda r: at[r["basename"]])
    out |= {"files": len(taken), "corrupt": len(bad)}
    counts = feed.filter("problem is null").groupBy("op").count().collect()
    out |= {"upserts": sum(r["count"] for r in counts if r["op"] == "update"), "deletes": sum(r["count"] for r in counts if r["op"] == "delete")}
    if taken:
        order = spark.createDataFrame([(r["basename"], i) for i, r in enumerate(taken)], "basename string, number int")
        feed = feed.filter("problem is null")
        # only the buckets of the feed's keys are read and written again
        buckets, since = articles.touched(feed), articles.manifest()["version"]
        articles.replace(merged(articles.rows(buckets, feed.select("pmid", *FIELDS)), feed, order), buckets, since=since)
        rows = spark.createDataFrame([(r["basename"], r["size_bytes"], r["mtime_ns"]) for r in taken], _LEDGER).withColumn("ingested_at", F.current_timestamp())
        ledger.append(rows)
    return out
