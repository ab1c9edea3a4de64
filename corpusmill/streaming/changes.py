"""The change feed as a stream: every micro-batch goes through the same operator as the batch path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.operators.changes import apply_changes
from corpusmill.session import checkpointed
from corpusmill.store import KeyedTable, Table

SCHEMA = "basename string, ordinal bigint, op string, pmid bigint, title string, abstract string, year int, journal string, arrived_at timestamp_ntz"
FIELDS = ("title", "abstract", "year", "journal")
#: Names of files up to which a scan of the log is narrowed to them.
_FILES = 1_000


def follow(spark: SparkSession, folder: str, log_root: str, state_root: str, checkpoint: str) -> StreamingQuery:
    """Takes Parquet files of changes from a folder until none is new, keeping all changes and the state after them.

    A late change may belong before ones that were applied earlier, so the changes are kept, in buckets by key, and the
    state of the buckets that a micro-batch touches is made of the changes there. A change that is delivered again under
    another key touches the bucket of the former key, too; all deliveries of such changes are kept beside the log, since
    each bucket needs to know the last one. A batch that is delivered again after a crash is recognised by its number.
    """
    log, state, moved = KeyedTable(spark, log_root, "pmid"), KeyedTable(spark, state_root, "pmid"), Table(spark, f"{log_root}/moved")

    def take(batch: DataFrame, number: int) -> None:
        batch = checkpointed(batch)
        if int(log.properties().get("batch", -1)) < number:
            if log.exists():
                # the files of the batch are few, so the scan skips the parts that hold others
                names = [r[0] for r in batch.select("basename").distinct().limit(_FILES).collect()]
                before = log.read().filter(F.col("basename").isin(names)) if len(names) < _FILES else log.read()
                one = batch.groupBy("basename", "ordinal").agg(F.min("pmid").alias("a"), F.max("pmid").alias("b"))
                other = before.join(one, ["basename", "ordinal"]).filter((F.col("pmid") < F.col("a")) | (F.col("pmid") > F.col("b")) | (F.col("a") < F.col("b"))).select("basename", "ordinal").distinct()
                again = checkpointed(before.unionByName(batch).join(other, ["basename", "ordinal"], "left_semi").select(*batch.columns))
                if again.limit(1).count():
                    moved.append(again, {"batch": number})
            log.append(batch.filter(F.col("pmid").isNotNull()), {"batch": number})
        if int(state.properties().get("batch", -1)) < number:
            late = moved.read() if moved.exists() else batch.limit(0)
            changed = late.join(batch.select("basename", "ordinal").distinct(), ["basename", "ordinal"], "left_semi") if moved.exists() else late
            buckets = log.touched(batch.select("pmid").unionByName(changed.select("pmid")).filter(F.col("pmid").isNotNull()))
            feed = log.rows(buckets, batch).unionByName(late.select(*batch.columns))
            found = apply_changes(feed, "pmid", FIELDS).filter(state.bucket().isin(buckets))
            state.replace(found, buckets, {"batch": number})

    stream = spark.readStream.schema(SCHEMA).parquet(folder)
    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, *, time: str = "arrived_at", every: str = "1 day", late: str = "7 days") -> DataFrame:
    """Changes per operation and window of arrival, with a watermark that bounds the state."""
    kind = F.lower(F.substring(F.trim("op"), 1, 1)).alias("op")
    return stream.withWatermark(time, late).groupBy(F.window(time, every), kind).agg(F.count("*").alias("changes"))
