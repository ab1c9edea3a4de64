import datetime

from corpusmill.operators.changes import apply_changes
from corpusmill.store import Table
from corpusmill.streaming.changes import FIELDS, SCHEMA, follow, windowed_counts


def rows(n, file):
    t = datetime.datetime(2025, 1, 1)
    return [(file, i, "update" if i % 4 else "delete", i % 7, f"{file}-{i}", None, 2000 + i, "j", t + datetime.timedelta(hours=i)) for i in range(n)]


def test_stream_is_batch(spark, tmp_path):
    feed, log, state, check = (str(tmp_path / x) for x in ("feed", "log", "state", "check"))
    for files in (["u25n2"], ["u25n10", "u25n1"]):
        for f in files:
            spark.createDataFrame(rows(20, f), SCHEMA).write.mode("append").parquet(feed)
        follow(spark, feed, log, state, check).awaitTermination()
    whole = spark.read.parquet(feed)
    got = sorted(tuple(r) for r in Table(spark, state).read().collect())
    assert got == sorted(tuple(r) for r in apply_changes(whole, "pmid", FIELDS).collect()) and got
    number = Table(spark, log).properties()["batch"]
    follow(spark, feed, log, state, check).awaitTermination()
    assert Table(spark, log).properties()["batch"] == number and Table(spark, log).read().count() == 60


def test_windows(spark):
    df = spark.createDataFrame(rows(30, "u25n1"), SCHEMA).withColumn("arrived_at", __import__("pyspark").sql.functions.col("arrived_at").cast("timestamp"))
    assert sum(r.changes for r in windowed_counts(df).collect()) == 30
