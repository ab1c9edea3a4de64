import threading

import numpy as np
import pytest

from corpusmill import embedding as E
from corpusmill.cli import main
from corpusmill.files import Folder
from corpusmill.store import Conflict, KeyedTable, Table, VectorStore, merge_shards, shards

ARTICLES = "pmid bigint, title string, abstract string, year int, journal string"


def articles(spark, n):
    return spark.createDataFrame([(i, f"title {i}", f"text {i}", 2020, "j") for i in range(n)], ARTICLES)


def vectors(spark, *ids):
    return spark.createDataFrame([(i, [float(i), 1.0]) for i in ids], "pmid bigint, embedding array<float>")


def test_a_name_is_taken_once(spark, tmp_path):
    f = Folder(spark, f"file:{tmp_path}")
    assert f.publish("a", b"1") and not f.publish("a", b"2") and f.read("a") == b"1"
    assert f.names() == ["a"] and f.names("none") == [] and not f.exists("b")
    f.delete("a")
    assert not f.exists("a")


def test_writers_at_the_same_time_keep_all_rows(spark, tmp_path):
    root = f"file:{tmp_path}/v"
    failed = []

    def write(k):
        try:
            # ten keys of its own, and two that the next writer has as well
            VectorStore(spark, root).add(vectors(spark, *range(100 * k, 100 * k + 10), 9_000, 9_001))
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    store = VectorStore(spark, root)
    got = sorted(r.pmid for r in store.read().collect())
    assert not failed and got == sorted([100 * k + i for k in range(4) for i in range(10)] + [9_000, 9_001])
    assert store.properties()["ntotal"] == "42"


def test_each_text_is_embedded_once(spark, tmp_path):
    folder = str(tmp_path)
    store = VectorStore(spark, f"{folder}/v")

    def seeing(texts):
        with open(f"{folder}/seen", "a") as f:
            f.writelines(t + "\n" for t in texts)
        return np.ones((len(texts), 2))

    def make(_):
        with open(f"{folder}/made", "a") as f:
            f.write("x")
        return seeing

    job = {"source": "s", "model": "m", "chunk": 20}
    assert E.embed_pending(articles(spark, 100), store, make, keep_as=f"counting {folder}", **job) == 100
    seen = open(f"{folder}/seen").read().split("\n")[:-1]
    assert len(seen) == len(set(seen)) == 100
    # a model per Python worker, however many tasks there were
    assert 1 <= len(open(f"{folder}/made").read()) <= 8
    assert not [n for n in store.folder.names() if n.startswith("_")]
    assert E.embed_pending(articles(spark, 100), store, make, **job) == 0


def test_shards_at_the_same_time(spark, tmp_path, capsys):
    root = str(tmp_path)
    KeyedTable(spark, f"{root}/articles", "pmid").append(articles(spark, 60))
    go = lambda *x: main(["--data-dir", root, *x, "--model", "m"], spark)
    assert go("embed", "--merge-shards") == 1
    assert go("embed", "--shard-id", "0", "--num-shards", "3") == 0
    store = VectorStore(spark, f"{root}/vectors/m")
    assert not store.exists() and len(shards(spark, f"{root}/vectors/m/shards")) == 1
    assert go("embed", "--workers", "3", "--no-auto-merge") == 0 and not store.exists()
    assert go("embed", "--merge-shards") == 0 and "merged 60" in capsys.readouterr().out
    assert store.read().select("pmid").distinct().count() == 60 and store.properties()["embedding_source"] == "hashing"
    assert go("embed") == 0 and "embedded 0" in capsys.readouterr().out
    assert go("embed", "--workers", "0") == 2
    with pytest.raises(ValueError):
        merge_shards(VectorStore(spark, f"{root}/other"), [vectors(spark, 1), vectors(spark, 1)])


def test_buckets(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), "k", buckets=4)
    df = lambda *rows: spark.createDataFrame(list(rows), "k bigint, v string, _bucket int")
    t.append(df(*[(i, "a", 9) for i in range(40)]).drop("_bucket"))
    before = set(t.manifest()["parts"])
    change = df((3, "b", 9)).drop("_bucket")
    buckets = t.touched(change)
    rest = t.rows(buckets, change).filter("k <> 3")
    t.replace(rest.unionByName(change), buckets)
    assert len(buckets) == 1 and len(before & set(t.manifest()["parts"])) == len(before) - 1
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(i, "b" if i == 3 else "a") for i in range(40)]
    assert KeyedTable(spark, str(tmp_path / "t"), "k", buckets=99).buckets == 4
    # a version that came in between
    other = KeyedTable(spark, str(tmp_path / "t"), "k")
    real = other._write_buckets

    def late(rows):
        t.append(change)
        return real(rows)

    other._write_buckets = late
    with pytest.raises(Conflict):
        other.replace(change, buckets)
    with pytest.raises(FileNotFoundError):
        Table(spark, str(tmp_path / "none")).read()
