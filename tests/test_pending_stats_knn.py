import numpy as np
import pytest

from corpusmill.operators import ivf, knn, pending, stats

ARTICLES = "pmid bigint, title string, abstract string, year int, journal string"


def articles(spark, rows):
    return spark.createDataFrame(rows, ARTICLES)


@pytest.fixture()
def todo(spark):
    return articles(spark, [(i, f"t{i}", f"a{i}" if i != 5 else "   ", 2020, "j") for i in range(1, 7)] + [(None, "t", "a", 1, "j")])


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "pmid bigint")


def test_pending(spark, todo):
    done = ids(spark, 2), ids(spark, 4, None)
    assert sorted(r.pmid for r in pending.pending(todo, *done).collect()) == [1, 3, 6]
    assert [r.pmid for r in pending.batch(todo, *done, size=2).collect()] == [1, 3]
    assert [r.pmid for r in pending.batch(todo, *done, size=0, after=3).collect()] == [6]
    assert sorted(r.pmid for r in pending.pending(todo, *done, limit=4, shard=(1, 2)).collect()) == [1, 3]
    assert pending.pending(todo, limit=-1).count() == 5 and pending.pending(todo, limit=0).count() == 0
    for bad in ((2, 2), (-1, 2)):
        with pytest.raises(ValueError):
            pending.pending(todo, shard=bad)


def test_negative_keys_keep_their_sign(spark):
    df = articles(spark, [(-5, "t", "a", 1, "j"), (5, "t", "a", 1, "j")])
    assert [r.pmid for r in pending.pending(df, shard=(2, 3)).collect()] == [5]


def test_ids(spark):
    assert sorted(r.pmid for r in pending.insert_if_absent(ids(spark, 1, 2), ids(spark, 2, 3, 3, None)).collect()) == [1, 2, 3]
    df = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "pmid bigint, shard int")
    assert [tuple(r) for r in pending.duplicated(df).collect()] == [(1, 2, 2)]


def test_profile(spark):
    df = articles(spark, [(1, "title one", "abstract one", 2020, "j"), (2, "  ", "abstract two", 2021, "j"), (3, None, None, None, "j")])
    assert tuple(stats.counts(df).first()) == (3, 2, 1, 1, 1)
    assert tuple(stats.word_stats(df).first())[:3] == (0, 4, 2)
    assert [r.articles for r in stats.word_histogram(df, bins=10).orderBy("bin").collect()] == [3, 0, 0, 0, 0]
    assert "unknown: 1" in stats.summary(df) and "mean 2.00" in stats.summary(df)
    empty = articles(spark, [])
    assert tuple(stats.counts(empty).first()) == (0, 0, 0, 0, 0) and tuple(stats.word_stats(empty).first()) == (0, 0, 0, 0)
    assert [r.articles for r in stats.word_histogram(empty).collect()] == [0] * 5


@pytest.mark.parametrize(("cap", "bins"), [(500, 30), (97, 7), (3, 10), (1000, 30)])
def test_bins_are_numpys(spark, cap, bins):
    v = list(range(0, cap + 40))
    got = [r[0] for r in spark.createDataFrame([(x,) for x in v], "v int").select(stats.bin_of(stats.F.col("v"), cap, bins)).collect()]
    assert np.bincount(got, minlength=bins).tolist() == np.histogram(np.minimum(v, cap), bins=bins, range=(0, cap))[0].tolist()


def vectors(spark, rows, key="pmid"):
    return spark.createDataFrame(rows, f"{key} bigint, embedding array<float>")


def brute(v, q, k):
    out = {}
    for i, x in q:
        s = sorted(((-round(float(np.dot(np.float32(x).astype(float), np.float32(y).astype(float))), 9), p) for p, y in v))[:k]
        out[i] = [p for _, p in s]
    return out


def test_top_k(spark):
    v = [(101, [1.0, 0.0]), (202, [0.0, 1.0]), (303, [0.8, 0.2]), (404, None), (505, [1.0]), (606, [float("nan"), 0.0]), (None, [9.0, 9.0]), (100, [1.0, 0.0])]
    q = vectors(spark, [(1, [1.0, 0.0]), (2, None)], "qid")
    got = knn.top_k(vectors(spark, v), q, 3).orderBy("rank").collect()
    assert [(r.pmid, r["rank"]) for r in got] == [(100, 1), (101, 2), (303, 3)]
    assert [r.pmid for r in knn.top_k(vectors(spark, v), q, 50).orderBy("rank").collect()] == [100, 101, 303, 202]
    assert [r.pmid for r in knn.top_k(vectors(spark, v), vectors(spark, [(101, [1.0, 0.0])], "qid"), 0, exclude_self=True).collect()] == [100]
    assert knn.top_k(vectors(spark, []), q, 3).count() == 0 and knn.top_k(vectors(spark, v), q.limit(0), 3).count() == 0
    hit = knn.hydrated(knn.top_k(vectors(spark, v), q, 4), articles(spark, [(202, "T", None, None, "J")])).orderBy("rank").collect()
    assert [r.title for r in hit] == [None, None, None, "T"]


def test_norms(spark):
    df = vectors(spark, [(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None)])
    assert [r[0] for r in df.select(knn.norm("embedding")).collect()] == [5.0, 0.0, None]
    assert [r[0] for r in df.select(knn.normalized("embedding")).collect()] == [[0.6, 0.8], [0.0, 0.0], None]


def test_cells(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 8))
    rows = [(i, v.tolist()) for i, v in enumerate((x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).astype(float))]
    v, q = vectors(spark, rows), vectors(spark, rows[:30], "qid")
    c = ivf.fit(v, ivf.Params(cells=12))
    index = ivf.assign(v, c).cache()
    want = brute(rows, rows[:30], 10)

    def recall(probes):
        found = {}
        for r in ivf.search(index, c, q, 10, probes).collect():
            found.setdefault(r.qid, set()).add(r.pmid)
        return sum(len(found[i] & set(p)) for i, p in want.items()) / 300

    few, half, every = recall(2), recall(6), recall(12)
    assert few <= half <= every == 1.0
    one = ivf.search(index, c, q.filter("qid = 3"), 10, 12).orderBy("rank").collect()
    assert [r.pmid for r in one] == want[3]
    assert ivf.search(index, c, q.limit(0), 10, 12).count() == 0
    with pytest.raises(ValueError):
        ivf.Params(probes=0)
    assert ivf.fit(vectors(spark, []), ivf.Params()).size == 0


def test_one_odd_query_doesnt_hide_the_others(spark):
    v = vectors(spark, [(i, [float(i), 1.0]) for i in range(5)])
    q = vectors(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0, 0.0])], "qid")
    assert {r.qid for r in knn.top_k(v, q, 2).collect()} == {1, 2}
    assert knn.dimension(v) == 2 and knn.top_k(v, q, 2, dim=3).count() == 0


def test_lists_are_kept_over_all_rows_of_a_task(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.integers(-3, 4, size=(900, 4)).astype(float))]
    v, q = vectors(spark, rows).repartition(3), vectors(spark, rows[:40], "qid")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        seen = []
        real = knn.ranked
        knn.ranked = lambda hits, *a: (seen.append(hits.count()), real(hits, *a))[1]
        got = knn.top_k(v, q, 5).collect()
    finally:
        knn.ranked = real
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert seen == [3 * 40 * 5]
    want = brute(rows, rows[:40], 5)
    assert {i: [r.pmid for r in sorted(got, key=lambda r: r["rank"]) if r.qid == i] for i in want} == want


def test_many_queries_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 4)).astype(np.float32).astype(float))]
    v, q = vectors(spark, rows), vectors(spark, rows[:90], "qid")
    want = sorted(map(tuple, knn.top_k(v, q, 4, exclude_self=True).collect()))
    monkeypatch.setattr(knn, "QUERY_BLOCK", 40)
    monkeypatch.setattr(knn, "VECTOR_BLOCK", 70)
    assert sorted(map(tuple, knn.top_k(v, q, 4, exclude_self=True).collect())) == want


def test_keys_that_are_texts(spark):
    v = spark.createDataFrame([("b", [1.0]), ("a", [1.0]), ("c", [0.5])], "pmid string, embedding array<float>")
    assert [r.pmid for r in knn.top_k(v, vectors(spark, [(1, [1.0])], "qid"), 3).orderBy("rank").collect()] == ["a", "b", "c"]


def test_cells_follow_the_data(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 8))
    x = centres[rng.integers(0, 40, 4000)] + 0.4 * rng.normal(size=(4000, 8))
    rows = [(i, v.tolist()) for i, v in enumerate((x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).astype(float))]
    v, q = vectors(spark, rows), vectors(spark, rows[::20], "qid")
    c, probes = ivf.build(v)
    assert len(c) == 8 and 1 <= probes <= 8
    index = ivf.assign(v, c).cache()
    want = brute(rows, rows[::20], 10)
    exact = {(i, p) for i, ps in want.items() for p in ps}
    found = {(r.qid, r.pmid) for r in ivf.search(index, c, q, 10, probes).collect()}
    assert len(found & exact) >= 0.95 * len(exact)
    # large cells are searched in blocks, with the same result
    assert {(r.qid, r.pmid) for r in ivf.search(index, c, q, 10, probes, block=60).collect()} == found
