import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm.neighbors import Forest, _in_leaf, _merged, _pack, _unpack, fit_forest, nearest, pairs

DIM = 8


def frames(spark, rows, members):
    v = spark.createDataFrame([(*r, "clash", 1) for r in rows], "pmid bigint, embedding array<float>, leaf string, id int")
    return v, spark.createDataFrame([(m, 0) for m in members], "pmid bigint, shard int")


def brute(rows, members, k):
    x = {}
    for p, v in rows:
        if p in members and v is not None and len(v) == DIM and all(e is not None and e == e and abs(e) != float("inf") for e in v) and any(v):
            a = np.asarray(v, np.float32).astype(float)
            x[p] = a / np.linalg.norm(a)
    return {p: [q for _, q in sorted((-round(float(a @ b), 6), q) for q, b in x.items() if q != p)[:k]] for p, a in x.items()}


def clusters(n, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 20, DIM))
    return [(i, (centres[i % len(centres)] + 0.3 * rng.normal(size=DIM)).tolist()) for i in range(n)]


def lists(df):
    out = {}
    for r in df.orderBy("pmid", "rank").collect():
        out.setdefault(r.pmid, []).append(r.near)
    return out


def test_one_leaf_is_exact(spark):
    rows = clusters(200)
    want = brute(rows, set(range(150)), 5)
    got = lists(nearest(*frames(spark, rows, range(150)), k=5, dim=DIM, leaf=10_000))
    assert set(got) == set(want) and sum(len(set(got[p]) & set(want[p])) for p in want) >= 0.995 * 5 * len(want)


def test_recall_over_many_leaves(spark):
    rows = clusters(3000)
    want = brute(rows, set(range(3000)), 10)
    got = lists(nearest(*frames(spark, rows, range(3000)), k=10, dim=DIM, leaf=300))
    assert set(got) == set(want)
    assert sum(len(set(got[p]) & set(want[p])) for p in want) / 30_000 >= 0.9


def test_odd_rows(spark):
    one = [1.0] + [0.0] * (DIM - 1)
    rows = [(1, one), (1, one), (2, [2.0 * x for x in one]), (3, one), (4, None), (5, [0.0] * DIM), (6, one[:-1]), (7, [float("nan")] * DIM), (8, [None] * DIM), (None, one), (9, [-1.0 * x for x in one]), (10, [0.5] * DIM), (99, one), (11, [float("inf")] * DIM)]
    got = lists(nearest(*frames(spark, rows, [1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, None, 1234]), k=2, dim=DIM))
    assert got == {1: [2, 3], 2: [1, 3], 3: [1, 2], 9: [10, 1], 10: [1, 2]}
    assert pairs(nearest(*frames(spark, rows, [1, 2]), k=2, dim=DIM)).collect() == [(1, 2)]
    assert nearest(*frames(spark, [], [1]), k=2, dim=DIM).count() == 0
    assert nearest(*frames(spark, rows, [9]), k=2, dim=DIM).count() == 0


def test_many_equal_vectors(spark):
    rows = [(i, [1.0] * DIM) for i in range(300)] + [(1000 + i, v) for i, v in clusters(600, 3)]
    members = {p for p, _ in rows}
    want = brute(rows, members, 10)
    got = lists(nearest(*frames(spark, rows, members), k=10, dim=DIM, leaf=100_000))
    assert all(got[i] == want[i] for i in range(300))
    # cosines that hardly differ may change places
    assert sum(len(set(got[p]) & set(want[p])) for p in want) >= 0.999 * 10 * len(want)


def test_only_equal_vectors(spark):
    got = lists(nearest(*frames(spark, [(i, [1.0] * DIM) for i in range(30)], range(30)), k=3, dim=DIM))
    assert got[0] == [1, 2, 3] and got[29] == [0, 1, 2] and len(got) == 30


def test_queue_spans_all_trees():
    x = np.array([[1.0, 0.0], [0.0, 1.0], [0.9, 0.1], [0.1, 0.9]], np.float32)
    f = fit_forest(np.repeat(x, 10, axis=0), 0.3, 3)
    home, visit = f.leaves(x, 2)
    assert home.shape == (4, 3) and visit.shape == (4, 2)
    leaf = f.left == np.arange(len(f.left))
    assert leaf[home].all() and leaf[visit[visit >= 0]].all()
    single = Forest(np.zeros((1, 2), np.float32), np.zeros(1, np.float32), np.zeros(1, np.int32), np.zeros(1, np.int32), np.zeros(1, np.int32))
    assert (single.leaves(x, 1)[1] == -1).all()


def test_steps_are_small():
    x = np.random.default_rng(1).normal(size=(50, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    step, q = _unpack(pa.array(_pack(x)))
    y = q * step[:, None]
    assert np.abs(x @ x.T - y @ y.T).max() < 3e-5


@pytest.mark.parametrize("close", [900, 60])
def test_lists_of_a_leaf_are_exact_beyond_single_precision(close):
    # the cosines of the close ones lie within 1e-7, where single-precision products are equal or out of order
    rng = np.random.default_rng(2)
    q = np.hstack([np.full((900, 1), 32767), rng.integers(-6, 7, (900, DIM - 1))]).astype("<i2")
    q[close:, 1:] = rng.integers(-32767, 32768, (900 - close, DIM - 1))
    step = (1 / np.linalg.norm(q.astype(float), axis=1)).astype("<f4")
    raw = [s.tobytes() + v.tobytes() for s, v in zip(step, q)]
    ids = rng.permutation(900).astype(np.int64)
    visitor = np.arange(900) % 18 == 0
    lists = _in_leaf(pa.table({"id": ids, "visitor": visitor, "vector": pa.array(raw, pa.binary())}), 5)
    merged = next(_merged(5)([pa.RecordBatch.from_arrays([lists["id"].combine_chunks(), pa.array([[x] for x in lists["list"].to_pylist()])], ["id", "lists"])]))
    got = dict(zip(merged["id"].to_pylist(), merged["near"].to_pylist()))
    cosine = (q.astype(np.int64) @ q.astype(np.int64).T) * np.outer(step.astype(float), step.astype(float))
    wanted = {int(ids[i]): sorted((-cosine[i, j] for j in np.flatnonzero(~visitor) if j != i))[:5] for i in range(900)}
    at = {int(p): i for i, p in enumerate(ids)}
    assert set(got) == set(wanted)
    assert all(len(set(n)) == 5 and p not in n and not visitor[[at[x] for x in n]].any() for p, n in got.items())
    assert all(sorted(-cosine[at[p], at[x]] for x in n) == wanted[p] for p, n in got.items())


def test_lists_without_equal_vectors_are_not_collected_again(spark):
    rows = clusters(60) + [(100 + i, [1.0] * DIM) for i in range(4)]
    out = nearest(*frames(spark, rows, range(200)), k=3, dim=DIM)
    assert "collect_list(struct(away" not in out._jdf.queryExecution().optimizedPlan().toString()
    want = brute(rows, {p for p, _ in rows}, 3)
    got = lists(out)
    assert set(got) == set(want) and all(got[100 + i] == want[100 + i] for i in range(4))
