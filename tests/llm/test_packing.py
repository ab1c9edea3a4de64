import collections
import random

import pytest

from corpusmill.llm import packing


def check(histogram, capacity):
    slots, opened = packing.plan(histogram, capacity)
    used, ranks = collections.Counter(), collections.defaultdict(list)
    for size, lo, hi, first, each in slots:
        for r in range(lo, hi):
            ranks[size].append(r)
            used[first + (r - lo) // each] += size
    assert {s: sorted(v) for s, v in ranks.items()} == {s: list(range(n)) for s, n in histogram.items() if n}
    assert set(used) == set(range(opened)) and all(v <= capacity for v in used.values())
    return opened


def test_plans_are_sound():
    rng = random.Random(3)
    for trial in range(200):
        c = rng.choice([1, 2, 3, 10, 97, 2048])
        h = collections.Counter(rng.randint(1, c) if trial % 2 else min(c, 1 + int(rng.expovariate(6 / c))) for _ in range(rng.randint(0, 300)))
        bins, volume = check(dict(h), c), sum(s * n for s, n in h.items())
        # never worse than half full on average, bar one
        assert bins <= 2 * volume / c + 1


def test_large_items_are_matched():
    assert check({6: 2, 4: 2}, 10) == 2
    assert check({5: 3}, 10) == 2
    assert check({7: 1, 5: 1, 4: 1, 3: 1, 1: 1}, 10) == 2
    assert check({}, 10) == 0
    with pytest.raises(ValueError):
        packing.plan({11: 1}, 10)


def test_pack(spark):
    rows = [(1, 2048), (2, 5000), (3, 0), (4, None), (5, -3), (6, 1), (6, 1), (7, 4096)] + [(100 + i, 700) for i in range(50)]
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], "doc_id bigint, n_tokens bigint, bin_id string, rank int")
    got = packing.pack(df, 2048).collect()
    per_bin, per_doc = collections.Counter(), collections.defaultdict(list)
    for r in got:
        per_bin[r.bin_id] += r.n_tokens
        per_doc[r.doc_id].append((r.first_token, r.n_tokens))
    assert max(per_bin.values()) <= 2048
    assert sorted(per_doc[2]) == [(0, 2048), (2048, 2048), (4096, 904)] and sorted(per_doc[7]) == [(0, 2048), (2048, 2048)]
    assert sorted(per_doc[6]) == [(0, 1), (0, 1)] and not {3, 4, 5} & set(per_doc)
    assert all(len(per_doc[100 + i]) == 1 for i in range(50))
    report = packing.fill_report(packing.pack(df, 2048), 2048).first()
    assert report.tokens == sum(per_bin.values()) and report.bins == len(per_bin) >= report.lower_bound
    assert packing.pack(df.limit(0), 2048).count() == 0


def test_ranks_are_whole_in_hot_sizes(spark):
    df = spark.range(3000).selectExpr("id as key", "0 as piece_no", "0 as first", "if(id % 3 = 0, 5, cast(id % 50 as int) + 1) as size")
    seen = collections.defaultdict(list)
    for r in packing.ranked(df, group=50).collect():
        seen[r.size].append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in seen.values())


def test_unsound_plans_are_told(spark, monkeypatch):
    sizes = spark.createDataFrame([(1, 10), (2, 7), (3, 25), (4, None), (5, 0), (2, 7)], "doc_id bigint, n_tokens bigint")
    assert packing.unsound(sizes, 10).count() == 0
    real = packing.pack
    monkeypatch.setattr(packing, "pack", lambda *a, **k: real(*a, **k).filter("doc_id <> 1").withColumn("bin_id", packing.F.lit(0).cast("bigint")))
    got = {(r.doc_id, r.bin_id, r.n_tokens) for r in packing.unsound(sizes, 10).collect()}
    assert got == {(None, 0, 39), (1, None, 0)}
