import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import dedup

SCHEMA = "pmid bigint, title string, abstract string, id int, bucket string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA)


def corpus(n=150, seed=2):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(n):
        body = [rng.choice(words) for _ in range(rng.randint(45, 120))]
        rows.append((i, f"Title {rng.choice(words)}", " ".join(body)))
        for j in range(rng.choice([0, 0, 1, 2])):
            copy = body[:]
            for _ in range(rng.randint(0, len(body) // 8)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rng.shuffle(copy)
            rows.append((1000 + 10 * i + j, rows[-1][1].upper(), ", ".join(copy)))
    return rows


def overlap(a, b):
    x, y = (collections.Counter(dedup.words_of(r[1], r[2])) for r in (a, b))
    return sum((x & y).values()) / max(x.total(), y.total())


def test_against_all_pairs(spark):
    rows = corpus()
    want = {(min(a[0], b[0]), max(a[0], b[0])) for i, a in enumerate(rows) for b in rows[:i] if overlap(a, b) >= 0.8}
    pairs, copies = dedup.similar_representatives(table(spark, rows))
    got = {tuple(r) for r in dedup.expanded(pairs, copies).collect()}
    assert got <= want and len(got) >= 0.98 * len(want) > 30


def test_pairs_that_barely_reach_the_share(spark):
    rng = random.Random(7)
    content, common = [f"w{i}" for i in range(20_000)], "the of and in to with was for a is".split()
    rows, want = [], set()
    for i in range(300):
        n = rng.randint(70, 130)
        body = rng.choices(common, k=round(0.28 * n)) + rng.sample(content, n - round(0.28 * n))
        copy, kept = body[:], rng.choice([0.80, 0.80, 0.82, 0.85])
        # only words that tell something are replaced
        for j in rng.sample(range(round(0.28 * n), n), int((1 - kept) * n)):
            copy[j] = f"new{i}x{j}"
        rng.shuffle(copy)
        rows += [(2 * i, None, " ".join(body)), (2 * i + 1, None, " ".join(copy))]
        assert overlap(rows[-2], rows[-1]) >= 0.8
        want.add((2 * i, 2 * i + 1))
    got = {tuple(r) for r in dedup.expanded(*dedup.similar_representatives(table(spark, rows))).collect()}
    assert got <= want and len(got) >= 0.98 * len(want)


@pytest.mark.parametrize("edits", [0.1, 0.15, 0.19])
def test_recall_near_the_share_in_ordinary_text(spark, edits):
    rng = random.Random(round(edits * 100))
    content, common = [f"w{i}" for i in range(20_000)], "the of and in to with was for a is".split()
    rows, want = [], set()
    for i in range(400):
        body = [rng.choice(common) if rng.random() < 0.35 else rng.choice(content) for _ in range(120)]
        copy = body[:]
        for j in rng.sample(range(120), round(edits * 120)):
            copy[j] = f"new{i}x{j}"
        rows += [(2 * i, "t", " ".join(body)), (2 * i + 1, "t", " ".join(copy))]
        if overlap(rows[-2], rows[-1]) >= 0.8:
            want.add((2 * i, 2 * i + 1))
    got = {tuple(r) for r in dedup.expanded(*dedup.similar_representatives(table(spark, rows))).collect()}
    assert got <= want and len(got) >= 0.96 * len(want) and len(want) > 390


def test_large_buckets_are_split(spark, monkeypatch):
    rows = [(i, f"b{i % 3}", i * 7) for i in range(200)] + [(i, "alone" + str(i), 0) for i in range(20)]
    bands = spark.createDataFrame([(hash(b) & 0xFFFF, i, e, e) for i, b, e in rows], "bucket bigint, id bigint, extra bigint, more bigint")
    met = lambda: sorted((min(r.a, r.b), max(r.a, r.b)) for r in dedup._meetings(bands, lambda m: m.select("a", "b")).collect())
    whole = met()
    monkeypatch.setattr(dedup, "_BLOCK", 9)
    assert met() == whole and len(whole) == len(set(whole)) == sum(n * (n - 1) // 2 for n in (67, 67, 66))


def test_odd_rows_and_classes(spark):
    text = " ".join(f"word{i}" for i in range(50))
    rows = [(i, "same", text) for i in range(1, 6)] + [(6, "SAME", text.upper() + "."), (7, None, text), (8, "same", None), (9, None, None), (10, "t", ""), (11, "t", "word1 " * 39), (12, "t", "word1 " * 39), (None, "same", text), (13, "l", "deep " * 60_000), (14, "l", "deep " * 60_000 + "x"), (3, "same", text), (15, "c", "中" * 500), (16, "c", ". , ! " * 20)]
    pairs, copies = dedup.similar_representatives(table(spark, rows))
    got = {tuple(r) for r in dedup.expanded(pairs, copies).collect()}
    want = {(a, b) for a in range(1, 8) for b in range(a + 1, 8)} | {(13, 14)}
    assert got == want
    groups = {r.pmid: (r.group, r.links) for r in dedup.groups(pairs, copies).collect()}
    assert {p for p, (g, _) in groups.items() if g == 1} == set(range(1, 8)) and groups[13][0] == groups[14][0] == 13
    assert groups[4][1] == groups[1][1] == 2
    none = dedup.similar_representatives(table(spark, []))
    assert dedup.expanded(*none).count() == 0 and dedup.groups(*none).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (200, 200)]
    got = {r.id: r.label for r in dedup.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[102] == got[101] == got[100] == 100


def test_sketches_estimate_and_merge():
    rng = random.Random(0)
    bags = dedup.Bags()
    a = [f"a{i}" for i in range(400)]
    b = a[:300] + [f"b{i}" for i in range(100)]
    s = bags.sketches([a, b, a + b[300:]]).astype(int)
    assert (s[2] == np.maximum(s[0], s[1])).all()
    shuffled = a[:]
    rng.shuffle(shuffled)
    assert (bags.sketches([shuffled])[0] == s[0]).all()
    less, equal = (s[0] < s[1]).sum(), (s[0] == s[1]).sum()
    j = dedup.likeliest(*(np.array([float(x)]) for x in (less, equal, s.shape[1] - less - equal, 400, 400)))[0]
    assert abs(j - 0.6) < 0.12
    assert (bags.sketches([["the", "of"]]) > 0).any()


def test_forgetting_changes_nothing():
    small, large = dedup.Bags(most=60), dedup.Bags()
    texts = [[f"w{i}" for i in range(k, k + 50)] for k in range(0, 300, 10)]
    for t in texts:
        assert (small.sketches([t]) == large.sketches([t])).all()
