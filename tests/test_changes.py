import datetime
import random

import pytest

from corpusmill.operators.changes import apply_changes

SCHEMA = "basename string, ordinal bigint, op string, pmid bigint, title string, year int, arrived_at timestamp, _key string, _f0 int, n int"


def feed(spark, rows):
    t = datetime.datetime(2025, 1, 1)
    return spark.createDataFrame([(b, o, op, p, ti, y, None if at is None else t + datetime.timedelta(hours=at), "clash", 1, 2) for b, o, op, p, ti, y, at in rows], SCHEMA)


def state(spark, rows, **more):
    return {r.pmid: (r.title, r.year) for r in apply_changes(feed(spark, rows), "pmid", ["title", "year"], **more).collect()}


def test_files_go_by_number_and_deletes_come_last(spark):
    rows = [
        ("update25n10.xml.gz", 0, "insert", 1, "ten", 1, 1),
        ("update25n9.xml.gz", 0, "insert", 1, "nine", 2, 9),
        ("update25n1.xml.gz", 0, "delete", 2, None, None, 1),
        ("update25n1.xml.gz", 5, " Upd", 2, "late in the file", 3, 1),
        ("update25n2.xml.gz", 0, "DEL ", 3, None, None, 1),
        ("update26n1.xml.gz", 0, "INSERT", 3, "again", 4, 0),
    ]
    assert state(spark, rows) == {1: ("ten", 1), 3: ("again", 4)}


def test_copies_count_once_by_arrival(spark):
    rows = [("u25n1", 0, "insert", 1, "old", 1, 1), ("u25n1", 0, "delete", 1, None, None, 2), ("u25n1", 1, "insert", 2, "x", 1, 1), ("u25n1", 1, "insert", 2, "x", 1, 1)]
    assert state(spark, rows) == {2: ("x", 1)}


def test_replace_sets_nulls_and_patch_does_not(spark):
    rows = [("u25n1", 0, "insert", 1, "a", 2000, 1), ("u25n2", 0, "update", 1, None, 2001, 1), ("u25n3", 0, "insert", 2, "b", None, 1), ("u25n4", 0, "delete", 2, None, None, 1), ("u25n5", 0, "update", 2, None, 7, 1)]
    assert state(spark, rows) == {1: (None, 2001), 2: (None, 7)}
    assert state(spark, rows, update="patch") == {1: ("a", 2001), 2: (None, 7)}


def test_odd_rows(spark):
    rows = [(None, None, "insert", 1, "no file", 1, None), ("u25n1", 0, "insert", None, "no key", 1, 1), ("u25n1", 1, None, 2, "no op", 1, 1), ("u25n1", 2, "", 2, "no op", 1, 1), ("u25n1", 3, "merge", 2, "no op", 1, 1), ("notes", 4, "insert", 3, "é" * 50_000, None, 1)]
    assert state(spark, rows) == {1: ("no file", 1), 3: ("é" * 50_000, None)}
    assert state(spark, []) == {}
    with pytest.raises(ValueError):
        apply_changes(feed(spark, []), "pmid", [], update="merge")


@pytest.mark.parametrize("mode", ["replace", "patch"])
def test_against_a_loop(spark, mode):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        rows.append((f"u{rng.randint(24, 26)}n{rng.randint(1, 12)}", rng.randint(0, 30), rng.choice(["i", "u", "u", "u", "d"]), 1 if i % 3 == 0 else rng.randint(1, 15), rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2]), i))
    last = {}
    for r in rows:
        if (r[0], r[1]) not in last or r[6] > last[r[0], r[1]][6]:
            last[r[0], r[1]] = r
    number = lambda r: tuple(map(int, r[0][1:].split("n")))
    want = {}
    for r in sorted(last.values(), key=lambda r: (number(r), r[2] == "d", r[1])):
        if r[2] == "d":
            want.pop(r[3], None)
        elif mode == "replace" or r[2] == "i":
            want[r[3]] = (r[4], r[5])
        else:
            old = want.get(r[3], (None, None))
            want[r[3]] = (r[4] if r[4] is not None else old[0], r[5] if r[5] is not None else old[1])
    assert state(spark, rows, update=mode) == want
