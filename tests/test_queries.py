"""Every registered query of the core against its SQL, and a schema for all of them."""

import collections
from pathlib import Path

import duckdb
import pytest

from corpusmill.plans import corpus, pipeline, problems

QUERIES = corpus.QUERIES | pipeline.QUERIES | problems.QUERIES
ORACLES = corpus.ORACLES | pipeline.ORACLES | problems.ORACLES


def plain(v):
    return round(v, 6) if isinstance(v, float) else tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def sql(small):
    con = duckdb.connect()
    for p in Path(small).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, small, sql, name):
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    got = collections.Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name in ORACLES:
        cur = sql.execute(ORACLES[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == columns
        assert got == collections.Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall())
    elif not name.startswith("p4"):
        assert got


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_every_entry_is_registered():
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())
