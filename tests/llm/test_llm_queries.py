"""The registered queries of this part over the smallest given tables."""

import pytest

from corpusmill.llm import queries

COLUMNS = {
    "p3_found": {"pmid_a": "bigint", "pmid_b": "bigint"}, "p5_found": {"pmid": "bigint"}, "p6_found": {"pmid_a": "bigint", "pmid_b": "bigint"},
    "p7_ids": {"doc_id": "bigint", "ids": "array<int>"}, "p9_found": {"doc_id_a": "bigint", "doc_id_b": "bigint"},
}


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, small, name):
    df = queries.QUERIES[name](spark, small)
    rows = df.collect()
    assert rows
    if name in COLUMNS:
        assert dict(df.dtypes) == COLUMNS[name]
        if name != "p7_ids":
            assert len(set(rows)) == len(rows)


def test_registered():
    import __spark_entry__ as e

    assert set(queries.QUERIES) <= set(e.queries())
