"""The queries that SQL can express, against it."""

import os

import pytest

from vigilcard.llm import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data is not here")


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    duck = pytest.importorskip("duckdb").connect()
    for table in ("documents", "embeddings", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    answer = duck.execute(catalog.ORACLES[name])
    columns = sorted(d[0] for d in answer.description)
    order = [d[0] for d in answer.description]
    found = catalog.QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == columns
    got = sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr)
    assert got == sorted((tuple(r[order.index(c)] for c in columns) for r in answer.fetchall()), key=repr)
