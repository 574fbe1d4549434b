"""Every registered query against its SQL equivalent at the smallest scale."""

import os

import pytest

from vigilcard import catalog, oracles

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}
QUERIES, ORACLES = catalog.QUERIES, oracles.statements()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data is not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    answer = duck.execute(ORACLES[name])
    types = {d[0]: str(d[1]) for d in answer.description}
    order = [d[0] for d in answer.description]
    columns = sorted(df.columns)
    assert columns == sorted(order)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    got = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
    wanted = sorted((tuple(row[order.index(c)] for c in columns) for row in answer.fetchall()), key=repr)
    assert got == wanted


def test_entry_gives_alerts(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())
