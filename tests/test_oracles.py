"""Every registered query against its SQL in DuckDB, on the smallest test data."""

import duckdb
import pytest

import __spark_entry__ as entry
import fixtures
from shelfmark import REPORTS

ORACLE = entry.oracle_sql()
# The library's own queries; those of the text operators have their tests beside them.
QUERIES = {name: query for name, query in entry.queries().items() if name in entry.QUERIES}


@pytest.fixture(scope="module")
def duck(sf_small):
    connection = duckdb.connect()
    connection.sql("set timezone = 'UTC'")
    for name in {v.source for v in fixtures.VIEWS.values()}:
        connection.sql(f"create view {name} as select * from '{sf_small}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)
    assert set(ORACLE) <= set(entry.queries())


def check(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    expected = duck.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    places = [expected.columns.index(c) for c in columns]
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    want = sorted(repr(tuple(r[p] for p in places)) for r in expected.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck, sf_small):
    check(name, spark, duck, sf_small)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_when_nothing_is_broadcast(name, spark, duck, sf_small):
    """The way large tables are joined."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for query in (q for q in QUERIES if q.startswith(name)):
            check(query, spark, duck, sf_small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
