"""Every registered query against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_sql(spark, sf, con, key):
    assert difference(QUERIES[key](spark, sf), con, SQL[key]) is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, sf, key):
    assert QUERIES[key](spark, sf).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["split", "source", "count", "rate", "lift", "mean_qty"]
