"""Every registered query with SQL agrees with DuckDB on the smallest tables."""

import pytest
from compare import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf, con, name):
    same, note = compare(con, SQL[name], queries()[name](spark, sf))
    spark.catalog.clearCache()
    assert same, note


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1
