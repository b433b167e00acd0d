"""Every registered query runs; those with an SQL twin give exactly its rows."""

import pytest

import __spark_entry__ as entry_module
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    assert compare(spark, duck, QUERIES[name], SQL[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and df.count() > 0


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert rows and [r["excess"] for r in rows] == sorted((r["excess"] for r in rows), reverse=True)
