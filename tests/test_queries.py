"""Every registered query against its DuckDB twin at the smallest scale."""

import pytest

import __spark_entry__ as registered

from .oracle import compare, make_duckdb

SF = "/root/testdata/sf0.001"
QUERIES = registered.registry.QUERIES
SQL = registered.registry.SQL


@pytest.fixture(scope="module")
def con():
    return make_duckdb(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem, rows = compare(spark, con, QUERIES[name], SQL.get(name), SF)
    assert problem == ""
    assert rows > 0


def test_comparison_notices_differences(spark, con):
    fn = QUERIES["l1_first_rows"]
    assert compare(spark, con, fn, "select event_id + 1 as event_id from events limit 500", SF)[0]
    assert compare(spark, con, fn, SQL["l1_first_rows"].replace("500", "499"), SF)[0]
    assert compare(spark, con, fn, "select event_id as other from events limit 500", SF)[0]


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def test_names_are_unique_and_have_sql():
    assert set(SQL) <= set(QUERIES)
    assert len(SQL) == len(QUERIES)
