"""Every registered query with a SQL twin gives the same rows as DuckDB."""

import pytest
from conftest import SF
from oracle import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

SQL = oracle_sql()

# the newest crawl of the smallest data set has no unseen object
EMPTY_AT_THIS_SCALE = {"crawl_delta"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    problem = compare(spark, con, name, SF, queries()[name], SQL.get(name))
    assert problem is None or (problem == "no rows" and name in EMPTY_AT_THIS_SCALE)


def test_sql_names_are_queries():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    rows = {r["label"]: r["n"] for r in entry(spark).collect()}
    assert set(rows) == {"cites", "repackages"} and min(rows.values()) > 0
