"""Every registered query against DuckDB on the same tables."""

import importlib

import compare
import pytest
from conftest import SF_DIR

from fleetframe import registry

entry = importlib.import_module("__spark_entry__")
# Python workers, cross joins and per-row pair loops.
FORBIDDEN = ["EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"]

QUERIES, SQL = registry.QUERIES, registry.SQL


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in FORBIDDEN if bad in plan]
    problem = compare.difference(df, duck, SQL[name])
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).columns == ["imo", "signal_timestamp", "loaddate", "click", "error", "purchase",
                                          "signup", "view"]
