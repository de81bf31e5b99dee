"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry_points
import compare
from tidemark.checks.oracle import ORACLE
from tidemark.checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")

# One-row scalar subqueries are fine; pairs of whole inputs or Python in the hot path are not.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    problem, _, _ = compare.compare(
        spark, con, name, QUERIES[name], ORACLE[name], FOLDER
    )
    assert problem is None, problem


@pytest.mark.parametrize("name", ["trending", "lead_lag", "hourly_merged", "cross_language_events", "headline_totals"])
def test_plan_shape(spark, name):
    df = entry_points.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in UNWANTED if op in plan]


def test_day_filters_reach_the_scan(spark):
    df = entry_points.queries()["hourly_edits"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(ts" in scan or "In(event_type" in scan
    assert "value" not in scan[scan.index("ReadSchema"):].split("\n")[0]


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and "trending_score" in df.columns


def test_core_queries_are_registered():
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())
