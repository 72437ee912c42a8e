"""Every registered query against its oracle, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, con, key):
    diff = compare(spark, con, SF, QUERIES[key], ORACLES[key])
    assert diff is None, diff


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "rank" in df.columns


PLAIN = [
    "member_engagement_full",
    "business_relationships",
    "team_engagement",
    "manager_rankings",
    "export_pdf_blocks",
    "export_monthly_courses",
    "spine_member_week",
    "inc_backfill_grid",
    "weekly_metric",
]


@pytest.mark.parametrize("key", PLAIN)
def test_no_cross_join_and_no_python(spark, key):
    plan = QUERIES[key](spark, SF)._jdf.queryExecution().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEvalPython|BatchEvalPython", plan)


def test_grid_is_not_shuffled(spark):
    plan = QUERIES["member_engagement_full"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    top = plan.split("Generate inline")[0]
    assert "Exchange" not in top


def test_filters_reach_the_scan(spark):
    plan = QUERIES["src_time_slice"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*month", plan) and re.search(r"PushedFilters: \[.*GreaterThan\(o_orderdate", plan)
