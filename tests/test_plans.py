"""Plan checks: no nested-loop or cartesian joins; pushdown reaches the scan."""

import pytest

from tessera.plans.registry import load_all

BASE = "/root/testdata/sf0.001"
QUERIES, _ = load_all()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_or_cartesian(spark, name):
    plan = _plan(QUERIES[name](spark, BASE))
    assert "BroadcastNestedLoopJoin" not in plan, name
    assert "CartesianProduct" not in plan, name


def test_projection_and_filter_pushdown(spark):
    df = QUERIES["extract_projection"](spark, BASE)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "o_orderpriority" not in read_schema and "o_orderstatus" in read_schema


def test_pick_one_is_partial_aggregate(spark):
    plan = _plan(QUERIES["latest_per_key"](spark, BASE))
    assert "partial_max" in plan and "Window" not in plan
