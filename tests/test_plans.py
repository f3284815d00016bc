"""Plan guards: scale properties of every batch catalogue query, checked on
the physical plan rather than by eye."""

import re

import pytest

from aerostream.plans.catalog import QUERIES
from aerostream.plans.streams import STREAM_QUERIES
from tests.conftest import SF_MID

BATCH = sorted(n for n in QUERIES if n not in STREAM_QUERIES)

# aggregation levels per query beyond the first: latest record per flight
# followed by a grouping, or the distinct-count level
TWO_LEVEL = {"busiest_routes", "delay_buckets", "delayed_by_origin", "get_delayed", "all_delayed",
             "sink_by_status", "sink_by_airline", "sink_count", "sink_columns"}


def _plan(spark, name):
    return QUERIES[name](spark, SF_MID)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_plan_shape(spark, name):
    plan = _plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"
    assert "BroadcastExchange" not in plan, f"{name}: unchecked broadcast"
    hash_ex = len(re.findall(r"Exchange hashpartitioning", plan))
    budget = 1 + (name in TWO_LEVEL)
    assert hash_ex <= budget, f"{name}: {hash_ex} hash exchanges"
    # every shuffle that feeds an aggregate carries partial aggregates
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" not in line or i == 0:
            continue
        parent = lines[i - 1]
        feeds_agg = "Aggregate" in parent or ("Sort [" in parent and i > 1 and "SortAggregate" in lines[i - 2])
        if feeds_agg:
            assert "Aggregate" in lines[i + 1] or "Sort [" in lines[i + 1], f"{name}: no partial aggregate"


def test_scans_prune_columns(spark):
    assert "ReadSchema: struct<text:string>" in _plan(spark, "word_count_java")
    plan = _plan(spark, "recent_cancelled")  # value is not needed: pruned from the scan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
