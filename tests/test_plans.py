"""Plan-shape guards for every registered query (sf0.001): no cartesian or
nested-loop joins, no sort-based aggregation, scans pruned and filtered."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E._hiring_queries()))
def test_no_quadratic_or_sort_based_operators(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"


def test_lifecycle_aggregates_partially_before_the_shuffle(spark):
    plan = _plan(E.queries()["lifecycle"](spark, SF))
    assert "partial_max" in plan
    # the lines are read with only the columns that the pivot needs
    scan = re.search(r"FileScan parquet \[([^\]]*l_linenumber[^\]]*)\]", plan).group(1)
    assert set(c.split("#")[0] for c in scan.split(",")) == {"l_orderkey", "l_linenumber", "l_quantity", "l_discount"}


def test_orphan_rule_is_an_anti_join_on_pruned_scans(spark):
    plan = _plan(E.queries()["exc_orphan_event"](spark, SF))
    assert "LeftAnti" in plan
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert sorted(len(s.split(",")) for s in scans) == [1, 1, 5]  # application ids, order keys, the parts of an event id


def test_lifecycle_sorts_the_aggregated_events_once(spark):
    plan = _plan(E.queries()["lifecycle"](spark, SF))
    assert plan.count(" Window [") == 1 and "WindowGroupLimit" not in plan
    assert plan.count("Sort [application_id") == 2  # the applications and, for the window and the join alike, the aggregate
    assert "decimal(" not in plan.lower()


def test_orphan_rule_does_not_sort_the_events(spark):
    plan = _plan(E.queries()["exc_orphan_event"](spark, SF))
    assert re.search(r"ShuffledHashJoin .*LeftAnti", plan) and "Sort [" not in plan


@pytest.mark.parametrize("mode", ["", "_symmetric"])
def test_duplicate_rule_joins_flagged_points_by_hash(spark, mode):
    plan = _plan(E.queries()[f"exc_duplicate_application{mode}"](spark, SF))
    joins = re.findall(r"(\w+Join) ", plan)
    assert len(joins) == 2 and joins[0] == "ShuffledHashJoin"
    assert plan.count("FileScan") == 3  # the applications, and their points for hours and for places
