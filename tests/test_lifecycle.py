from __future__ import annotations

import pytest
from conftest import make_tables, rows, ts

from hirelens.operators.stages import latest_stage, lifecycle, promote_events, stage_durations


def _life(t):
    return lifecycle(t.applications, t.stage_events, t.candidates, t.requisitions)


@pytest.fixture()
def tables(spark):
    apps = [
        ("a1", "c1", "r1", ts(0), "rec1"),
        ("a2", "c2", "r1", ts(0), None),
        ("a3", "c1", "r2", ts(0), "rec2"),  # no events
        ("a4", "c2", "r2", ts(0), "rec1"),
    ]
    events = [
        ("e1", "a1", "APPLIED", ts(0)),
        ("e2", "a1", "SCREEN", ts(1)),
        ("e3", "a1", "SCREEN", ts(2)),  # repeated stage -> later one
        ("e4", "a1", "ONSITE", ts(5)),
        ("e5", "a1", "OFFER", ts(9)),
        ("e6", "a1", "HIRED", ts(9)),  # tie with OFFER -> HIRED wins
        ("e7", "a2", "APPLIED", ts(0)),
        ("e8", "a2", "HIRED", ts(20)),
        ("e9", "a2", "WITHDRAWN", ts(25)),  # hired, then withdrawn later
        ("e10", "a4", "APPLIED", ts(0)),
        ("e11", "a4", "SCREEN", ts(0, seconds=1.9)),
        ("e12", "zz", "APPLIED", ts(0)),  # orphan
    ]
    return make_tables(spark, apps, events)


def test_promote_keeps_only_known_applications(tables):
    promoted = promote_events(tables.stage_events_raw, tables.applications)
    assert promoted.count() == 11
    assert promoted.where("application_id = 'zz'").count() == 0
    assert promoted.columns == ["event_id", "application_id", "stage", "stage_ts", "actor_type"]


def test_latest_stage_tie_break_and_repeats(tables):
    got = dict(rows(latest_stage(tables.stage_events), "application_id", "latest_stage"))
    assert got == {"a1": "HIRED", "a2": "WITHDRAWN", "a4": "SCREEN"}


def test_lifecycle_one_row_per_application(tables):
    life = _life(tables)
    assert life.count() == 4
    by_id = {r["application_id"]: r for r in life.collect()}
    a1 = by_id["a1"]
    assert a1["screen_ts"] == ts(2)
    assert a1["latest_stage"] == "HIRED" and a1["terminal_stage"] == "HIRED"
    assert a1["source"] == "Referral" and a1["org"] == "Engineering" and a1["job_family"] == "Data"
    assert a1["days_applied_to_screen"] == pytest.approx(2.0)
    assert a1["days_onsite_to_offer"] == pytest.approx(4.0)
    assert a1["days_offer_to_decision"] == pytest.approx(0.0)
    assert a1["total_time_to_hire"] == pytest.approx(9.0)


def test_hired_then_withdrawn(tables):
    a2 = _life(tables).where("application_id = 'a2'").first()
    assert a2["hired_ts"] == ts(20)
    assert a2["terminal_stage"] == "WITHDRAWN"
    assert a2["total_time_to_hire"] == pytest.approx(20.0)
    assert a2["days_offer_to_decision"] is None  # no offer


def test_application_without_events_keeps_null_row(tables):
    a3 = _life(tables).where("application_id = 'a3'").first()
    assert a3["latest_stage"] is None and a3["applied_ts"] is None
    assert all(a3[c] is None for c in ("days_applied_to_screen", "total_time_to_hire"))


def test_durations_are_microsecond_exact(tables):
    a4 = stage_durations(_life(tables)).where("application_id = 'a4'").first()
    assert a4["days_applied_to_screen"] == pytest.approx(1.9 / 86400.0, rel=1e-12)


def test_decision_priority_is_not_earliest(spark):
    t = make_tables(
        spark,
        [("a1", "c1", "r1", ts(0), "x")],
        [
            ("e1", "a1", "OFFER", ts(1)),
            ("e2", "a1", "REJECTED", ts(2)),
            ("e3", "a1", "HIRED", ts(5)),
        ],
    )
    life = _life(t).first()
    assert life["days_offer_to_decision"] == pytest.approx(4.0)  # hired first in priority


def test_latest_stage_with_long_ids(spark):
    from pyspark.sql import functions as F

    t = make_tables(spark, [("1", "1", "1", ts(0), "1")], [("e1", "1", "APPLIED", ts(0))])
    ev = t.stage_events.withColumn("application_id", F.col("application_id").cast("long"))
    assert rows(latest_stage(ev), "application_id", "latest_stage") == [(1, "APPLIED")]


def test_no_events_means_null_latest_stage(spark):
    t = make_tables(spark, [("a1", "c", "r", ts(0), "x"), ("a2", "c", "r2", ts(0), "x")], [("e1", "a1", "WITHDRAWN", ts(1))])
    got = rows(_life(t), "application_id", "latest_stage", "terminal_stage")
    assert got == [("a1", "WITHDRAWN", "WITHDRAWN"), ("a2", None, None)]


def test_last_event_outside_the_domain_or_without_stage(spark):
    apps = [(f"a{i}", "c", f"r{i}", ts(0), "x") for i in range(1, 5)]
    ev = [
        ("1a", "a1", "APPLIED", ts(0)), ("1b", "a1", "BOGUS", ts(5)),  # an unknown name is carried
        ("2a", "a2", "SCREEN", ts(0)), ("2b", "a2", None, ts(5)),  # a null stage wins with its own time
        ("3a", "a3", "APPLIED", ts(5)), ("3b", "a3", "BOGUS", ts(5)), ("3c", "a3", None, ts(5)),  # ties: the domain first
        ("4a", "a4", "BOGUS", ts(1)), ("4b", "a4", "APPLIED", ts(2)), ("4c", "a4", "SCREEN", None),
    ]
    t = make_tables(spark, apps, ev)
    want = [("a1", "BOGUS", ts(5)), ("a2", None, ts(5)), ("a3", "APPLIED", ts(5)), ("a4", "APPLIED", ts(2))]
    assert rows(latest_stage(t.stage_events), "application_id", "latest_stage", "latest_stage_ts") == want
    assert rows(_life(t), "application_id", "latest_stage", "latest_stage_ts") == want
    assert _life(t).where("application_id = 'a1'").first()["applied_ts"] == ts(0)


def test_lifecycle_without_dimensions_keeps_stage_columns(spark):
    t = make_tables(spark, [("a1", "c", "r", ts(0), "x")], [("e1", "a1", "APPLIED", ts(0)), ("e2", "a1", "SCREEN", ts(2))])
    lean = lifecycle(t.applications, t.stage_events, None, None)
    assert not {"source", "org", "job_family"} & set(lean.columns)
    full = _life(t)
    cols = [c for c in full.columns if c in lean.columns]
    assert rows(lean, *cols) == rows(full, *cols)
    plan = lean._jdf.queryExecution().executedPlan().toString()
    assert "candidate_id#" not in plan.split("Exchange hashpartitioning(")[-1].split(",")[0]


def test_several_names_outside_the_domain(spark):
    apps = [(f"a{i}", "c", f"r{i}", ts(0), "x") for i in range(1, 6)]
    ev = [
        ("1a", "a1", "ZED", ts(5)), ("1b", "a1", "BOGUS", ts(5)), ("1c", "a1", "AAA", ts(4)),  # of the last ones, the least name
        ("2a", "a2", "ZED", ts(5)), ("2b", "a2", "BOGUS", ts(4)), ("2c", "a2", "HIRED", ts(3)),
        ("3a", "a3", "ZED", None), ("3b", "a3", None, ts(1)),  # a name without a time is never the latest
        ("4a", "a4", "ZED", None), ("4b", "a4", "BOGUS", None), ("4c", "a4", "HIRED", None),
        ("5a", "a5", "BOGUS", ts(2)), ("5b", "a5", "HIRED", ts(2)), ("5c", "a5", "OFFER", ts(2)), ("5d", "a5", "ZED", ts(1)),
    ]
    t = make_tables(spark, apps, ev)
    want = [("a1", "BOGUS", ts(5)), ("a2", "ZED", ts(5)), ("a3", None, ts(1)), ("a4", None, None), ("a5", "HIRED", ts(2))]
    assert rows(latest_stage(t.stage_events), "application_id", "latest_stage", "latest_stage_ts") == want
    assert rows(_life(t), "application_id", "latest_stage", "latest_stage_ts") == want


def test_microseconds_are_exact_without_a_decimal(spark):
    from hirelens.functions.time import micros_between

    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'0001-01-01 00:00:00.000001' AS a, TIMESTAMP_NTZ'9999-12-31 23:59:59.999999' AS b"
        " UNION ALL SELECT TIMESTAMP_NTZ'1969-12-31 23:59:59.9', TIMESTAMP_NTZ'1970-01-01 00:00:00'"
        " UNION ALL SELECT NULL, TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    )
    out = df.select(micros_between("a", "b").alias("x"), micros_between("b", "a").alias("y"))
    assert [tuple(r) for r in out.collect()] == [(315537897599999998, -315537897599999998), (100000, -100000), (None, None)]
    assert "decimal(" not in out._jdf.queryExecution().executedPlan().toString().lower()
