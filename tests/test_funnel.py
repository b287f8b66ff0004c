from __future__ import annotations

from datetime import datetime

import pytest
from conftest import make_tables, rows, ts

from hirelens.functions.time import week_start
from hirelens.operators.funnel import funnel_metrics, kpi_summary
from hirelens.operators.stages import lifecycle


def test_week_is_monday_based(spark):
    df = spark.createDataFrame([(datetime(2023, 1, 1, 23, 59),), (datetime(2023, 1, 2, 0, 0),)], "t timestamp_ntz")
    got = [r[0] for r in df.select(week_start("t")).collect()]
    assert got == [datetime(2022, 12, 26), datetime(2023, 1, 2)]


def test_funnel_counts_rates_and_null_week(spark):
    apps = [("a1", "c", "r", ts(0), "x"), ("a2", "c", "r", ts(0), "x"), ("a3", "c", "r", ts(0), "x")]
    ev = [
        ("1", "a1", "APPLIED", ts(0)), ("2", "a1", "SCREEN", ts(1)), ("3", "a1", "HIRED", ts(9)),
        ("4", "a2", "APPLIED", ts(1)),
    ]
    t = make_tables(spark, apps, ev)
    life = lifecycle(t.applications, t.stage_events, t.candidates, t.requisitions)
    f = {r["apply_week"]: r for r in funnel_metrics(life).collect()}
    week = f[datetime(2023, 1, 2)]
    assert (week["applied"], week["screened"], week["onsite"], week["offered"], week["hired"]) == (2, 1, 0, 0, 1)
    assert week["applied_to_screen_rate"] == 0.5
    assert week["screen_to_onsite_rate"] == 0.0
    assert week["onsite_to_offer_rate"] is None  # zero denominator
    assert week["offer_to_hire_rate"] is None
    assert f[None]["applied"] == 1  # a3 has no events
    k = kpi_summary(life).first()
    assert k["applied"] == 3 and k["hired"] == 1 and k["offer_acceptance_rate"] is None
    assert k["avg_time_to_hire_days"] == pytest.approx(9.0)
    assert rows(funnel_metrics(life, by=["source"]), "source", "applied") == [("Referral", 3)]
