from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import make_tables, rows, ts

from hirelens.functions.percentile import percentile_cont
from hirelens.operators import sla as S
from hirelens.operators.stages import lifecycle


def _breaches(t):
    life = lifecycle(t.applications, t.stage_events, t.candidates, t.requisitions)
    return S.sla_breaches(S.sla_transitions(life))


@pytest.fixture()
def tables(spark):
    apps = [("a1", "c", "r1", ts(0), "rec"), ("a2", "c", "r2", ts(0), None), ("a3", "c", "r3", ts(0), "rec")]
    ev = [
        ("1a", "a1", "APPLIED", ts(0)), ("1b", "a1", "SCREEN", ts(3)),  # exactly 3.0 days: complies
        ("1c", "a1", "ONSITE", ts(14)),  # 11 > 10: breach
        ("2a", "a2", "APPLIED", ts(0)), ("2b", "a2", "SCREEN", ts(-1)),  # -1 day: excluded
        ("2c", "a2", "OFFER", ts(2)), ("2d", "a2", "REJECTED", ts(9)),  # offer->decision 7 > 5
        ("3a", "a3", "APPLIED", ts(0)),  # stuck: no transition
    ]
    return make_tables(spark, apps, ev)


def test_transitions_and_breaches(tables):
    b = _breaches(tables)
    got = rows(b, "application_id", "transition_name", "duration_days", "sla_days", "is_breach")
    assert got == [
        ("a1", "APPLIED_TO_SCREEN", 3.0, 3, False),
        ("a1", "SCREEN_TO_ONSITE", 11.0, 10, True),
        ("a2", "OFFER_TO_DECISION", 7.0, 5, True),
    ]
    life = lifecycle(tables.applications, tables.stage_events, tables.candidates, tables.requisitions)
    assert S.sla_transitions(life).count() == 4  # the negative one is a transition, not a breach row


def test_compliance_null_recruiter_is_a_group(tables):
    c = S.sla_compliance(_breaches(tables))
    got = rows(c, "recruiter_id", "transition_name", "total_cases", "breaches", "compliance_rate")
    assert got == [
        ("rec", "APPLIED_TO_SCREEN", 1, 0, 1.0),
        ("rec", "SCREEN_TO_ONSITE", 1, 1, 0.0),
        (None, "OFFER_TO_DECISION", 1, 1, 0.0),
    ]


def test_p90_interpolates(spark):
    df = spark.createDataFrame([("g", v) for v in range(1, 11)], "k string, v long")
    out = percentile_cont(df, ["k"], "v", 0.9, alias="p").first()
    assert out["p"] == pytest.approx(9.1)


def test_percentile_matches_numpy(spark):
    rnd = random.Random(11)
    data = []
    for g in range(5):
        n = [1, 2, 40, 300, 999][g]
        for _ in range(n):
            data.append((f"g{g}" if g != 4 else None, rnd.choice([rnd.randrange(-(2**40), 2**52), 3, 3, 0, 65535, 65536, -1])))
    data.append(("empty", None))
    df = spark.createDataFrame(data, "k string, v long")
    got = {r["k"]: r["p"] for r in percentile_cont(df, ["k"], "v", 0.9, alias="p").collect()}
    for key in {d[0] for d in data}:
        vals = [v for k, v in data if k == key and v is not None]
        if not vals:
            assert got[key] is None
        else:
            assert got[key] == pytest.approx(float(np.percentile(vals, 90)), rel=1e-12, abs=1e-12)


def test_percentile_of_extreme_longs(spark):
    df = spark.createDataFrame([("g", v) for v in (-(2**63), 2**63 - 1, 0, -1, 1)], "k string, v long")
    for p, want in ((0.0, -(2.0**63)), (0.25, -1.0), (0.5, 0.0), (0.75, 1.0), (1.0, 2.0**63)):
        assert percentile_cont(df, ["k"], "v", p, alias="p").first()["p"] == want


def test_rollup_levels(tables):
    r = S.sla_compliance_rollup(_breaches(tables))
    got = rows(r, "grouping_level", "transition_name", "org", "recruiter_id", "total_cases")
    assert ("TRANSITION", "OFFER_TO_DECISION", None, None, 1) in got
    assert ("ORG", "OFFER_TO_DECISION", "Engineering", None, 1) in got
    assert ("RECRUITER", "OFFER_TO_DECISION", "Engineering", None, 1) in got
    assert len(got) == 9
