"""Property tests: random inputs against brute-force definitions."""

from __future__ import annotations

from datetime import timedelta

import numpy as np
import pytest
from conftest import make_tables, ts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hirelens.functions.percentile import percentile_cont
from hirelens.operators import rules as R

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

apps_strategy = st.lists(
    st.tuples(
        st.sampled_from(["c1", "c2"]),
        st.sampled_from(["r1", "r2"]),
        # whole days plus an offset that hits the exact 30-day edge often
        st.integers(min_value=0, max_value=90),
        st.sampled_from([0, 0, 1, -1]),
    ),
    min_size=1,
    max_size=25,
)


@SETTINGS
@given(apps_strategy, st.sampled_from(["reference", "symmetric"]))
def test_duplicate_rule_matches_definition(spark, spec, mode):
    apps = [
        (f"a{i:03d}", c, r, ts(d) + timedelta(microseconds=us), "x") for i, (c, r, d, us) in enumerate(spec)
    ]
    t = make_tables(spark, apps)
    got = sorted(r["application_id"] for r in R.rule_duplicate_application(t.applications, mode=mode).collect())
    expected = set()
    for a1 in apps:
        for a2 in apps:
            if a1[0] == a2[0] or a1[1] != a2[1] or a1[2] != a2[2]:
                continue
            later = a1[0] > a2[0] if mode == "reference" else (a1[3], a1[0]) > (a2[3], a2[0])
            if later and a2[3] <= a1[3] <= a2[3] + timedelta(days=30):
                expected.add(a1[0])
    assert got == sorted(expected)


values_strategy = st.lists(
    st.tuples(
        st.sampled_from(["g1", "g2", None]),
        st.one_of(st.integers(min_value=-(2**50), max_value=2**50), st.sampled_from([0, 1, 1, -1, 65536])),
    ),
    min_size=1,
    max_size=60,
)


@SETTINGS
@given(values_strategy, st.sampled_from([0.0, 0.5, 0.9, 1.0]))
def test_percentile_matches_numpy(spark, data, p):
    df = spark.createDataFrame(data, "k string, v long")
    got = {r["k"]: r["p"] for r in percentile_cont(df, ["k"], "v", p, alias="p").collect()}
    for key in {k for k, _ in data}:
        vals = [v for k, v in data if k == key]
        assert got[key] == pytest.approx(float(np.percentile(vals, p * 100)), rel=1e-9, abs=1e-9)


STAGES = ["APPLIED", "SCREEN", "ONSITE", "OFFER", "HIRED", "REJECTED", "WITHDRAWN"]
events_strategy = st.lists(
    st.tuples(st.integers(0, 3), st.sampled_from(STAGES), st.integers(0, 6)),
    min_size=0,
    max_size=30,
)


@SETTINGS
@given(events_strategy)
def test_lifecycle_and_exception_log_match_definition(spark, spec):
    from hirelens.operators.stages import lifecycle

    apps = [(f"a{i}", "c", f"r{i}", ts(0), "x") for i in range(4)]
    events = [(f"e{j}", f"a{a}", s, ts(d)) for j, (a, s, d) in enumerate(spec)]
    t = make_tables(spark, apps, events)
    life = {r["application_id"]: r for r in lifecycle(t.applications, t.stage_events, t.candidates, t.requisitions).collect()}
    for i in range(4):
        mine = [(s, when) for (_, a, s, when) in events if a == f"a{i}"]
        row = life[f"a{i}"]
        for s in STAGES:
            times = [w for st_, w in mine if st_ == s]
            assert row[f"{s.lower()}_ts"] == (max(times) if times else None)
        expected_latest = max(mine, key=lambda e: (e[1], STAGES.index(e[0])))[0] if mine else None
        assert row["latest_stage"] == expected_latest
        first = {s: row[f"{s.lower()}_ts"] for s in STAGES}
        decision = first["HIRED"] or first["REJECTED"] or first["WITHDRAWN"]
        if first["OFFER"] and decision:
            assert row["days_offer_to_decision"] == pytest.approx((decision - first["OFFER"]).total_seconds() / 86400)
        else:
            assert row["days_offer_to_decision"] is None
    life_df = lifecycle(t.applications, t.stage_events, None, None)
    single = R.data_exceptions(t.stage_events_raw, t.applications, life_df, t.offers).drop("detected_ts")
    per_rule = R.data_exceptions_per_rule(t.stage_events_raw, t.applications, life_df, t.offers)
    assert sorted(map(tuple, single.collect()), key=repr) == sorted(map(tuple, per_rule.collect()), key=repr)


sla_strategy = st.lists(
    st.tuples(st.integers(0, 5), st.sampled_from(STAGES[:5]), st.integers(0, 20), st.integers(0, 3)),
    min_size=1,
    max_size=40,
)


@SETTINGS
@given(sla_strategy)
def test_sla_compliance_matches_definition(spark, spec):
    import pandas as pd

    from hirelens.operators import sla as S
    from hirelens.operators.stages import lifecycle

    apps = [(f"a{i}", "c", f"r{i}", ts(0), None if i == 0 else f"rec{i % 2}") for i in range(6)]
    events = [(f"e{j}", f"a{a}", s, ts(d, hours=h)) for j, (a, s, d, h) in enumerate(spec)]
    t = make_tables(spark, apps, events)
    life = lifecycle(t.applications, t.stage_events, None, t.requisitions)
    got = {(r["recruiter_id"], r["transition_name"]): r for r in S.sla_compliance(S.sla_breaches(S.sla_transitions(life))).collect()}

    rows_ = []
    targets = {"APPLIED_TO_SCREEN": ("APPLIED", "SCREEN", 3), "SCREEN_TO_ONSITE": ("SCREEN", "ONSITE", 10),
               "ONSITE_TO_OFFER": ("ONSITE", "OFFER", 7), "OFFER_TO_DECISION": ("OFFER", "HIRED", 5)}
    for a_id, _, _, _, rec in apps:
        latest = {}
        for _, a, s, when in events:
            if a == a_id:
                latest[s] = max(latest.get(s, when), when)
        for name, (s0, s1, days) in targets.items():
            if s0 in latest and s1 in latest:
                d = (latest[s1] - latest[s0]).total_seconds() / 86400
                if d >= 0:
                    rows_.append((rec, name, d, d > days))
    exp = pd.DataFrame(rows_, columns=["rec", "t", "d", "b"])
    assert len(got) == exp.groupby(["rec", "t"], dropna=False).ngroups
    for (rec, name), g in exp.groupby(["rec", "t"], dropna=False):
        r = got[(None if pd.isna(rec) else rec, name)]
        assert r["total_cases"] == len(g) and r["breaches"] == int(g["b"].sum())
        assert r["compliance_rate"] == pytest.approx(1 - g["b"].mean())
        assert r["avg_duration_days"] == pytest.approx(g["d"].mean())
        assert r["p90_duration_days"] == pytest.approx(float(np.percentile(g["d"], 90)))


@SETTINGS
@given(events_strategy)
def test_funnel_matches_definition(spark, spec):
    from hirelens.functions.time import week_start
    from hirelens.operators.funnel import funnel_metrics
    from hirelens.operators.stages import lifecycle

    apps = [(f"a{i}", "c", "r", ts(0), "x") for i in range(4)]
    events = [(f"e{j}", f"a{a}", s, ts(d * 3)) for j, (a, s, d) in enumerate(spec)]
    t = make_tables(spark, apps, events)
    life = lifecycle(t.applications, t.stage_events, t.candidates, t.requisitions)
    got = {r["apply_week"]: r for r in funnel_metrics(life).collect()}
    per_app = {}
    for _, a, s, when in events:
        per_app.setdefault(a, {})[s] = max(per_app.get(a, {}).get(s, when), when)
    weeks = {}
    for a_id, *_ in apps:
        st_ = per_app.get(a_id, {})
        applied = st_.get("APPLIED")
        wk = None
        if applied is not None:
            wk = spark.createDataFrame([(applied,)], "t timestamp_ntz").select(week_start("t")).first()[0]
        c = weeks.setdefault(wk, [0, 0, 0, 0, 0])
        c[0] += 1
        for k, s in enumerate(("SCREEN", "ONSITE", "OFFER", "HIRED"), start=1):
            c[k] += s in st_
    assert set(got) == set(weeks)
    for wk, (n, sc, on, of, hi) in weeks.items():
        r = got[wk]
        assert (r["applied"], r["screened"], r["onsite"], r["offered"], r["hired"]) == (n, sc, on, of, hi)
        assert r["screen_to_onsite_rate"] == (None if sc == 0 else pytest.approx(on / sc))
        assert r["offer_to_hire_rate"] == (None if of == 0 else pytest.approx(hi / of))
