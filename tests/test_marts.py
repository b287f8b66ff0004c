from __future__ import annotations

import pytest
from conftest import make_tables, rows, ts
from pyspark.sql import functions as F

from hirelens.operators import rules as R
from hirelens.operators import sla as S
from hirelens.operators.stages import lifecycle
from hirelens.plans import marts as M


def test_marts_equal_views(spark, scratch_dir):
    apps = [("a1", "c", "r1", ts(0), "rec"), ("a2", "c", "r1", ts(1), None), ("a3", "c", "r2", ts(0), "rec")]
    ev = [
        ("1", "a1", "APPLIED", ts(0)), ("2", "a1", "SCREEN", ts(4)), ("3", "a1", "ONSITE", ts(6)),
        ("4", "a1", "OFFER", ts(8)), ("5", "a1", "HIRED", ts(9)),
        ("6", "a3", "APPLIED", ts(0)), ("7", "a3", "SCREEN", ts(1)), ("8", "x", "APPLIED", ts(0)),
    ]
    t = make_tables(spark, apps, ev, offers=[("o1", "a3", ts(2))])
    fixed = F.lit("2024-01-01 00:00:00").cast("timestamp")
    paths = M.build_marts(t, scratch_dir + "/marts", detected_ts=fixed)

    life = lifecycle(t.applications, t.stage_events, t.candidates, t.requisitions)
    life_mart = M.read_mart(spark, paths.lifecycle)
    assert life_mart.columns == list(M.LIFECYCLE_MART_COLUMNS)
    assert rows(life_mart) == rows(life.select(*M.LIFECYCLE_MART_COLUMNS))

    exc = R.data_exceptions(t.stage_events_raw, t.applications, life, t.offers, detected_ts=fixed)
    assert rows(M.read_mart(spark, paths.exceptions)) == rows(exc.select(*M.EXCEPTION_MART_COLUMNS))

    br = S.sla_breaches(S.sla_transitions(life))
    assert rows(M.read_mart(spark, paths.sla_breaches)) == rows(br.select(*M.BREACH_MART_COLUMNS))
    assert rows(M.read_mart(spark, paths.sla_compliance)) == rows(S.sla_compliance(br).select(*M.COMPLIANCE_MART_COLUMNS))


def test_csv_marts(spark, scratch_dir):
    apps = [("001", "c", "r1", ts(0), "007")]
    ev = [("1", "001", "APPLIED", ts(0)), ("2", "001", "SCREEN", ts(4))]
    t = make_tables(spark, apps, ev)
    paths = M.build_marts(t, scratch_dir + "/csv_marts", fmt="csv")
    schemas = M.mart_schemas()
    summary = M.read_mart(spark, paths.sla_compliance, "csv", schemas[M.MART_SLA_COMPLIANCE]).collect()
    assert [(r["recruiter_id"], r["transition_name"], r["total_cases"], r["breaches"]) for r in summary] == [("007", "APPLIED_TO_SCREEN", 1, 1)]
    life = M.read_mart(spark, paths.lifecycle, "csv", schemas[M.MART_LIFECYCLE]).first()
    assert (life["application_id"], life["recruiter_id"], life["applied_ts"]) == ("001", "007", ts(0))
    with pytest.raises(ValueError, match="declared schema"):
        M.read_mart(spark, paths.lifecycle, "csv")


def test_declared_mart_schemas_match(spark, scratch_dir):
    t = make_tables(spark, [("a1", "c", "r1", ts(0), "rec")], [("1", "a1", "APPLIED", ts(0)), ("2", "a1", "SCREEN", ts(4))])
    paths = M.build_marts(t, scratch_dir + "/typed").as_dict()
    for name, schema in M.mart_schemas().items():
        assert [(f.name, f.dataType) for f in M.read_mart(spark, paths[name]).schema] == [(f.name, f.dataType) for f in schema]
