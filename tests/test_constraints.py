from __future__ import annotations

import re

import pytest
from conftest import make_tables, rows, ts

from hirelens.operators import constraints as C


@pytest.fixture()
def dirty(spark):
    apps = [
        ("a1", "c1", "r1", ts(0), "x"),
        ("a1", "c1", "r1", ts(1), "x"),  # duplicate primary key
        ("a2", "c1", "r1", ts(0), "x"),  # unique (candidate, req, apply_ts) with a1's first row
        ("a3", "ghost", "r1", ts(2), "x"),  # FK to a missing candidate
        ("a4", "c1", None, ts(3), "x"),  # NOT NULL req_id; null FK passes
    ]
    cands = [
        ("c1", ts(-5), "Referral", "Remote", 5, "abc"),
        ("c2", ts(-5), "x" * 51, "Remote", 51, None),  # length, range, not null
    ]
    reqs = [
        ("r1", "Engineering", "Data", "IC3", ts(0), ts(-1)),  # closed before open
        ("r2", "Engineering", "Data", "IC9", ts(0), None),  # level outside domain
    ]
    ev = [("e1", "a2", "SCREEN", ts(0), "Robot"), ("e2", "a2", "NOPE", ts(0), "System")]
    return make_tables(spark, apps, ev, candidates=cands, requisitions=reqs).as_dict()


def test_each_audit_finds_its_violation(dirty):
    got = rows(C.audit_constraints(dirty), "table_name", "constraint_type", "column_names", "key_value", "violation_count")
    expected = [
        ("applications", "PRIMARY_KEY", "application_id", "a1", 2),
        ("applications", "UNIQUE", "candidate_id,req_id,apply_ts", "c1|r1|2023-01-02 09:00:00", 2),
        ("applications", "FOREIGN_KEY", "candidate_id", "a3", 1),
        ("applications", "NOT_NULL", "req_id", "a4", 1),
        ("candidates", "NOT_NULL", "email_hash", "c2", 1),
        ("candidates", "RANGE", "years_experience", "c2", 1),
        ("candidates", "LENGTH", "source", "c2", 1),
        ("requisitions", "DATE_ORDER", "open_date,close_date", "r1", 1),
        ("requisitions", "DOMAIN", "level", "r2", 1),
        ("stage_events_raw", "DOMAIN", "actor_type", "e1", 1),
        ("stage_events_raw", "DOMAIN", "stage", "e2", 1),
        ("stage_events", "DOMAIN", "actor_type", "e1", 1),
        ("stage_events", "DOMAIN", "stage", "e2", 1),
    ]
    assert sorted(got) == sorted(expected)


def test_enforce_raises_with_counts(dirty):
    with pytest.raises(C.ConstraintViolation) as err:
        C.enforce_constraints(dirty)
    assert err.value.counts["DOMAIN"] == 5


def test_clean_tables_pass(spark):
    t = make_tables(spark, [("a1", "c1", "r1", ts(0), None)], [("e1", "a1", "APPLIED", ts(0))]).as_dict()
    assert C.audit_constraints(t).count() == 0
    C.enforce_constraints(t)


def test_null_primary_key_counted_once(spark):
    from conftest import frame

    cands = frame(spark, "candidates", [(None, ts(0), "s", "l", 1, "e"), (None, ts(0), "s", "l", 1, "e"), ("c1", ts(0), "s", "l", 1, "e")])
    got = rows(C.audit_primary_key({"candidates": cands}), "constraint_type", "key_value", "violation_count")
    assert got == [("NOT_NULL", None, 2)]


@pytest.mark.parametrize("audit", [C.audit_domain, C.audit_length])
def test_row_checks_filter_below_the_joins_that_made_a_table(spark, audit):
    """Only offending rows are shuffled to a join whose other side is not asked."""
    ids = spark.range(100).selectExpr("id AS application_id")
    events = spark.range(100).selectExpr("CAST(id AS STRING) AS event_id", "id AS application_id", "IF(id = 7, repeat('x', 51), 'SCREEN') AS stage", "'System' AS actor_type")
    found = audit({"stage_events": events.join(ids, "application_id", "left_semi")})
    assert [r["key_value"] for r in found.collect()] == ["7"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftSemi.*Filter .*= 7", plan, re.S), plan
