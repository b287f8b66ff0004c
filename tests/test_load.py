from __future__ import annotations

import os

import pytest
from conftest import make_tables, rows, ts

from hirelens.operators import constraints as C
from hirelens.plans import load as L
from hirelens.plans.ingest import LoadAborted, ingest_csv
from hirelens.schemas import SPECS


def _dirty(spark):
    apps = [("a1", "c1", "r1", ts(0), "x"), ("a1", "c1", "r1", ts(1), "x"), ("a3", "ghost", "r1", ts(2), "x"), ("a4", "c1", None, ts(3), "x"), (None, "c1", "r1", ts(4), None)]
    cands = [("c1", ts(-5), "Referral", "Remote", 5, "abc"), ("c2", ts(-5), "x" * 51, "Remote", 51, None)]
    reqs = [("r1", "Engineering", "Data", "IC3", ts(0), ts(-1)), ("r2", "Engineering", "Data", "IC9", ts(0), None)]
    ev = [("e1", "a1", "SCREEN", ts(0), "Robot"), ("e2", "a1", "NOPE", ts(0), "System")]
    offers = [("o1", "a1", None, "ACCEPTED", "A"), ("o2", "a1", ts(1), "MAYBE", "A")]
    return make_tables(spark, apps, ev, offers=offers, candidates=cands, requisitions=reqs)


def _counted(audit) -> dict:
    return {tuple(r)[:3]: r["n"] for r in audit.groupBy("table_name", "constraint_type", "column_names").agg({"violation_count": "sum"}).withColumnRenamed("sum(violation_count)", "n").collect()}


def test_counts_of_the_write_equal_the_audits(spark, scratch_dir):
    t = _dirty(spark).as_dict()
    found = {(name, *key): n for name, df in t.items() for key, n in L.write_checked(df, f"{scratch_dir}/{name}", name).items()}
    assert found == _counted(C.audit_rows(t))
    assert found[("offers", "NOT_NULL", "offer_ts")] == 1 and found[("applications", "NOT_NULL", "application_id")] == 1
    assert spark.read.parquet(f"{scratch_dir}/applications").count() == 5


def test_every_row_check_has_a_metric():
    kinds = {kind for spec in SPECS.values() for kind, _ in C.row_check_metrics(spec)}
    assert kinds == {"NOT_NULL", "RANGE", "DOMAIN", "DATE_ORDER", "LENGTH"}


def test_audit_lists_the_same_violations_as_the_audits(spark, scratch_dir):
    t = _dirty(spark)
    stored = L.load_tables(t, scratch_dir)
    got = rows(spark.read.parquet(f"{scratch_dir}/{L.VIOLATIONS}"))
    # a null key is listed once, by the row checks
    want = C.audit_constraints(stored.as_dict()).where("NOT (constraint_type = 'NOT_NULL' AND key_value IS NULL AND column_names = 'application_id' AND table_name = 'applications')")
    extra = C.audit_rows(stored.as_dict()).where("key_value IS NULL AND column_names = 'application_id' AND table_name = 'applications'")
    assert got == rows(want.union(extra))


def test_enforce_raises_without_another_scan(spark, scratch_dir, monkeypatch):
    def never(*_):
        raise AssertionError("the stored tables were read again")

    monkeypatch.setattr(L, "audit_rows", never)
    monkeypatch.setattr(L, "audit_keys", never)
    with pytest.raises(C.ConstraintViolation) as err:
        L.load_tables(_dirty(spark), scratch_dir, "enforce")
    assert err.value.counts == {"NOT_NULL": 4, "RANGE": 1, "LENGTH": 1, "DATE_ORDER": 1, "DOMAIN": 6}


def test_enforce_finds_keys_and_references(spark, scratch_dir):
    apps = [("a1", "c1", "r1", ts(0), "x"), ("a1", "c1", "r1", ts(0), "x")]
    t = make_tables(spark, apps, offers=[("o1", "zz", ts(0))])
    with pytest.raises(C.ConstraintViolation) as err:
        L.load_tables(t, scratch_dir, "enforce")
    assert err.value.counts == {"PRIMARY_KEY": 2, "UNIQUE": 2, "FOREIGN_KEY": 1}
    clean = make_tables(spark, apps[:1], [("e1", "a1", "APPLIED", ts(0))])
    assert L.load_tables(clean, scratch_dir + "/2", "enforce").stage_events.count() == 1
    L.load_tables(clean, scratch_dir + "/3")
    assert spark.read.parquet(f"{scratch_dir}/3/{L.VIOLATIONS}").count() == 0
    L.load_tables(_dirty(spark), scratch_dir + "/4", "off")
    assert not os.path.exists(f"{scratch_dir}/4/{L.VIOLATIONS}")
    with pytest.raises(ValueError):
        L.load_tables(clean, scratch_dir, "often")


EXPORTS = {
    "candidates": "candidate_id,created_at,source,location,years_experience,email_hash\nc1,2023-01-01,Referral,Remote,5,abc\nc2,2023-01-01,Referral,Remote,many,abc\nc3,2023-01-01,Referral\n",
    "requisitions": "req_id,org,job_family,level,open_date,close_date\nr1,\"Sales, EU\",Data,IC1,2023-01-01,\n",
    "applications": "application_id,candidate_id,req_id,apply_ts,recruiter_id\na1,c1,r1,2023-01-02,\n",
    "stage_events_raw": "event_id,application_id,stage,stage_ts,actor_type\ne1,A1,APPLIED,2023-01-02,System\ne2,a1,SCREEN,someday,System\n",
    "offers": "offer_id,application_id,offer_ts,decision,comp_band\n",
    "hires": "hire_id,application_id,hired_ts,start_date\n",
}


def _export(directory, exports) -> str:
    os.makedirs(directory)
    for name, text in exports.items():
        with open(os.path.join(directory, f"{name}.csv"), "w") as f:
            f.write(text)
    return directory


def test_bad_lines_are_listed_and_fail_the_load(spark, scratch_dir):
    src = _export(scratch_dir + "/in", EXPORTS)
    with pytest.raises(LoadAborted) as err:
        ingest_csv(spark, src, scratch_dir + "/out", scratch_dir + "/bad")
    assert err.value.counts == {"candidates": 2, "stage_events_raw": 1}
    got = {(r["table_name"], os.path.basename(r["file"]), r["line"], r["reason"]) for r in spark.read.parquet(scratch_dir + "/bad").collect()}
    assert got == {
        ("candidates", "candidates.csv", "c2,2023-01-01,Referral,Remote,many,abc", "years_experience: no int: many"),
        ("candidates", "candidates.csv", "c3,2023-01-01,Referral", "not 6 fields"),
        ("stage_events_raw", "stage_events_raw.csv", "e2,a1,SCREEN,someday,System", "stage_ts: no timestamp_ntz: someday"),
    }


def test_clean_exports_are_stored(spark, scratch_dir):
    clean = {n: "\n".join(x for x in t.split("\n") if not x.startswith(("c2", "c3", "e2"))) for n, t in EXPORTS.items()}
    t = ingest_csv(spark, _export(scratch_dir + "/in", clean), scratch_dir + "/out", scratch_dir + "/bad")
    assert rows(t.stage_events_raw, "event_id", "application_id", "stage_ts")[0][:2] == ("e1", "a1")
    assert t.requisitions.first()["org"] == "Sales, EU" and t.requisitions.first()["close_date"] is None
    assert t.with_promoted_events().stage_events.count() == 1 and not os.path.exists(scratch_dir + "/bad")
    wrong = dict(clean, offers="offer,application_id,offer_ts,decision,comp_band\no,a1,2023-01-01,ACCEPTED,A\n")
    with pytest.raises(Exception, match="header"):
        ingest_csv(spark, _export(scratch_dir + "/in2", wrong), scratch_dir + "/out2", scratch_dir + "/bad2")


def test_a_job_with_bad_lines_publishes_nothing(spark, scratch_dir):
    from hirelens.plans.run_marts import published_marts, run

    src = _export(scratch_dir + "/in", EXPORTS)
    with pytest.raises(LoadAborted) as err:
        run(spark, src, scratch_dir + "/out")
    assert published_marts(spark, scratch_dir + "/out") is None
    assert spark.read.parquet(err.value.path).count() == 3  # the list outlives the run
    assert os.listdir(scratch_dir + "/out/_runs") == []
