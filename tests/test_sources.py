from __future__ import annotations

import os
from datetime import datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from hirelens.sources.files import read_csv_table, read_hiring_tables, read_parquet_table
from hirelens.sources.sinks import export_csv, write_table

APPS_CSV = """application_id,candidate_id,req_id,apply_ts,recruiter_id
A1B2C3D4-0000-0000-0000-000000000001,c1,r1,2023-02-27,
a1b2c3d4-0000-0000-0000-000000000002,c1,r1,2023-02-28 10:11:12.123456,rec
"""


def _write(path: str, text: str) -> str:
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_csv_types_nulls_and_lowercase_ids(spark, scratch_dir):
    path = _write(os.path.join(scratch_dir, "applications.csv"), APPS_CSV)
    df = read_csv_table(spark, path, "applications")
    got = sorted(tuple(r) for r in df.collect())
    assert got[0] == ("a1b2c3d4-0000-0000-0000-000000000001", "c1", "r1", datetime(2023, 2, 27), None)
    assert got[1][3] == datetime(2023, 2, 28, 10, 11, 12, 123456)
    assert dict(df.dtypes)["apply_ts"] == "timestamp_ntz"


def test_csv_bad_timestamp_fails(spark, scratch_dir):
    path = _write(os.path.join(scratch_dir, "applications.csv"), APPS_CSV.replace("2023-02-27", "notadate"))
    with pytest.raises((PySparkException, Py4JJavaError), match="notadate"):
        read_csv_table(spark, path, "applications").collect()


def test_csv_header_mismatch_fails(spark, scratch_dir):
    path = _write(os.path.join(scratch_dir, "applications.csv"), APPS_CSV.replace("recruiter_id", "owner"))
    with pytest.raises((PySparkException, Py4JJavaError), match="CSV header does not conform to the schema"):
        read_csv_table(spark, path, "applications").collect()


def test_parquet_roundtrip_and_csv_export(spark, scratch_dir):
    path = _write(os.path.join(scratch_dir, "applications.csv"), APPS_CSV)
    df = read_csv_table(spark, path, "applications")
    pq = write_table(df, os.path.join(scratch_dir, "apps_parquet"))
    back = read_parquet_table(spark, pq, "applications")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    out = export_csv(df, os.path.join(scratch_dir, "apps_csv"))
    again = read_csv_table(spark, out, "applications")
    assert again.count() == 2


def test_read_hiring_tables_from_directory(spark, scratch_dir):
    files = {
        "candidates": "candidate_id,created_at,source,location,years_experience,email_hash\nc1,2023-01-01,Referral,Remote,3,ab\n",
        "requisitions": "req_id,org,job_family,level,open_date,close_date\nr1,IT,Data,IC2,2023-01-01,\n",
        "applications": APPS_CSV,
        "stage_events_raw": "event_id,application_id,stage,stage_ts,actor_type\n"
        "e1,a1b2c3d4-0000-0000-0000-000000000001,APPLIED,2023-02-27 00:00:00,System\n"
        "e2,zzz,APPLIED,2023-02-27 00:00:00,System\n",
        "offers": "offer_id,application_id,offer_ts,decision,comp_band\n",
        "hires": "hire_id,application_id,hired_ts,start_date\n"
        "h1,a1b2c3d4-0000-0000-0000-000000000001,2023-04-05 06:07:08.000009,2023-05-01\n",
    }
    for name, text in files.items():
        _write(os.path.join(scratch_dir, f"{name}.csv"), text)
    t = read_hiring_tables(spark, scratch_dir).with_promoted_events()
    assert t.stage_events.count() == 1
    assert t.offers.count() == 0
    hire = t.hires.first()
    assert hire["hired_ts"] == datetime(2023, 4, 5, 6, 7, 8, 9)
    assert str(hire["start_date"]) == "2023-05-01"
    req = t.requisitions.first()
    assert req["open_date"] == datetime(2023, 1, 1) and req["close_date"] is None


def test_run_marts_from_csv_exports(spark, scratch_dir):
    from hirelens.plans import marts as M
    from hirelens.plans.run_marts import run

    test_read_hiring_tables_from_directory(spark, scratch_dir)  # writes the six CSV files
    paths = run(spark, scratch_dir, scratch_dir + "/out", fmt="csv")
    life = M.read_mart(spark, paths.lifecycle)
    assert life.count() == 2
    exc = M.read_mart(spark, paths.exceptions)
    assert exc.where("exception_type = 'ORPHAN_STAGE_EVENT'").count() == 1
    assert exc.where("exception_type = 'DUPLICATE_APPLICATION'").count() == 1


def test_csv_quoted_empty_is_empty_string_unquoted_is_null(spark, scratch_dir):
    text = "req_id,org,job_family,level,open_date,close_date\nr1,\"\",Data,IC1,2023-01-01,\nr2,,Data,IC1,2023-01-01,2023-02-01\n"
    path = _write(os.path.join(scratch_dir, "requisitions.csv"), text)
    got = sorted((r.req_id, r.org, r.close_date) for r in read_csv_table(spark, path, "requisitions").collect())
    assert got == [("r1", "", None), ("r2", None, datetime(2023, 2, 1))]


def test_csv_dialect_of_a_database_load(spark, scratch_dir):
    text = 'req_id,org,job_family,level,open_date,close_date\nr1,"Say ""hi"", ok","C:\\",IC1,2023-01-01,\nr2,"a\\","b,c",IC1,2023-01-01,\n'
    path = _write(os.path.join(scratch_dir, "requisitions.csv"), text)
    got = sorted((r.req_id, r.org, r.job_family) for r in read_csv_table(spark, path, "requisitions").collect())
    assert got == [("r1", 'Say "hi", ok', "C:\\"), ("r2", "a\\", "b,c")]
    out = export_csv(read_csv_table(spark, path, "requisitions"), os.path.join(scratch_dir, "back"))
    again = sorted((r.req_id, r.org, r.job_family) for r in read_csv_table(spark, out, "requisitions").collect())
    assert again == got
    lines = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.endswith(".csv"))
    assert '"Say ""hi"", ok"' in lines


def test_csv_quoted_line_breaks(spark, scratch_dir):
    text = 'req_id,org,job_family,level,open_date,close_date\nr1,"two\nlines",Data,IC1,2023-01-01,\n'
    path = _write(os.path.join(scratch_dir, "requisitions.csv"), text)
    assert read_csv_table(spark, path, "requisitions", multi_line=True).first()["org"] == "two\nlines"


def test_failed_run_keeps_the_published_marts(spark, scratch_dir):
    from hirelens.operators.constraints import ConstraintViolation
    from hirelens.plans import marts as M
    from hirelens.plans.run_marts import published_marts, run

    test_read_hiring_tables_from_directory(spark, scratch_dir)
    out = scratch_dir + "/out"
    assert published_marts(spark, out) is None
    first = run(spark, scratch_dir, out)
    assert published_marts(spark, out) == first
    _write(os.path.join(scratch_dir, "stage_events_raw.csv"), "event_id,application_id,stage,stage_ts,actor_type\ne1,a1b2c3d4-0000-0000-0000-000000000001,BOGUS,2023-02-27,System\n")
    with pytest.raises(ConstraintViolation):
        run(spark, scratch_dir, out, constraints="enforce")
    assert published_marts(spark, out) == first and M.read_mart(spark, first.lifecycle).count() == 2
    assert len(os.listdir(out + "/_runs")) == 1  # what the failed run wrote is gone
    second = run(spark, scratch_dir, out, constraints="audit")
    assert published_marts(spark, out) == second != first
    violations = spark.read.parquet(second.lifecycle.replace("marts/mart_application_lifecycle", "tables/constraint_violations"))
    assert violations.where("constraint_type = 'DOMAIN' AND column_names = 'stage'").count() > 0
