from __future__ import annotations

import glob
import os
import random

import pyarrow.parquet as pq
import pytest
from conftest import make_tables, rows, ts
from pyspark.sql import functions as F

from hirelens.operators.stages import latest_stage, lifecycle
from hirelens.plans import catalog as C
from hirelens.plans import marts as M
from hirelens.plans.layout import clustered, file_ranges, save_table, write_clustered, Layout
from hirelens.plans.views import reporting_views

STAGES = ["APPLIED", "SCREEN", "ONSITE", "OFFER", "HIRED", "REJECTED", "WITHDRAWN", "ODD", "OTHER", None]
PLAIN = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in PLAIN}
    for k, v in PLAIN.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _tables(spark, seed=1, n=120):
    rnd = random.Random(seed)
    apps = [(f"a{i:03d}", f"c{i % 40}", f"r{i % 9}", ts(rnd.uniform(0, 60)), rnd.choice(["x", "y", "z", None])) for i in range(n)]
    events = [(f"e{i}", f"a{rnd.randrange(n + 5):03d}", rnd.choice(STAGES), None if rnd.random() < 0.03 else ts(rnd.randrange(60))) for i in range(n * 6)]
    offers = [(f"o{i}", f"a{rnd.randrange(n):03d}", ts(rnd.uniform(0, 60))) for i in range(30)]
    requisitions = [(f"r{i}", "Engineering" if i % 2 else "Sales", "Data", "IC3", ts(-200), None) for i in range(8)]
    return make_tables(spark, apps, events, offers, requisitions=requisitions)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_names_are_read_by_another_session_and_replaced_by_a_second_run(spark, scratch_dir):
    fixed = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    first, second = _tables(spark), _tables(spark, 2, 90)
    C.save_run(first, "hiring_a", scratch_dir, 4, detected_ts=fixed)
    C.save_run(second, "hiring_a", scratch_dir, 4, detected_ts=fixed)
    other = spark.newSession()
    want = reporting_views(second, fixed)
    assert other.table("hiring_a.applications").count() == 90
    for name in C.reporting_sql("hiring_a"):
        got, expected = other.table(f"hiring_a.{name}"), want[name]
        assert sorted(got.columns) == sorted(expected.columns), name
        cols = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in sorted(expected.dtypes)]
        assert rows(got.select(*cols)) == rows(expected.select(*cols)), name
        assert got.count() > 0, name
    life = lifecycle(second.applications, second.stage_events, second.candidates, second.requisitions)
    assert rows(other.sql(f"SELECT {', '.join(M.LIFECYCLE_MART_COLUMNS)} FROM hiring_a.mart_application_lifecycle")) == rows(life.select(*M.LIFECYCLE_MART_COLUMNS))
    versions = {t.name.split(C.MARK)[1] for t in spark.catalog.listTables("hiring_a") if C.MARK in t.name}
    assert len(versions) == 1  # the first run's tables are gone from the catalog
    C.drop_run(spark, "hiring_a")
    assert spark.catalog.listTables("hiring_a") == []
    C.drop_run(spark, "hiring_a")  # nothing there: no error


def test_views_on_no_rows(spark, scratch_dir):
    C.save_run(make_tables(spark, []), "hiring_none", scratch_dir, 2)
    for name in C.reporting_sql("hiring_none"):
        assert spark.table(f"hiring_none.{name}").count() == 0


def test_files_of_a_clustered_table_do_not_overlap(spark, scratch_dir):
    rnd = random.Random(4)
    data = [(rnd.choice(["hot"] * 10 + [f"r{i:02d}" for i in range(20)]), rnd.choice("pq"), f"a{i:05d}", i) for i in range(4000)]
    df = spark.createDataFrame(data, "recruiter_id string, org string, application_id string, n int")
    path = write_clustered(df, scratch_dir + "/c", ("recruiter_id", "org", "application_id"), 8)
    files = glob.glob(path + "/*.parquet")
    assert len(files) == 8
    bounds = []
    for f in files:
        t = pq.read_table(f, columns=["recruiter_id", "org", "application_id"]).to_pylist()
        keys = [tuple(r.values()) for r in t]
        assert keys == sorted(keys)  # sorted within the file
        bounds.append((keys[0], keys[-1]))
    bounds.sort()
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
    assert max(len(pq.read_table(f)) for f in files) < 1000  # the hot recruiter is split
    ranges = file_ranges(spark.read.parquet(path), "recruiter_id").collect()
    assert sum(r["low"] <= "r07" <= r["high"] for r in ranges) == 1  # a filter on recruiter reads one file
    stats = [pq.ParquetFile(f).metadata.row_group(0).column(0).statistics for f in files]
    assert sum(s.min <= "r07" <= s.max for s in stats) == 1


def test_saved_marts_keep_their_clusters(spark, scratch_dir):
    C.save_run(_tables(spark), "hiring_c", scratch_dir, 3)
    r = sorted((x["low"] or "", x["high"] or "") for x in file_ranges(spark.table(_version(spark, "hiring_c", M.MART_SLA_BREACHES)), "recruiter_id").collect())
    assert 1 < len(r) <= 3 and all(a[1] <= b[0] for a, b in zip(r, r[1:]))


def _version(spark, db, name):
    return next(f"{db}.{t.name}" for t in spark.catalog.listTables(db) if t.name.startswith(name + C.MARK))


def test_joins_of_bucketed_tables_plan_no_exchange(spark, scratch_dir, no_broadcast):
    C.save_run(_tables(spark), "hiring_b", scratch_dir, 5)
    joined = spark.sql("SELECT l.org, e.exception_type FROM hiring_b.mart_application_lifecycle l JOIN hiring_b.mart_data_exceptions e USING (application_id)")
    assert "SortMergeJoin" in _plan(joined) and "Exchange" not in _plan(joined)
    apps, events = spark.table("hiring_b.applications"), spark.table("hiring_b.stage_events")
    life = lifecycle(apps, events, None, None)
    assert "Exchange" not in _plan(life)  # neither the events nor the applications move
    t = _tables(spark)
    assert rows(life) == rows(lifecycle(t.applications, t.stage_events, None, None))
    assert rows(latest_stage(events)) == rows(latest_stage(t.stage_events))
    files = glob.glob(os.path.join(scratch_dir, "*", "applications", "*.parquet"))
    assert len(files) == 5  # one file per bucket
    by_candidate = apps.join(spark.table("hiring_b.candidates"), "candidate_id")
    assert _plan(by_candidate).count("Exchange hashpartitioning(candidate_id") == 1  # only the applications move


def test_save_table_replaces(spark, scratch_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS hiring_d")
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    save_table(df, "hiring_d.t", scratch_dir + "/1", Layout(bucket=("k",)), 2)
    save_table(df.where("id < 4"), "hiring_d.t", scratch_dir + "/2", Layout(cluster=("k", "id")), 2)
    assert spark.newSession().table("hiring_d.t").count() == 4
    assert clustered(df, ("k",), 3).count() == 10
