"""Driver contract: entry runs, every query has an oracle, and a sample of
queries matches DuckDB on sf0.001 (the full sweep is scripts/check_oracle.py)."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def _norm(rows):
    def n(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v

    return sorted((tuple(n(x) for x in r) for r in rows), key=repr)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"recruiter_id", "org", "transition_name", "p90_duration_days"} <= set(df.columns)


def test_every_hiring_query_has_oracle_sql():
    assert set(E._hiring_queries()) <= set(E.oracle_sql()) <= set(E.queries())


def test_building_a_query_starts_no_job(spark):
    """The marts and the CSV files are sinks and write; every other query is a lazy plan."""
    tracker = spark.sparkContext.statusTracker()
    for name, query in E._hiring_queries().items():
        if name.startswith(("mart_", "csv_")):
            continue
        spark.sparkContext.setJobGroup(f"build {name}", name)
        query(spark, SF)
        # reading a Parquet footer for its schema is a job of one task
        for job in tracker.getJobIdsForGroup(f"build {name}"):
            info = tracker.getJobInfo(job)
            tasks = [tracker.getStageInfo(s).numTasks for s in info.stageIds if tracker.getStageInfo(s)]
            assert sum(tasks) <= 1, name
    spark.sparkContext.setJobGroup("", "")


@pytest.mark.parametrize(
    "name",
    ["lifecycle", "data_exceptions", "sla_compliance", "funnel_metrics", "audit_unique", "exc_duplicate_application"],
)
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("customer", "nation", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    spark_rows = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    idx = [ocols.index(c) for c in sorted(ocols)]
    duck_rows = [tuple(r[i] for i in idx) for r in res.fetchall()]
    assert _norm(spark_rows) == _norm(duck_rows)
