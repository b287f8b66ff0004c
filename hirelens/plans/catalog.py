"""Tables and views by name, for sessions other than the one that made them.

``save_run`` stores the hiring tables and the four marts as catalog tables of
one version (``name__<version>``) in their declared layout and then points the
plain names at them, one ``CREATE OR REPLACE VIEW`` each: a name always reads a
whole table, also while a new version is written, and a second run replaces the
first. The reporting views are SQL text over these names, so any session with
the same catalog reads them. Older versions are dropped from the catalog; their
files are left to ``plans.publish.sweep`` or the storage's own retention, so
that queries in flight can end.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column, SparkSession

from hirelens.constants import SLA_PERCENTILE, SLA_TRANSITIONS, STAGE_COLUMNS, STAGES, TERMINAL_STAGES
from hirelens.functions.percentile import BITS
from hirelens.model import HiringTables
from hirelens.operators.rules import data_exceptions
from hirelens.operators.sla import sla_breaches, sla_compliance, sla_transitions
from hirelens.operators.stages import LIFECYCLE_COLUMNS, lifecycle, promote_events
from hirelens.plans import marts as M
from hirelens.plans import views as V
from hirelens.plans.layout import LAYOUTS, Layout, layout_of, save_table
from hirelens.sources.files import INPUT_TABLES

MARK = "__"


def save_run(
    tables: HiringTables,
    database: str,
    root: str,
    parts: int,
    layouts: Mapping[str, Layout] = LAYOUTS,
    detected_ts: Column | None = None,
    duplicate_mode: str = "reference",
) -> str:
    """Store tables and marts below ``root``/<version>, switch the names in
    ``database`` to them and return the version. ``parts``: files or buckets
    of a table."""
    spark = tables.applications.sparkSession
    version = uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    saved: list[str] = []

    def store(name, df):
        saved.append(name)
        return save_table(df, f"{database}.{name}{MARK}{version}", f"{root.rstrip('/')}/{version}/{name}", layout_of(name, layouts), parts)

    t = HiringTables(**{name: store(name, getattr(tables, name)) for name in INPUT_TABLES})
    t = replace(t, stage_events=store("stage_events", promote_events(t.stage_events_raw, t.applications)))
    life = store(M.MART_LIFECYCLE, lifecycle(t.applications, t.stage_events, t.candidates, t.requisitions).select(*M.LIFECYCLE_MART_COLUMNS))
    log = data_exceptions(t.stage_events_raw, t.applications, life, t.offers, detected_ts, duplicate_mode=duplicate_mode)
    store(M.MART_EXCEPTIONS, log.select(*M.EXCEPTION_MART_COLUMNS))
    breaches = store(M.MART_SLA_BREACHES, sla_breaches(sla_transitions(life)).select(*M.BREACH_MART_COLUMNS))
    store(M.MART_SLA_COMPLIANCE, sla_compliance(breaches).select(*M.COMPLIANCE_MART_COLUMNS))
    for name in saved:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {database}.{name}{MARK}{version}")
    create_reporting_views(spark, database)
    _drop_versions(spark, database, keep=version)
    return version


def _drop_versions(spark: SparkSession, database: str, keep: str) -> None:
    for t in spark.catalog.listTables(database):
        if MARK in t.name and not t.name.endswith(MARK + keep):
            spark.sql(f"DROP TABLE IF EXISTS {database}.{t.name}")


def drop_run(spark: SparkSession, database: str) -> None:
    """Drop every view and table of ``save_run``, if there are any."""
    for name in (*reporting_sql(database), *INPUT_TABLES, "stage_events", *M.mart_paths("").as_dict()):
        spark.sql(f"DROP VIEW IF EXISTS {database}.{name}")
    _drop_versions(spark, database, keep="")


def _micros(start: str, end: str) -> str:
    """Whole microseconds; zone-less, as ``functions.time.micros_between``."""
    return f"CAST(CAST({end} - {start} AS DECIMAL(20,6)) * 1000000 AS BIGINT)"


def _days(start: str, end: str) -> str:
    return f"CAST({_micros(start, end)} AS DOUBLE) / 86400000000D"


def _ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / CAST(nullif({b}, 0) AS DOUBLE)"


def _latest_sql(db: str) -> str:
    order = f"array_position(array({', '.join(map(repr, STAGES))}), stage)"
    return f"""
SELECT application_id, CASE WHEN stage_ts IS NOT NULL THEN stage END AS latest_stage, stage_ts AS latest_stage_ts
FROM (SELECT application_id, stage, stage_ts,
             row_number() OVER (PARTITION BY application_id ORDER BY stage_ts DESC NULLS LAST, {order} DESC NULLS LAST, stage) AS place
      FROM {db}.stage_events)
WHERE place = 1"""


def _lifecycle_sql(db: str) -> str:
    times = ", ".join(f"max(stage_ts) FILTER (WHERE stage = '{s}') AS {c}" for s, c in STAGE_COLUMNS.items())
    decided = "coalesce(hired_ts, rejected_ts, withdrawn_ts)"
    derived = {
        "terminal_stage": f"CASE WHEN latest_stage IN ({', '.join(map(repr, TERMINAL_STAGES))}) THEN latest_stage END",
        "days_applied_to_screen": _days("applied_ts", "screen_ts"),
        "days_screen_to_onsite": _days("screen_ts", "onsite_ts"),
        "days_onsite_to_offer": _days("onsite_ts", "offer_ts"),
        "days_offer_to_decision": _days("offer_ts", decided),
        "total_time_to_hire": _days("applied_ts", "hired_ts"),
    }
    columns = ",\n       ".join(f"{derived[c]} AS {c}" if c in derived else c for c in LIFECYCLE_COLUMNS)
    return f"""
SELECT {columns}
FROM {db}.applications
LEFT JOIN (SELECT req_id, org, job_family FROM {db}.requisitions) USING (req_id)
LEFT JOIN (SELECT candidate_id, source FROM {db}.candidates) USING (candidate_id)
LEFT JOIN (SELECT application_id, {times} FROM {db}.stage_events GROUP BY application_id) USING (application_id)
LEFT JOIN {db}.{V.VIEW_LATEST_STAGE} USING (application_id)"""


def _funnel_sql(db: str) -> str:
    steps = ("applied", "screened", "onsite", "offered", "hired")
    rates = ("applied_to_screen_rate", "screen_to_onsite_rate", "onsite_to_offer_rate", "offer_to_hire_rate")
    week = "CAST(date_sub(to_date(applied_ts), (dayofweek(applied_ts) + 5) % 7) AS TIMESTAMP_NTZ)"
    counts = "count(*) AS applied, count(screen_ts) AS screened, count(onsite_ts) AS onsite, count(offer_ts) AS offered, count(hired_ts) AS hired"
    return f"""
SELECT *, {', '.join(f'{_ratio(b, a)} AS {r}' for a, b, r in zip(steps, steps[1:], rates))}
FROM (SELECT org, job_family, source, {week} AS apply_week, {counts} FROM {db}.{V.VIEW_LIFECYCLE} GROUP BY ALL)"""


def _transitions_sql(db: str) -> str:
    decided = "coalesce(hired_ts, rejected_ts, withdrawn_ts)"
    rows = ", ".join(
        f"struct('{name}' AS transition_name, {start} AS start_ts, {decided if end == 'decision_ts' else end} AS end_ts, {days} AS duration_days, {target} AS sla_days)"
        for name, start, end, days, target in SLA_TRANSITIONS
    )
    return f"""
SELECT application_id, recruiter_id, org, t.*
FROM (SELECT application_id, recruiter_id, org, explode(array({rows})) AS t FROM {db}.{V.VIEW_LIFECYCLE})
WHERE t.start_ts IS NOT NULL AND t.end_ts IS NOT NULL"""


def _breaches_sql(db: str) -> str:
    return f"SELECT *, duration_days > sla_days AS is_breach FROM {db}.{V.VIEW_SLA_TRANSITIONS} WHERE duration_days >= 0"


def _summary_sql(db: str, percentile: float = SLA_PERCENTILE) -> str:
    """The percentile as ``functions.percentile`` finds it: through nested
    parts of the durations, never a whole group at once."""
    keys = "recruiter_id, org, transition_name"
    pos = f"{percentile}D * (total - 1)"
    holds = "k >= upto - w AND k < upto"
    return f"""
WITH counted AS (
  SELECT struct({keys}) AS g, is_breach, v, shiftrightunsigned(v, {2 * BITS}) AS a, shiftrightunsigned(v, {BITS}) AS b, count(*) AS w
  FROM (SELECT *, {_micros("start_ts", "end_ts")} AS v FROM {db}.{V.VIEW_SLA_BREACHES}) GROUP BY ALL
), inners AS (
  SELECT *, sum(w) OVER (PARTITION BY g, a ORDER BY b) AS upto
  FROM (SELECT g, a, b, sum(w) AS w, sum(if(is_breach, w, 0L)) AS late, sum(CAST(v * w AS DECIMAL(38,0))) AS micros FROM counted GROUP BY g, a, b)
), outers AS (
  SELECT *, sum(w) OVER (PARTITION BY g ORDER BY a) AS upto, sum(w) OVER (PARTITION BY g) AS total,
         sum(late) OVER (PARTITION BY g) AS all_late, sum(micros) OVER (PARTITION BY g) AS all_micros
  FROM (SELECT g, a, sum(w) AS w, sum(late) AS late, sum(micros) AS micros FROM inners GROUP BY g, a)
), ranked AS (
  SELECT *, explode(array(struct(CAST(floor({pos}) AS BIGINT) AS k, 0 AS i), struct(CAST(ceil({pos}) AS BIGINT) AS k, 1 AS i))) AS r FROM outers
), outer_part AS (
  SELECT g, a, r.i AS i, r.k - (upto - w) AS k, total, all_late, all_micros FROM (SELECT *, r.k AS k FROM ranked) WHERE {holds}
), inner_part AS (
  SELECT g, a, b, i, k - (upto - w) AS k, total, all_late, all_micros FROM inners JOIN outer_part USING (g, a) WHERE {holds}
), found AS (
  SELECT * FROM (SELECT *, sum(w) OVER (PARTITION BY g, a, b, i ORDER BY v, is_breach ROWS UNBOUNDED PRECEDING) AS upto FROM counted JOIN inner_part USING (g, a, b))
  WHERE {holds}
), ends AS (
  SELECT g, max(total) AS total, max(all_late) AS late, max(all_micros) AS micros,
         max(v) FILTER (WHERE i = 0) / 86400000000D AS x, max(v) FILTER (WHERE i = 1) / 86400000000D AS y
  FROM found GROUP BY g
)
SELECT g.*, total AS total_cases, late AS breaches, 1.0D - {_ratio("late", "total")} AS compliance_rate,
       CAST(micros AS DOUBLE) / total / 86400000000D AS avg_duration_days,
       x + ({pos} - floor({pos})) * (y - x) AS p90_duration_days
FROM ends"""


def reporting_sql(database: str) -> dict[str, str]:
    """The reporting views as SQL text, each after those that it reads. The
    exception log is read from its mart: it is evaluated when the run is made."""
    return {
        V.VIEW_LATEST_STAGE: _latest_sql(database),
        V.VIEW_LIFECYCLE: _lifecycle_sql(database),
        V.VIEW_FUNNEL: _funnel_sql(database),
        V.VIEW_EXCEPTIONS: f"SELECT * FROM {database}.{M.MART_EXCEPTIONS}",
        V.VIEW_SLA_TRANSITIONS: _transitions_sql(database),
        V.VIEW_SLA_BREACHES: _breaches_sql(database),
        V.VIEW_SLA_SUMMARY: _summary_sql(database),
    }


def create_reporting_views(spark: SparkSession, database: str) -> list[str]:
    views = reporting_sql(database)
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text}")
    return sorted(views)
