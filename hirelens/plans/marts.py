"""Build the four reporting marts in dependency order.

The lifecycle is computed exactly once: its mart is written first and
every later mart is derived from the written table (a lineage cut in the
shared directory), so the exception rules and the SLA chain scan parquet
instead of re-running the event aggregation and the joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from hirelens.model import HiringTables
from hirelens.operators.stages import LIFECYCLE_COLUMNS, lifecycle
from hirelens.operators.rules import data_exceptions
from hirelens.operators.sla import sla_breaches, sla_compliance, sla_transitions
from hirelens.sources.files import read_csv
from hirelens.sources.sinks import write_table

MART_LIFECYCLE = "mart_application_lifecycle"
MART_EXCEPTIONS = "mart_data_exceptions"
MART_SLA_BREACHES = "mart_sla_breaches"
MART_SLA_COMPLIANCE = "mart_sla_compliance_summary"

LIFECYCLE_MART_COLUMNS = tuple(c for c in LIFECYCLE_COLUMNS if c != "latest_stage_ts")
EXCEPTION_MART_COLUMNS = ("exception_type", "severity", "application_id", "event_id", "details", "detected_ts")
BREACH_MART_COLUMNS = (
    "application_id",
    "recruiter_id",
    "org",
    "transition_name",
    "start_ts",
    "end_ts",
    "duration_days",
    "sla_days",
    "is_breach",
)
COMPLIANCE_MART_COLUMNS = (
    "recruiter_id",
    "org",
    "transition_name",
    "total_cases",
    "breaches",
    "compliance_rate",
    "avg_duration_days",
    "p90_duration_days",
)

@dataclass(frozen=True)
class MartPaths:
    lifecycle: str
    exceptions: str
    sla_breaches: str
    sla_compliance: str

    def as_dict(self) -> dict[str, str]:
        return {
            MART_LIFECYCLE: self.lifecycle,
            MART_EXCEPTIONS: self.exceptions,
            MART_SLA_BREACHES: self.sla_breaches,
            MART_SLA_COMPLIANCE: self.sla_compliance,
        }


def mart_schemas(id_type: str = "string") -> dict[str, T.StructType]:
    """Declared schema of each mart; ids as in the loaded tables."""
    ids = "bigint" if id_type == "long" else "string"
    kinds = {"application_id": ids, "candidate_id": ids, "req_id": ids, "recruiter_id": ids, "sla_days": "int", "is_breach": "boolean",
             "total_cases": "bigint", "breaches": "bigint", "compliance_rate": "double", "total_time_to_hire": "double", "detected_ts": "timestamp"}

    def kind(c: str) -> str:
        if c in kinds:
            return kinds[c]
        if c.endswith("_ts"):
            return "timestamp_ntz"
        return "double" if c.startswith("days_") or c.endswith("_days") else "string"

    columns = {
        MART_LIFECYCLE: LIFECYCLE_MART_COLUMNS,
        MART_EXCEPTIONS: EXCEPTION_MART_COLUMNS,
        MART_SLA_BREACHES: BREACH_MART_COLUMNS,
        MART_SLA_COMPLIANCE: COMPLIANCE_MART_COLUMNS,
    }
    return {name: T.StructType.fromDDL(", ".join(f"{c} {kind(c)}" for c in cs)) for name, cs in columns.items()}


def read_mart(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Read a written mart; CSV carries no types, so it needs ``schema``."""
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV mart is read with its declared schema (mart_schemas)")
        return read_csv(spark, path, schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.format(fmt).load(path)


def mart_paths(base: str) -> MartPaths:
    b = base.rstrip("/")
    return MartPaths(f"{b}/{MART_LIFECYCLE}", f"{b}/{MART_EXCEPTIONS}", f"{b}/{MART_SLA_BREACHES}", f"{b}/{MART_SLA_COMPLIANCE}")


def build_marts(
    tables: HiringTables,
    out_dir: str,
    detected_ts: Column | None = None,
    duplicate_mode: str = "reference",
    fmt: str = "parquet",
) -> MartPaths:
    """Write the four marts under ``out_dir`` (overwriting) and return
    their paths. ``out_dir`` is a run's own directory; ``plans.publish`` makes
    a finished run visible."""
    t = tables.with_promoted_events()
    spark = t.applications.sparkSession
    paths = mart_paths(out_dir)

    life = lifecycle(t.applications, t.stage_events, t.candidates, t.requisitions).select(*LIFECYCLE_MART_COLUMNS)
    write_table(life, paths.lifecycle, fmt)
    life_mart = read_mart(spark, paths.lifecycle, fmt, schema=life.schema)

    exc = data_exceptions(
        t.stage_events_raw, t.applications, life_mart, t.offers, detected_ts, duplicate_mode=duplicate_mode
    )
    write_table(exc.select(*EXCEPTION_MART_COLUMNS), paths.exceptions, fmt)

    breaches = sla_breaches(sla_transitions(life_mart)).select(*BREACH_MART_COLUMNS)
    write_table(breaches, paths.sla_breaches, fmt)
    breach_mart = read_mart(spark, paths.sla_breaches, fmt, schema=breaches.schema)

    write_table(sla_compliance(breach_mart).select(*COMPLIANCE_MART_COLUMNS), paths.sla_compliance, fmt)
    return paths
