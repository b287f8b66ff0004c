"""Named SQL views over the reporting operators.

Registers session temp views under the names reporting users already
query, so existing SQL keeps working through ``spark.sql``:

    v_application_latest_stage, v_application_lifecycle, v_funnel_metrics,
    v_data_exceptions, v_sla_transitions, v_sla_breaches,
    v_sla_compliance_summary

plus the input tables themselves. Views are lazy plans; nothing is
computed until a query reads them. ``register_mart_views`` exposes written
marts under their table names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from hirelens.model import HiringTables
from hirelens.operators.funnel import funnel_metrics
from hirelens.operators.rules import data_exceptions
from hirelens.operators.sla import sla_breaches, sla_compliance, sla_transitions
from hirelens.operators.stages import latest_stage, lifecycle
from hirelens.plans.marts import MartPaths, mart_schemas, read_mart

# The view names reporting SQL refers to.
VIEW_LATEST_STAGE = "v_application_latest_stage"
VIEW_LIFECYCLE = "v_application_lifecycle"
VIEW_FUNNEL = "v_funnel_metrics"
VIEW_EXCEPTIONS = "v_data_exceptions"
VIEW_SLA_TRANSITIONS = "v_sla_transitions"
VIEW_SLA_BREACHES = "v_sla_breaches"
VIEW_SLA_SUMMARY = "v_sla_compliance_summary"


def reporting_views(tables: HiringTables, detected_ts: Column | None = None) -> dict[str, DataFrame]:
    t = tables.with_promoted_events()
    life = lifecycle(t.applications, t.stage_events, t.candidates, t.requisitions)
    breaches = sla_breaches(sla_transitions(life))
    return {
        VIEW_LATEST_STAGE: latest_stage(t.stage_events),
        VIEW_LIFECYCLE: life,
        VIEW_FUNNEL: funnel_metrics(life),
        VIEW_EXCEPTIONS: data_exceptions(t.stage_events_raw, t.applications, life, t.offers, detected_ts),
        VIEW_SLA_TRANSITIONS: sla_transitions(life),
        VIEW_SLA_BREACHES: breaches,
        VIEW_SLA_SUMMARY: sla_compliance(breaches),
    }


def register_reporting_views(tables: HiringTables, detected_ts: Column | None = None) -> list[str]:
    """Register the input tables and the reporting views as temp views; each
    is computed anew whenever it is read."""
    tables.register_views()
    views = reporting_views(tables, detected_ts)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)


def register_mart_views(spark: SparkSession, paths: MartPaths, fmt: str = "parquet", id_type: str = "string") -> list[str]:
    """Expose written marts as temp views named like the mart tables."""
    schemas = mart_schemas(id_type) if fmt == "csv" else {}
    for name, path in paths.as_dict().items():
        read_mart(spark, path, fmt, schemas.get(name)).createOrReplaceTempView(name)
    return sorted(paths.as_dict())
