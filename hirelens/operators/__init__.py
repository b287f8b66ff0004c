"""Relational operators of the hiring model (all built-in Spark expressions)."""

from hirelens.operators.constraints import audit_constraints, enforce_constraints
from hirelens.operators.funnel import funnel_metrics, kpi_summary
from hirelens.operators.stages import latest_stage, lifecycle, promote_events, stage_durations
from hirelens.operators.rules import data_exceptions, exception_rate
from hirelens.operators.sla import sla_breaches, sla_compliance, sla_compliance_rollup, sla_transitions

__all__ = [
    "audit_constraints",
    "data_exceptions",
    "enforce_constraints",
    "exception_rate",
    "funnel_metrics",
    "kpi_summary",
    "latest_stage",
    "lifecycle",
    "promote_events",
    "sla_breaches",
    "sla_compliance",
    "sla_compliance_rollup",
    "sla_transitions",
    "stage_durations",
]
