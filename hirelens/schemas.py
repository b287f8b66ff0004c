"""Declared schemas, keys and constraints of the seven hiring tables.

Ids default to strings (UUID text); every operator is generic over the id
type, and ``id_type`` switches the declared schemas to ``long``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from hirelens.constants import ACTOR_TYPES, COMP_BANDS, DECISIONS, LEVELS, STAGES

TABLES = (
    "candidates",
    "requisitions",
    "applications",
    "stage_events_raw",
    "stage_events",
    "offers",
    "hires",
)


def _id(id_type: str) -> T.DataType:
    return T.LongType() if id_type == "long" else T.StringType()


def table_schema(name: str, id_type: str = "string") -> T.StructType:
    """StructType of one table; every column nullable at read time so that
    missing values reach the not-null audit instead of failing the scan."""
    i = _id(id_type)
    ts = T.TimestampNTZType()
    s = T.StringType()
    cols: dict[str, list[tuple[str, T.DataType]]] = {
        "candidates": [
            ("candidate_id", i),
            ("created_at", ts),
            ("source", s),
            ("location", s),
            ("years_experience", T.IntegerType()),
            ("email_hash", s),
        ],
        "requisitions": [
            ("req_id", i),
            ("org", s),
            ("job_family", s),
            ("level", s),
            ("open_date", ts),
            ("close_date", ts),
        ],
        "applications": [
            ("application_id", i),
            ("candidate_id", i),
            ("req_id", i),
            ("apply_ts", ts),
            ("recruiter_id", i),
        ],
        "stage_events_raw": [
            ("event_id", s),
            ("application_id", i),
            ("stage", s),
            ("stage_ts", ts),
            ("actor_type", s),
        ],
        "offers": [
            ("offer_id", s),
            ("application_id", i),
            ("offer_ts", ts),
            ("decision", s),
            ("comp_band", s),
        ],
        "hires": [
            ("hire_id", s),
            ("application_id", i),
            ("hired_ts", ts),
            ("start_date", T.DateType()),
        ],
    }
    cols["stage_events"] = cols["stage_events_raw"]
    return T.StructType([T.StructField(n, t, True) for n, t in cols[name]])


@dataclass(frozen=True)
class TableSpec:
    """Declared constraints of one table (what the DDL would enforce)."""

    name: str
    primary_key: str
    not_null: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[tuple[str, str, str], ...] = ()  # (column, parent, parent key)
    domains: tuple[tuple[str, tuple[str, ...]], ...] = ()
    max_length: tuple[tuple[str, int], ...] = ()
    ranges: tuple[tuple[str, int, int], ...] = ()
    date_orders: tuple[tuple[str, str], ...] = ()  # (earlier, later)


_EVENT_COLS = ("event_id", "application_id", "stage", "stage_ts", "actor_type")

SPECS: dict[str, TableSpec] = {
    "candidates": TableSpec(
        name="candidates",
        primary_key="candidate_id",
        not_null=("candidate_id", "created_at", "source", "location", "years_experience", "email_hash"),
        max_length=(("source", 50), ("location", 100), ("email_hash", 100)),
        ranges=(("years_experience", 0, 50),),
    ),
    "requisitions": TableSpec(
        name="requisitions",
        primary_key="req_id",
        not_null=("req_id", "org", "job_family", "level", "open_date"),
        domains=(("level", LEVELS),),
        max_length=(("org", 100), ("job_family", 100), ("level", 10)),
        date_orders=(("open_date", "close_date"),),
    ),
    "applications": TableSpec(
        name="applications",
        primary_key="application_id",
        not_null=("application_id", "candidate_id", "req_id", "apply_ts"),
        unique=(("candidate_id", "req_id", "apply_ts"),),
        foreign_keys=(
            ("candidate_id", "candidates", "candidate_id"),
            ("req_id", "requisitions", "req_id"),
        ),
    ),
    "stage_events_raw": TableSpec(
        name="stage_events_raw",
        primary_key="event_id",
        not_null=_EVENT_COLS,
        unique=(("application_id", "stage", "stage_ts"),),
        domains=(("stage", STAGES), ("actor_type", ACTOR_TYPES)),
        max_length=(("stage", 50), ("actor_type", 50)),
    ),
    "stage_events": TableSpec(
        name="stage_events",
        primary_key="event_id",
        not_null=_EVENT_COLS,
        unique=(("application_id", "stage", "stage_ts"),),
        foreign_keys=(("application_id", "applications", "application_id"),),
        domains=(("stage", STAGES), ("actor_type", ACTOR_TYPES)),
        max_length=(("stage", 50), ("actor_type", 50)),
    ),
    "offers": TableSpec(
        name="offers",
        primary_key="offer_id",
        not_null=("offer_id", "application_id", "offer_ts", "decision", "comp_band"),
        foreign_keys=(("application_id", "applications", "application_id"),),
        domains=(("decision", DECISIONS), ("comp_band", COMP_BANDS)),
        max_length=(("decision", 50), ("comp_band", 10)),
    ),
    "hires": TableSpec(
        name="hires",
        primary_key="hire_id",
        not_null=("hire_id", "application_id", "hired_ts", "start_date"),
        foreign_keys=(("application_id", "applications", "application_id"),),
    ),
}
