"""Event promotion, latest stage and the per-application lifecycle row.

Plan shape (what makes this hold at scale):

* The events are read once and reduced in ONE hash aggregate of fixed-width
  maxima, one per stage and one over all, partially on the map side, so a
  single application that carries a third of all events still ships one row
  per map task. The latest stage follows from these maxima. The name of a stage
  outside the domain is a key of the aggregate instead, null for all others, so
  clean data has one row per application.
* One window without an order over these rows puts an application's few rows
  together: one sort by ``application_id``, which the join with the
  applications takes over, so only the application table is shuffled to meet it.
* Dimensions are joined narrowly (key + needed columns); Spark broadcasts
  those whose measured size allows it and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelens.constants import STAGE_COLUMNS, STAGES, TERMINAL_STAGES
from hirelens.functions.time import EPOCH_NTZ, days_between

EVENT_COLUMNS = ("event_id", "application_id", "stage", "stage_ts", "actor_type")


def promote_events(stage_events_raw: DataFrame, applications: DataFrame) -> DataFrame:
    """Raw events whose application exists (the FK-clean event table).

    A left-semi join: never multiplies events even if the application key
    is duplicated, and the other side is only the application id column. That
    side is hashed, each id once: the events need no sort.
    """
    ids = applications.select("application_id").hint("shuffle_hash")
    return stage_events_raw.select(*EVENT_COLUMNS).join(ids, "application_id", "left_semi").select(*EVENT_COLUMNS)


def _pivot(stage_events: DataFrame) -> DataFrame:
    """One row per application: the latest time of each stage, the latest stage
    and its time. Events that share a time are ordered by stage: the later one
    in the pipeline wins, a stage outside the domain loses to those in it (the
    least name wins), a null stage to all. An event without a time is never the
    latest."""
    odd = F.when(F.col("stage").isNotNull() & ~F.col("stage").isin(*STAGES), F.col("stage")).alias("_odd")
    aggs = {STAGE_COLUMNS[s]: F.max(F.when(F.col("stage") == s, F.col("stage_ts"))) for s in STAGES}
    aggs["latest_stage_ts"] = F.max("stage_ts")
    parts = stage_events.groupBy("application_id", odd).agg(*[c.alias(name) for name, c in aggs.items()])
    app = Window.partitionBy("application_id")
    # how long before a fixed time, so that the least is the latest, then the first by name
    age = lambda ts: F.lit(EPOCH_NTZ).cast("timestamp_ntz") - F.col(ts)
    named = F.when(F.col("_odd").isNotNull() & F.col("latest_stage_ts").isNotNull(), F.struct(age("latest_stage_ts").alias("age"), F.col("_odd").alias("name")))
    rows = parts.select(
        "application_id",
        "_odd",
        *[F.max(name).over(app).alias(name) for name in aggs],
        F.min(named).over(app).alias("_named"),
        F.max(F.col("_odd").isNull()).over(app).alias("_plain"),
        F.min("_odd").over(app).alias("_least"),
    ).where("_odd IS NULL OR (NOT _plain AND _odd = _least)")
    name = F.when(F.col("_named.age") == age("latest_stage_ts"), F.col("_named.name"))
    for s in STAGES:
        name = F.when(F.col(STAGE_COLUMNS[s]) == F.col("latest_stage_ts"), F.lit(s)).otherwise(name)
    return rows.select("application_id", *aggs, name.alias("latest_stage"))


def latest_stage(stage_events: DataFrame) -> DataFrame:
    """Last event per application: (application_id, latest_stage,
    latest_stage_ts). Ordered by time, then by pipeline rank on ties. A last
    event without a stage gives a null stage, one outside the domain its own
    text.

    Grouped maxima instead of a window over the events: they aggregate
    partially before the shuffle, so hot applications do not pile up in a
    single task.
    """
    return _pivot(stage_events).select("application_id", "latest_stage", "latest_stage_ts")


def terminal_stage(latest: Column | str = "latest_stage") -> Column:
    col = F.col(latest) if isinstance(latest, str) else latest
    return F.when(col.isin(*TERMINAL_STAGES), col).otherwise(F.lit(None).cast("string"))


def decision_ts() -> Column:
    """Decision time: first non-null of hired, rejected, withdrawn
    (priority order, not the earliest)."""
    return F.coalesce(F.col("hired_ts"), F.col("rejected_ts"), F.col("withdrawn_ts"))


def duration_columns() -> dict[str, Column]:
    """The five lifecycle durations in fractional days, null when either end is
    null. (No ``when`` around them: Spark works an interval out once where it is
    not conditional.)"""
    return {
        "days_applied_to_screen": days_between("applied_ts", "screen_ts"),
        "days_screen_to_onsite": days_between("screen_ts", "onsite_ts"),
        "days_onsite_to_offer": days_between("onsite_ts", "offer_ts"),
        "days_offer_to_decision": days_between(F.col("offer_ts"), decision_ts()),
        "total_time_to_hire": days_between("applied_ts", "hired_ts"),
    }


LIFECYCLE_COLUMNS = (
    "application_id",
    "candidate_id",
    "req_id",
    "recruiter_id",
    "source",
    "org",
    "job_family",
    *[STAGE_COLUMNS[s] for s in STAGES],
    "latest_stage",
    "latest_stage_ts",
    "terminal_stage",
    "days_applied_to_screen",
    "days_screen_to_onsite",
    "days_onsite_to_offer",
    "days_offer_to_decision",
    "total_time_to_hire",
)


def lifecycle(
    applications: DataFrame,
    stage_events: DataFrame,
    candidates: DataFrame | None,
    requisitions: DataFrame | None,
) -> DataFrame:
    """One row per application: dimensions, seven stage times, latest and
    terminal stage and five durations.

    Applications without events keep a row of nulls (left joins from the
    application table). Events are aggregated before the join, which is
    equivalent to joining first because every dimension is 1:1 by key.

    Dimension joins: Spark picks the strategy from statistics, and AQE turns
    a shuffle join into a broadcast join only when the measured shuffle output
    of the dimension is below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``.

    Pass ``None`` for a dimension a consumer does not need (the exception
    rules need neither; the SLA chain needs only the requisition's org): its
    join and columns are left out, which at scale saves a shuffle of the
    application table by candidate.
    """
    # ONE projection for every derived column: each DataFrame step is analysed
    # on the driver, so fewer steps plan faster.
    base = applications.select("application_id", "candidate_id", "req_id", "recruiter_id")
    skipped: set[str] = set()
    if requisitions is not None:
        base = base.join(requisitions.select("req_id", "org", "job_family"), "req_id", "left")
    else:
        skipped |= {"org", "job_family"}
    if candidates is not None:
        base = base.join(candidates.select("candidate_id", "source"), "candidate_id", "left")
    else:
        skipped.add("source")
    base = base.join(_pivot(stage_events), "application_id", "left")
    derived = {"terminal_stage": terminal_stage(), **duration_columns()}
    return base.select(
        *[derived[c].alias(c) if c in derived else F.col(c) for c in LIFECYCLE_COLUMNS if c not in skipped]
    )


def stage_durations(life: DataFrame) -> DataFrame:
    """Application id plus the five durations."""
    return life.select("application_id", *duration_columns().keys())
