"""SLA transitions, breaches and compliance summaries.

* Transitions: ONE pass over the lifecycle table; the four transitions are
  an exploded array of structs (an unpivot), not four scans unioned.
* Breaches: a narrow filter + flag on top, no shuffle.
* Compliance: durations are counted in whole microseconds per (recruiter,
  org, transition) and an exact P90 is looked up in the counts part by part
  (``functions.percentile``), so no group meets in one task. A null
  recruiter is a group of its own.
* Rollup: the finest counts, added up to the coarser levels by grouping sets.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.constants import SLA_PERCENTILE, SLA_TRANSITIONS
from hirelens.functions.percentile import counted, percentile_of_counts
from hirelens.functions.ratio import safe_ratio
from hirelens.functions.time import MICROS_PER_DAY, micros_between
from hirelens.operators.stages import decision_ts

SLA_COLUMNS = (
    "application_id",
    "recruiter_id",
    "org",
    "transition_name",
    "start_ts",
    "end_ts",
    "duration_days",
    "sla_days",
)
COMPLIANCE_KEYS = ("recruiter_id", "org", "transition_name")


def default_targets() -> dict[str, int]:
    return {name: days for name, *_rest, days in SLA_TRANSITIONS}


def sla_transitions(life: DataFrame, targets: Mapping[str, int] | None = None) -> DataFrame:
    """One row per completed transition (both ends present) with its
    duration and target days."""
    targets = dict(targets or default_targets())
    ends = {"decision_ts": decision_ts()}
    items = []
    for name, start, end, duration, _ in SLA_TRANSITIONS:
        end_col = ends[end] if end in ends else F.col(end)
        items.append(
            F.when(
                F.col(start).isNotNull() & end_col.isNotNull(),
                F.struct(
                    F.lit(name).alias("transition_name"),
                    F.col(start).alias("start_ts"),
                    end_col.alias("end_ts"),
                    F.col(duration).alias("duration_days"),
                    F.lit(int(targets[name])).cast("int").alias("sla_days"),
                ),
            )
        )
    present = F.filter(F.array(*items), lambda x: x.isNotNull())
    return life.select("application_id", "recruiter_id", "org", F.explode(present).alias("_t")).select(
        "application_id",
        "recruiter_id",
        "org",
        *[F.col(f"_t.{c}").alias(c) for c in SLA_COLUMNS[3:]],
    )


def sla_breaches(transitions: DataFrame) -> DataFrame:
    """Transitions with a non-negative duration, flagged when the duration
    is strictly above target (equal complies). Negative durations belong
    to the exception log, not here."""
    return transitions.where(F.col("duration_days").isNotNull() & (F.col("duration_days") >= 0)).withColumn(
        "is_breach", F.col("duration_days") > F.col("sla_days")
    )


def _counted_durations(breaches: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key, duration in whole microseconds and breach flag. The flag
    is a key and not a second count: the percentile reads the counts twice, and
    only equal columns let both readings share one shuffle."""
    rows = breaches.select(*keys, "is_breach", micros_between("start_ts", "end_ts").alias("_micros"))
    return counted(rows, [*keys, "is_breach"], "_micros")


def _summary(counts: DataFrame, keys: list[str], percentile: float) -> DataFrame:
    late = F.when(F.col("is_breach"), F.col("_n")).otherwise(0).cast("long")
    sums = {"total_cases": F.col("_n"), "breaches": late, "_micros": (F.col("_v") * F.col("_n")).cast("decimal(38,0)")}
    out = percentile_of_counts(counts, keys, percentile, "p90_duration_days", MICROS_PER_DAY, sums)
    rate = F.lit(1.0) - safe_ratio(F.col("breaches"), F.col("total_cases"))
    mean = F.col("_micros").cast("double") / F.col("total_cases") / MICROS_PER_DAY
    return out.select(*keys, "total_cases", "breaches", rate.alias("compliance_rate"), mean.alias("avg_duration_days"), "p90_duration_days")


def sla_compliance(breaches: DataFrame, percentile: float = SLA_PERCENTILE) -> DataFrame:
    """Cases, breaches, compliance rate, mean and exact interpolated P90
    duration per recruiter, org and transition; ``breaches`` as of
    ``sla_breaches``. Lazy: nothing runs or is written here."""
    keys = list(COMPLIANCE_KEYS)
    return _summary(_counted_durations(breaches, keys), keys, percentile)


LEVELS = ("TRANSITION", "ORG", "RECRUITER")


def sla_compliance_rollup(breaches: DataFrame, percentile: float = SLA_PERCENTILE) -> DataFrame:
    """Compliance at three levels per transition: all recruiters and orgs,
    per org, per org and recruiter (the grouping sets (t), (t, org),
    (t, org, recruiter)). ``grouping_level`` tells a subtotal from a null key.

    The breach rows are counted once at the finest level; the other levels
    add up these counts (a percentile follows from counts, not from finer
    percentiles)."""
    fine = _counted_durations(breaches, ["transition_name", "org", "recruiter_id"])
    finest = ["transition_name", "org", "recruiter_id"]
    sets = [[F.col(c) for c in (*finest[:n], "is_breach", "_v")] for n in (1, 2, 3)]
    counts = fine.groupingSets(sets, *finest, "is_breach", "_v").agg(F.grouping("org").alias("_org"), F.grouping("recruiter_id").alias("_recruiter"), F.sum("_n").alias("_n"))
    level = F.when(F.col("_org") == 1, LEVELS[0]).when(F.col("_recruiter") == 1, LEVELS[1]).otherwise(LEVELS[2])
    keys = ["grouping_level", *finest]
    counts = counts.select(level.alias("grouping_level"), *finest, "is_breach", "_v", "_n")
    return _summary(counts, keys, percentile)
