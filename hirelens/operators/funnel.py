"""Conversion funnel and headline KPIs over the lifecycle table.

All of these are a single hash aggregate with map-side partial
aggregation; group counts are small and a hot group only ever carries one
partial row per map task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.ratio import safe_ratio
from hirelens.functions.time import week_start

COUNTS = ("applied", "screened", "onsite", "offered", "hired")
RATES = ("applied_to_screen_rate", "screen_to_onsite_rate", "onsite_to_offer_rate", "offer_to_hire_rate")
FUNNEL_KEYS = ("org", "job_family", "source", "apply_week")


def _key(name: str) -> Column:
    if name == "apply_week":
        return week_start("applied_ts").alias("apply_week")
    return F.col(name)


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("applied"),
        F.count("screen_ts").alias("screened"),
        F.count("onsite_ts").alias("onsite"),
        F.count("offer_ts").alias("offered"),
        F.count("hired_ts").alias("hired"),
    ]


def _rates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "applied_to_screen_rate": safe_ratio(F.col("screened"), F.col("applied")),
            "screen_to_onsite_rate": safe_ratio(F.col("onsite"), F.col("screened")),
            "onsite_to_offer_rate": safe_ratio(F.col("offered"), F.col("onsite")),
            "offer_to_hire_rate": safe_ratio(F.col("hired"), F.col("offered")),
        }
    )


def funnel_metrics(life: DataFrame, by: Sequence[str] = FUNNEL_KEYS) -> DataFrame:
    """Stage counts and step conversion rates per group.

    ``applied`` counts every application in the group (including those
    without events, which fall in the null week); the other steps count
    non-null stage times and do not require earlier steps. Rates are null
    when their denominator is zero. ``by`` may name any lifecycle column or
    ``apply_week`` (Monday-based week of the APPLIED event).
    """
    return _rates(life.groupBy(*[_key(k) for k in by]).agg(*_counts()))


#: grain -> the funnel keys that it keeps
GRAINS = {"OVERALL": (), "SOURCE": ("source",), "ORG": ("org",), "WEEK": ("apply_week",), "FULL": FUNNEL_KEYS}


def funnel_grains(life: DataFrame) -> DataFrame:
    """The funnel at every grain of ``GRAINS`` in one aggregate (grouping
    sets): ``grain``, the keys (null where a grain leaves one out; ``grain``
    tells that from a null key), counts and rates. No rows give no rows."""
    weeks = life.withColumn("apply_week", _key("apply_week"))
    sets = [[F.col(k) for k in keys] for keys in GRAINS.values()]
    agg = weeks.groupingSets(sets, *FUNNEL_KEYS).agg(F.grouping_id().alias("_id"), *_counts())
    # a bit per key, from the left, set where the grain leaves it out
    left_out = {name: sum((k not in keys) << i for i, k in enumerate(reversed(FUNNEL_KEYS))) for name, keys in GRAINS.items()}
    grain = F.lit(None)
    for name, bits in left_out.items():
        grain = F.when(F.col("_id") == bits, name).otherwise(grain)
    return _rates(agg.where("applied > 0").withColumn("grain", grain)).select("grain", *FUNNEL_KEYS, *COUNTS, *RATES)


def kpi_summary(life: DataFrame) -> DataFrame:
    """Whole-population KPIs: stage counts, step rates, offer acceptance
    rate (hired / offered) and time to hire (days from APPLIED to HIRED,
    over applications that have both)."""
    agg = life.agg(
        *_counts(),
        F.count("total_time_to_hire").alias("hires_with_time_to_hire"),
        F.avg("total_time_to_hire").alias("avg_time_to_hire_days"),
    )
    return _rates(agg).withColumn("offer_acceptance_rate", safe_ratio(F.col("hired"), F.col("offered")))
