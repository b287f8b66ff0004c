"""Data-quality rules and the exception log.

Every rule returns the same five columns (``exception_type``, ``severity``,
``application_id``, ``event_id``, ``details``); ``data_exceptions`` adds
``detected_ts`` and unions them.

Scale notes:

* The four lifecycle rules (stage order x2, negative duration, multiple
  terminals) run as ONE narrow pass over the lifecycle table
  (``explode`` of a filtered array), instead of four scans.
* The two offer rules share ONE join of offers with the onsite time.
* The duplicate rule forms no pairs: running and sliding minima over the
  times of a candidate and requisition, split by hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.constants import (
    DUPLICATE_WINDOW_DAYS,
    EXC_DUPLICATE,
    EXC_MISSING_RECRUITER,
    EXC_MULTIPLE_TERMINAL,
    EXC_NEGATIVE_DURATION,
    EXC_OFFER_BEFORE_ONSITE,
    EXC_OFFER_WITHOUT_ONSITE,
    EXC_ORPHAN,
    EXC_STAGE_ORDER,
    EXCEPTION_DETAILS,
)
from hirelens.functions.ratio import safe_ratio
from hirelens.functions.time import epoch_micros

EXCEPTION_COLUMNS = ("exception_type", "severity", "application_id", "event_id", "details")


def _no_event(event_id_type: str = "string") -> Column:
    return F.lit(None).cast(event_id_type).alias("event_id")


def _tagged(df: DataFrame, kind: tuple[str, str], details: Column | str, event_id: Column | None = None) -> DataFrame:
    detail_col = F.lit(details) if isinstance(details, str) else details
    return df.select(
        F.lit(kind[0]).alias("exception_type"),
        F.lit(kind[1]).alias("severity"),
        F.col("application_id"),
        event_id if event_id is not None else _no_event(),
        detail_col.alias("details"),
    )


# ---------------------------------------------------------------- raw-table rules


def rule_orphan_event(stage_events_raw: DataFrame, applications: DataFrame) -> DataFrame:
    """Raw events whose application does not exist (NOT EXISTS as a
    null-safe left-anti join). The only rule that fills ``event_id``. The ids
    are hashed, each once: the events need no sort."""
    orphans = stage_events_raw.select("event_id", "application_id").join(
        applications.select("application_id").hint("shuffle_hash"), "application_id", "left_anti"
    )
    return _tagged(
        orphans, EXC_ORPHAN, EXCEPTION_DETAILS["ORPHAN_STAGE_EVENT"], F.col("event_id").cast("string")
    )


_HOUR = 3_600_000_000


def duplicate_applications(applications: DataFrame, days: int = DUPLICATE_WINDOW_DAYS, mode: str = "reference") -> DataFrame:
    """The applications that have an earlier partner: another application of
    the same candidate for the same requisition within ``days``.

    ``mode="reference"``: the partner has a smaller id and the application
    lies in ``[partner, partner + days]`` (inclusive); partners with a greater
    id that applied first don't count. ``mode="symmetric"``: the partner is
    earlier in (apply_ts, id), at most ``days``.

    One row per flagged application, however many partners it has. No pairs
    are formed: with the smallest id kept per candidate, requisition and time,
    the window's smallest id decides. It is the least of three: that of the
    whole hours inside the window (a sliding minimum over a key's hours), of
    the own hour up to the application, and of the window's first hour from
    its exact start on (both running minima within one hour). So a key with a
    third of all rows is split by hours, and equal times are one row. Only times
    with a flagged application meet the applications again.
    """
    if mode not in ("reference", "symmetric"):
        raise ValueError(f"unknown mode {mode!r}")
    key = ["candidate_id", "req_id"]
    apps = (
        applications.select("application_id", *key, "apply_ts")
        .where(F.col("application_id").isNotNull() & F.col("candidate_id").isNotNull() & F.col("req_id").isNotNull() & F.col("apply_ts").isNotNull())
        .withColumn("_us", epoch_micros(F.col("apply_ts")))
    )
    hour = lambda us: F.expr(f"({us} - pmod({us}, {_HOUR}L)) div {_HOUR}L")
    points = apps.groupBy(*key, "_us").agg(F.min("application_id").alias("_id"), F.max("application_id").alias("_last")).withColumn("_h", hour("_us"))
    hours = apps.groupBy(*key, hour("_us").alias("_h")).agg(F.min("application_id").alias("_least"))
    inside = Window.partitionBy(*key).orderBy("_h").rangeBetween(-24 * days + 1, -1)
    whole = hours.select(*key, "_h", F.min("_least").over(inside).alias("_whole"))
    # a point stands in its own hour, and ``days`` later, where its time is the
    # start of a window: points up to an application are at most its own, those in
    # the first hour of its window stand at or after it
    none = F.lit(None).cast(applications.schema["application_id"].dataType)
    place = lambda h, us, own, last, past: F.struct(h.alias("h"), us.alias("us"), own.alias("own"), last.alias("last"), past.alias("past"))
    places = F.array(
        place(F.col("_h"), F.col("_us"), F.col("_id"), F.col("_last"), none),
        place(F.col("_h") + 24 * days, F.col("_us") + F.lit(24 * days * _HOUR), none, none, F.col("_id")),
    )
    stands = points.select(*key, F.explode(places).alias("_p")).select(
        *key, F.col("_p.h").alias("_h"), F.col("_p.us").alias("_us"), F.col("_p.own").alias("_id"), F.col("_p.last").alias("_last"), F.col("_p.past").alias("_past")
    )
    left = Window.partitionBy(*key, "_h").orderBy("_us")
    right = Window.partitionBy(*key, "_h").orderBy(F.desc("_us"))
    before = F.min("_id").over(left.rangeBetween(Window.unboundedPreceding, -1 if mode == "symmetric" else 0))
    since = F.min("_past").over(right.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    points = stands.withColumns({"_before": before, "_since": since}).where("_id IS NOT NULL").join(whole, [*key, "_h"])
    window = F.least("_before", "_since", "_whole")

    def flagged(one: str) -> Column:
        if mode == "symmetric":
            return F.col("_first").isNotNull() | (F.col(one) > F.col("_id"))
        return F.col(one) > F.col("_first")

    # points without a flagged application, of which the last id tells, drop out;
    # the others are the hashed side, one row each: the applications need no sort
    found = points.select(*key, "_us", "_id", "_last", window.alias("_first")).where(flagged("_last")).drop("_last").hint("shuffle_hash")
    return apps.join(found, [*key, "_us"]).where(flagged("application_id")).select("application_id", *key, "apply_ts")


def rule_duplicate_application(
    applications: DataFrame, days: int = DUPLICATE_WINDOW_DAYS, mode: str = "reference"
) -> DataFrame:
    """One row per flagged application, see ``duplicate_applications``. (The
    source SQL repeats an application once per partner; the rows of one
    application are equal there, so nothing is told apart by that.)"""
    details = F.concat(
        F.lit("candidate "),
        F.col("candidate_id").cast("string"),
        F.lit(" applied to requisition "),
        F.col("req_id").cast("string"),
        F.lit(f" more than once within {days} days"),
    )
    return _tagged(duplicate_applications(applications, days, mode), EXC_DUPLICATE, details)


def rule_missing_recruiter(applications: DataFrame) -> DataFrame:
    return _tagged(
        applications.where(F.col("recruiter_id").isNull()),
        EXC_MISSING_RECRUITER,
        EXCEPTION_DETAILS["MISSING_RECRUITER"],
    )


# ---------------------------------------------------------------- lifecycle rules


def _lifecycle_checks() -> list[tuple[Column, tuple[str, str], str]]:
    negative = (
        (F.col("days_applied_to_screen") < 0)
        | (F.col("days_screen_to_onsite") < 0)
        | (F.col("days_onsite_to_offer") < 0)
        | (F.col("days_offer_to_decision") < 0)
    )
    h, r, w = (F.col(c).isNotNull() for c in ("hired_ts", "rejected_ts", "withdrawn_ts"))
    return [
        (F.col("screen_ts") > F.col("onsite_ts"), EXC_STAGE_ORDER, EXCEPTION_DETAILS["SCREEN_AFTER_ONSITE"]),
        (F.col("onsite_ts") > F.col("offer_ts"), EXC_STAGE_ORDER, EXCEPTION_DETAILS["ONSITE_AFTER_OFFER"]),
        (negative, EXC_NEGATIVE_DURATION, EXCEPTION_DETAILS["NEGATIVE_DURATION"]),
        ((h & r) | (h & w) | (r & w), EXC_MULTIPLE_TERMINAL, EXCEPTION_DETAILS["MULTIPLE_TERMINAL_EVENTS"]),
    ]


def _single_check(life: DataFrame, index: int) -> DataFrame:
    cond, kind, text = _lifecycle_checks()[index]
    return _tagged(life.where(cond), kind, text)


def rule_order_screen_onsite(life: DataFrame) -> DataFrame:
    """Screen strictly after onsite (both present)."""
    return _single_check(life, 0)


def rule_order_onsite_offer(life: DataFrame) -> DataFrame:
    """Onsite strictly after offer (both present)."""
    return _single_check(life, 1)


def rule_stage_order(life: DataFrame) -> DataFrame:
    """Both stage-order branches; one application can yield two rows."""
    return rule_order_screen_onsite(life).unionByName(rule_order_onsite_offer(life))


def rule_negative_duration(life: DataFrame) -> DataFrame:
    """Any of the four step durations below zero (time-to-hire excluded)."""
    return _single_check(life, 2)


def rule_multiple_terminal(life: DataFrame) -> DataFrame:
    """At least two of hired, rejected, withdrawn recorded."""
    return _single_check(life, 3)


def lifecycle_rules(life: DataFrame) -> DataFrame:
    """All four lifecycle rules in one pass: each row emits one exception
    per failed check through an exploded, filtered array of structs."""
    hits = [
        F.when(
            cond,
            F.struct(
                F.lit(kind[0]).alias("exception_type"),
                F.lit(kind[1]).alias("severity"),
                F.lit(text).alias("details"),
            ),
        )
        for cond, kind, text in _lifecycle_checks()
    ]
    found = F.filter(F.array(*hits), lambda x: x.isNotNull())
    return (
        life.select("application_id", F.explode(found).alias("_x"))
        .select(
            F.col("_x.exception_type").alias("exception_type"),
            F.col("_x.severity").alias("severity"),
            "application_id",
            _no_event(),
            F.col("_x.details").alias("details"),
        )
    )


# ---------------------------------------------------------------- offer rules


def _offer_hits(life: DataFrame, offers: DataFrame) -> DataFrame:
    joined = life.select("application_id", "onsite_ts").join(
        offers.select("application_id", "offer_ts"), "application_id", "inner"
    )
    kind = (
        F.when(F.col("onsite_ts").isNull(), F.lit(EXC_OFFER_WITHOUT_ONSITE[0]))
        .when(F.col("offer_ts") < F.col("onsite_ts"), F.lit(EXC_OFFER_BEFORE_ONSITE[0]))
    )
    return joined.withColumn("_kind", kind).where(F.col("_kind").isNotNull())


def offer_rules(life: DataFrame, offers: DataFrame) -> DataFrame:
    """Both offer rules from one join of offers with the onsite time; the
    two conditions exclude each other. Several offers on one application
    give several rows."""
    hits = _offer_hits(life, offers)
    severity = {EXC_OFFER_WITHOUT_ONSITE[0]: EXC_OFFER_WITHOUT_ONSITE[1], EXC_OFFER_BEFORE_ONSITE[0]: EXC_OFFER_BEFORE_ONSITE[1]}
    sev = F.when(F.col("_kind") == EXC_OFFER_WITHOUT_ONSITE[0], F.lit(severity[EXC_OFFER_WITHOUT_ONSITE[0]])).otherwise(
        F.lit(severity[EXC_OFFER_BEFORE_ONSITE[0]])
    )
    det = F.when(
        F.col("_kind") == EXC_OFFER_WITHOUT_ONSITE[0], F.lit(EXCEPTION_DETAILS["OFFER_WITHOUT_ONSITE"])
    ).otherwise(F.lit(EXCEPTION_DETAILS["OFFER_BEFORE_ONSITE"]))
    return hits.select(
        F.col("_kind").alias("exception_type"),
        sev.alias("severity"),
        "application_id",
        _no_event(),
        det.alias("details"),
    )


def rule_offer_before_onsite(life: DataFrame, offers: DataFrame) -> DataFrame:
    return offer_rules(life, offers).where(F.col("exception_type") == EXC_OFFER_BEFORE_ONSITE[0])


def rule_offer_without_onsite(life: DataFrame, offers: DataFrame) -> DataFrame:
    return offer_rules(life, offers).where(F.col("exception_type") == EXC_OFFER_WITHOUT_ONSITE[0])


# ---------------------------------------------------------------- exception log


def lifecycle_and_offer_rules(life: DataFrame, offers: DataFrame) -> DataFrame:
    """The four lifecycle rules and the two offer rules from ONE read of the
    lifecycle table, once per lifecycle row and per offer.

    The lifecycle is left-joined with the offers and one marker row for each
    id that has offers. Lifecycle checks fire on the marker (or on the row that
    found no offer), so once per lifecycle row, also where an application id
    is duplicated; offer checks fire on the offers.
    """
    has_id = offers.where("application_id IS NOT NULL").select("application_id", F.col("offer_ts").cast("timestamp_ntz").alias("_offer_ts"), F.lit(True).alias("_is_offer"))
    marks = has_id.select("application_id").distinct().select("application_id", F.lit(None).cast("timestamp_ntz").alias("_offer_ts"), F.lit(False).alias("_is_offer"))
    cols = ["application_id", "screen_ts", "onsite_ts", "offer_ts", "hired_ts", "rejected_ts", "withdrawn_ts",
            "days_applied_to_screen", "days_screen_to_onsite", "days_onsite_to_offer", "days_offer_to_decision"]
    joined = life.select(*cols).join(has_id.union(marks), "application_id", "left")
    is_offer = F.coalesce("_is_offer", F.lit(False))

    def hit(cond: Column, kind: tuple[str, str], text: str) -> Column:
        return F.when(cond, F.struct(F.lit(kind[0]).alias("exception_type"), F.lit(kind[1]).alias("severity"), F.lit(text).alias("details")))

    hits = [hit(~is_offer & cond, kind, text) for cond, kind, text in _lifecycle_checks()]
    hits.append(hit(is_offer & F.col("onsite_ts").isNull(), EXC_OFFER_WITHOUT_ONSITE, EXCEPTION_DETAILS["OFFER_WITHOUT_ONSITE"]))
    hits.append(hit(is_offer & (F.col("_offer_ts") < F.col("onsite_ts")), EXC_OFFER_BEFORE_ONSITE, EXCEPTION_DETAILS["OFFER_BEFORE_ONSITE"]))
    found = F.filter(F.array(*hits), lambda x: x.isNotNull())
    return joined.select("application_id", F.explode(found).alias("_x")).select(
        F.col("_x.exception_type").alias("exception_type"),
        F.col("_x.severity").alias("severity"),
        "application_id",
        _no_event(),
        F.col("_x.details").alias("details"),
    )


def data_exceptions(
    stage_events_raw: DataFrame,
    applications: DataFrame,
    life: DataFrame,
    offers: DataFrame,
    detected_ts: Column | None = None,
    duplicate_days: int = DUPLICATE_WINDOW_DAYS,
    duplicate_mode: str = "reference",
) -> DataFrame:
    """The full exception log: bag union of every rule plus the evaluation
    time. ``detected_ts`` defaults to the query's current timestamp; pass
    a literal to make the output reproducible. The lifecycle is read once
    (``lifecycle_and_offer_rules``)."""
    ts = detected_ts if detected_ts is not None else F.current_timestamp()
    parts = [
        rule_orphan_event(stage_events_raw, applications),
        rule_duplicate_application(applications, duplicate_days, duplicate_mode),
        rule_missing_recruiter(applications),
        lifecycle_and_offer_rules(life, offers),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("detected_ts", ts)


def data_exceptions_per_rule(
    stage_events_raw: DataFrame, applications: DataFrame, life: DataFrame, offers: DataFrame
) -> DataFrame:
    """The same log built rule by rule (one scan per rule); kept as the
    reference form the single-pass log is tested against."""
    parts = [
        rule_orphan_event(stage_events_raw, applications),
        rule_duplicate_application(applications),
        rule_missing_recruiter(applications),
        rule_order_screen_onsite(life),
        rule_order_onsite_offer(life),
        rule_negative_duration(life),
        rule_multiple_terminal(life),
        rule_offer_before_onsite(life, offers),
        rule_offer_without_onsite(life, offers),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def exception_rate(exceptions: DataFrame, applications: DataFrame, include_orphans: bool = False) -> DataFrame:
    """Share of applications with at least one exception, by distinct id on
    both sides.

    The ids of applications and exceptions are reduced in one aggregate (one
    shuffle on the id, partial per task) and both counts come from it.
    Orphan-event ids are not applications, so by default they are not counted;
    with ``include_orphans`` they count in the numerator only.
    """
    ids = lambda df, app: df.select("application_id", F.lit(app).alias("_app"), F.lit(1 - app).alias("_flag")).where("application_id IS NOT NULL")
    each = ids(applications, 1).union(ids(exceptions, 0)).groupBy("application_id").agg(F.max("_app").alias("_app"), F.max("_flag").alias("_flag"))
    excepted = F.sum("_flag") if include_orphans else F.sum(F.col("_flag") * F.col("_app"))
    agg = each.agg(
        F.coalesce(F.sum("_app"), F.lit(0)).cast("long").alias("total_applications"),
        F.coalesce(excepted, F.lit(0)).cast("long").alias("excepted_applications"),
    )
    return agg.withColumn("exception_rate", safe_ratio(F.col("excepted_applications"), F.col("total_applications")))
