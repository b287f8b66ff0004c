"""Timestamp expressions with exact, zone-less semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


EPOCH_NTZ = "1970-01-01 00:00:00"


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Whole microseconds from ``start`` to ``end`` as a long.

    Zone-less timestamps are subtracted directly (an exact day-time
    interval, no session time zone involved, so no daylight-saving hour is
    gained or lost). A cast takes the interval's whole seconds, and its rest of
    less than a second is scaled to seconds before the same cast: exact in longs,
    without a decimal per row."""
    interval = _col(end) - _col(start)
    seconds = interval.cast("long")
    rest = interval - F.expr("INTERVAL '1' SECOND") * seconds
    return seconds * F.lit(1_000_000) + (rest * F.lit(1_000_000)).cast("long")


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 00:00:00 of a zone-less timestamp."""
    return micros_between(F.lit(EPOCH_NTZ).cast("timestamp_ntz"), ts)


def days_between(start: Column | str, end: Column | str) -> Column:
    """Fractional days from ``start`` to ``end`` (may be negative).

    Microsecond-exact: the difference is taken in whole microseconds (never
    seconds, which would truncate) and divided as a double. Null when either
    end is null.
    """
    return micros_between(start, end).cast("double") / F.lit(MICROS_PER_DAY)


def week_start(ts: Column | str) -> Column:
    """Monday-based week truncation, kept zone-less.

    Computed on the calendar date (``dayofweek``: 1 = Sunday ... 7 =
    Saturday), so it never passes through the session time zone the way
    ``date_trunc`` does."""
    c = _col(ts)
    return F.date_sub(F.to_date(c), (F.dayofweek(c) + 5) % 7).cast("timestamp_ntz")

