"""Ratio helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as a double, null when the denominator is
    zero or null (never an ANSI divide-by-zero error)."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")
