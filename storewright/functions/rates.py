"""Ratios, their display text and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_rate(part: Column, whole: Column) -> Column:
    """``part / whole`` as double; 0.0 when ``whole`` is zero or either side is NULL."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def rate_of_sums(part: Column, whole: Column) -> Column:
    """Ratio of two sums; 0.0 unless the denominator is positive."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.when(whole > 0, ratio).otherwise(F.lit(0.0))


def percent_text(rate: Column) -> Column:
    """One-decimal percent for display, ties away from zero: 0.1225 -> '12.3%'."""
    return F.format_string("%.1f%%", F.round(rate * 100, 1))


def round_half_even(value: Column, places: int = 2) -> Column:
    return F.bround(value, places)
