"""Guarded differences, ratios and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp_zero(value: Column) -> Column:
    """Negative corrections count as zero; NULL stays NULL."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def increase_since(value: Column, earlier: Column) -> Column:
    """Growth since an earlier total, never below zero, a missing earlier total counting as zero.

    ``greatest`` skips NULLs in Spark, so an unknown total is kept NULL by hand.
    """
    grown = value - F.coalesce(earlier, F.lit(0))
    return F.when(value.isNotNull(), F.greatest(grown, F.lit(0)))


def guarded_ratio(part: Column, whole: Column) -> Column:
    """Quotient as double, NULL on a zero or missing divisor."""
    return part.cast("double") / F.nullif(whole, F.lit(0))


def change_pct(value: Column, earlier: Column) -> Column:
    """Relative change, known only where the earlier value is above zero."""
    return F.when(earlier > 0, (value - earlier) / earlier.cast("double"))


def rate_per(delta: Column, population: Column, per: int = 100_000, clamp: bool = False) -> Column:
    """Rate per so many inhabitants; with ``clamp`` unknown and negative rates become 0."""
    if not clamp:
        return delta.cast("double") * per / F.nullif(population, F.lit(0))
    rate = F.coalesce(delta, F.lit(0)) * F.lit(float(per)) / F.nullif(population, F.lit(0))
    return F.greatest(F.coalesce(rate, F.lit(0.0)), F.lit(0.0))


def rate_change(rate: Column, earlier: Column) -> Column:
    return F.coalesce(rate, F.lit(0.0)) - F.coalesce(earlier, F.lit(0.0))


def rate_change_pct(rate: Column, earlier: Column) -> Column:
    return rate_change(rate, earlier) / F.nullif(earlier, F.lit(0.0))


def yes_flag(col: Column) -> Column:
    """1 for ``Yes``, 0 for anything else and for NULL."""
    return F.when(col == "Yes", 1).otherwise(0)
