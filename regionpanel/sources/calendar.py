"""Generated calendar with milestone dates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The days a generated calendar has by default; the last day itself is left out.
CALENDAR_FIRST = "2020-01-01"
CALENDAR_END = "2025-12-31"
MILESTONES = {"Minus1Day": 1, "Minus7Days": 7, "Minus14Days": 14, "Minus30Days": 30}


def calendar(
    spark: SparkSession,
    first: str = CALENDAR_FIRST,
    end: str = CALENDAR_END,
    milestones: Mapping[str, int] = MILESTONES,
) -> DataFrame:
    """One row per day from ``first`` up to, not including, ``end``."""
    ends = spark.range(1).select(F.lit(first).cast("date").alias("_first"), F.lit(end).cast("date").alias("_end"))
    return expand_days(ends, "_first", "_end", milestones)


def expand_days(ends: DataFrame, first: str, end: str, milestones: Mapping[str, int] = MILESTONES) -> DataFrame:
    """Days of each (first, end) row with the dates that many days before."""
    days = ends.filter(F.col(first) < F.col(end)).select(
        F.explode(F.sequence(F.col(first), F.date_sub(F.col(end), 1))).alias("Date")
    )
    return days.withColumns({name: F.date_sub("Date", back) for name, back in milestones.items()})


def in_calendar(day: Column, first: str | None = CALENDAR_FIRST, end: str | None = None) -> Column:
    """Whether the calendar holds the day; the calendar has no gaps, so no join is needed, and no end but a given one."""
    known = day.isNotNull()
    if first:
        known = known & (day >= F.lit(first).cast("date"))
    return known & (day < F.lit(end).cast("date")) if end else known
