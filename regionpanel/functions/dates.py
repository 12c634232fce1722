"""Dates from text and calendar parts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(col: Column, formats: str | Iterable[str]) -> Column:
    """Text to DATE, the first format that fits; text that fits none gives NULL."""
    if isinstance(formats, str):
        formats = (formats,)
    return F.coalesce(*[F.try_to_date(col, f) for f in formats])


def iso_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def compact_date(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def week_number(day: Column) -> Column:
    """Week of the year, weeks starting on Sunday, days before the first Sunday in week 0."""
    days_from_sunday = F.dayofweek(day) - 1
    return F.floor((F.dayofyear(day) + 6 - days_from_sunday) / 7).cast("int")


def week_ending(day: Column) -> Column:
    """The Saturday that closes the week of ``day``."""
    return F.date_add(day, 7 - F.dayofweek(day))
