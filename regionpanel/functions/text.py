"""Names, keys and display labels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_name(name: str) -> str:
    """A header cell as a column name: trimmed, every other character than a letter or digit -> ``_``."""
    return re.sub(r"[^a-zA-Z0-9]", "_", name.lstrip("﻿").strip())


def concat_key(*parts: Column) -> Column:
    """Key made of text parts; NULL when any part is NULL."""
    return F.concat(*parts)


def signed_label(value: Column) -> Column:
    """Number as text with a leading ``+`` when above zero."""
    return F.concat(F.when(value > 0, "+").otherwise(""), value.cast("string"))


def trend_label(change: Column) -> Column:
    """``Trending Up`` above zero; zero, falling and unknown are all ``Trending Down``."""
    return F.when(change > 0, "Trending Up").otherwise("Trending Down")


def percent_label(value: Column, signed: bool = False) -> Column:
    """Fraction shown as a percentage with two decimals, NULL kept."""
    scaled = F.round(value, 4) * 100
    text = F.format_string("%.2f%%", scaled)
    if signed:
        text = F.concat(F.when(scaled > 0, "+").otherwise(""), text)
    return F.when(value.isNotNull(), text)
