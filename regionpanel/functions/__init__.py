"""Column helpers: text, codes, dates, ratios and report buckets."""

from .buckets import (
    bubble_radius,
    outbreak_direction,
    reaches,
    shade_bucket,
    size_band,
    trend_bucket,
    upper_limit,
)
from .codes import is_placeable, numeric_text, repair_code
from .dates import compact_date, iso_date, parse_date, week_ending, week_number
from .ratios import (
    change_pct,
    clamp_zero,
    guarded_ratio,
    increase_since,
    rate_change,
    rate_change_pct,
    rate_per,
    yes_flag,
)
from .text import clean_name, concat_key, percent_label, signed_label, trend_label

__all__ = [
    "bubble_radius",
    "change_pct",
    "clamp_zero",
    "clean_name",
    "compact_date",
    "concat_key",
    "guarded_ratio",
    "increase_since",
    "is_placeable",
    "iso_date",
    "numeric_text",
    "outbreak_direction",
    "parse_date",
    "percent_label",
    "rate_change",
    "rate_change_pct",
    "rate_per",
    "reaches",
    "repair_code",
    "shade_bucket",
    "signed_label",
    "size_band",
    "trend_bucket",
    "trend_label",
    "upper_limit",
    "week_ending",
    "week_number",
    "yes_flag",
]
