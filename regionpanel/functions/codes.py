"""Repair of region codes and of numbers delivered as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Places that carry no region code of their own.
UNPLACED_NAMES = ("Unassigned", "Unknown")
UNPLACED_PATTERNS = ("Out of%", "Out-of-%")
UNPLACED_PROVINCE = "Recovered"
HOME_COUNTRY = "US"
CODE_LENGTH = 5


def is_placeable(country: Column, county: Column, province: Column) -> Column:
    """1 where the row ought to carry a region code, else 0; a missing county passes, a missing province does not."""
    county = F.coalesce(county, F.lit(""))
    ok = (country == HOME_COUNTRY) & ~county.isin(*UNPLACED_NAMES) & (province != UNPLACED_PROVINCE)
    for pattern in UNPLACED_PATTERNS:
        ok = ok & ~county.like(pattern)
    return F.when(ok, 1).otherwise(0)


def numeric_text(col: Column) -> Column:
    """Integer held as text such as ``12.0``; halves round away from zero, text that is no number gives NULL."""
    return F.round(col.try_cast("double")).try_cast("long")


def repair_code(code: Column, flag: Column, length: int = CODE_LENGTH) -> Column:
    """Re-pad codes that lost leading zeros or gained a decimal part (``1001.0`` -> ``01001``).

    A code of more digits than ``length`` is no code and gives NULL; cutting it would make it another one.
    """
    broken = (flag == 1) & (F.length(code) != length) & (F.length(code) > 0)
    digits = numeric_text(code).cast("string")
    padded = F.when(F.length(digits) <= length, F.lpad(digits, length, "0"))
    return F.when(broken, padded).otherwise(code)
