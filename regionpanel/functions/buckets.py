"""Labels and marks the reports draw from a metric."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report thresholds.
OUTBREAK_RATE = 25
COUNT_LIMITS = (100, 200, 300, 400, 500, 600, 700, 800, 900, 1000, 5000, 10000)
COUNT_LIMIT_ABOVE = 100000
SHADE_LIMITS = (50, 75, 100, 200, 500, 1000, 10000000)
TREND_BANDS = (0.25, 0.5, 0.75, 1.0)
SMALL_BELOW = 30000
LARGE_ABOVE = 90000
SQ_METERS_PER_SQ_MILE = 2589988
PI_APPROX = 3.14


def _first_limit(value: Column, limits: Sequence[float], above: Column) -> Column:
    """The first limit that is not below the value."""
    chain = F
    for limit in limits:
        chain = chain.when(value <= limit, F.lit(limit))
    return chain.otherwise(above)


def upper_limit(value: Column, limits: Sequence[int] = COUNT_LIMITS, above: int = COUNT_LIMIT_ABOVE) -> Column:
    """Histogram class named by its upper limit; zero and unknown share class 0."""
    return F.when(value.isNull() | (value == 0), F.lit(0)).otherwise(_first_limit(value, limits, F.lit(above)))


def reaches(metric: Column, threshold: float = OUTBREAK_RATE) -> Column:
    """True from the threshold on; an unknown metric does not reach it."""
    return F.coalesce(metric >= threshold, F.lit(False))


def outbreak_direction(flag: Column, rate_change: Column) -> Column:
    """``up`` or ``down`` for flagged rows by the sign of the weekly change, else ``none``."""
    return F.when(flag & (rate_change > 0), "up").when(flag, "down").otherwise("none")


def shade_bucket(rate: Column, limits: Sequence[int] = SHADE_LIMITS, threshold: float = OUTBREAK_RATE) -> Column:
    """Map shade named by its upper limit; NULL below the threshold or above the last limit."""
    return F.when(rate >= threshold, _first_limit(rate, limits, F.lit(None)))


def trend_bucket(change: Column, pct: Column, bands: Sequence[float] = TREND_BANDS) -> Column:
    """Sign of the change with the band of its size: ``up1`` .. ``up5``, ``down1`` .. ``down4``, else ``none``.

    An unknown percentage (nothing to compare with) takes the mildest band; a fall of more than the last band
    has no label.
    """
    last = len(bands)
    up = F.when(pct.isNull(), "up1")
    down = F.when(pct.isNull(), "down1")
    for number, band in enumerate(bands, start=1):
        up = up.when(pct <= band, f"up{number}")
        down = down.when(pct >= -band, f"down{number}")
    return (
        F.when(change > 0, up.otherwise(f"up{last + 1}"))
        .when(change < 0, down.otherwise("none"))
        .otherwise("none")
    )


def size_band(population: Column) -> Column:
    """``small``, ``medium`` or ``large``; an unknown population counts as small."""
    people = F.coalesce(population, F.lit(0))
    return F.when(people < SMALL_BELOW, "small").when(people <= LARGE_ABOVE, "medium").otherwise("large")


def bubble_radius(metric: Column, sq_miles: float, is_pct: bool = False) -> Column:
    """Whole-metre radius of a circle whose area stands for the metric; NULL where nothing can be drawn."""
    scale = sq_miles * SQ_METERS_PER_SQ_MILE * (100 if is_pct else 1)
    area = metric.cast("double") * F.lit(float(scale)) / F.lit(PI_APPROX)
    radius = F.when(area > 0, F.floor(F.sqrt(area)))
    return F.when(radius > 0, radius)
