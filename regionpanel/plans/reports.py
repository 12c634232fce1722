"""What the report pages show, on the exports of the county panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bubble_radius, outbreak_direction, reaches, shade_bucket, size_band, trend_bucket
from ..operators.report import join_features, recent_points, top_k

RECENT_POINTS = 15
RATE_DAYS = 30
#: The columns the pages are sorted by at first.
COUNTY_ORDER = "TwoWeekAvg7DayConfirmedIncreasePct"
STATE_ORDER = "positiveChangePct"

# The metric each view of the outbreak map ranks by; the percentages scale their circles by 100.
VIEWS = {
    "outbreak": "CasesPer100k",
    "twoweek_7dayavg": "TwoWeekAvg7DayConfirmedIncrease",
    "twoweek_7dayavg_pct": "TwoWeekAvg7DayConfirmedIncreasePct",
    "month_7dayavg": "MonthAvg7DayConfirmedIncrease",
    "month_7dayavg_pct": "MonthAvg7DayConfirmedIncreasePct",
    "day": "ConfirmedIncrease",
    "day_pct": "ConfirmedIncreasePct",
    "week": "OneWeekConfirmedIncrease",
    "week_pct": "OneWeekConfirmedIncreasePct",
    "twoweek": "TwoWeekConfirmedIncrease",
    "twoweek_pct": "TwoWeekConfirmedIncreasePct",
    "month": "MonthConfirmedIncrease",
    "month_pct": "MonthConfirmedIncreasePct",
}


def _series(averages: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Short series per code, one array per column."""
    recent = recent_points(averages, "FIPS", "Date", list(columns), RECENT_POINTS)
    # A field of an array of structs is the array of that field.
    return recent.select("FIPS", *[F.col(f"points.{c}").alias(name) for c, name in columns.items()])


def county_table(snapshot: DataFrame, averages: DataFrame) -> DataFrame:
    """The sortable county table: latest figures, size band and the last points of both means.

    ``averages`` is the county averages export. `shown_first` gives the order of the page.
    """
    series = _series(averages, {"Avg7DayConfirmedIncrease": "ConfirmedSeries", "Avg7DayDeathsIncrease": "DeathsSeries"})
    return snapshot.join(series, "FIPS", "left").select(
        "FIPS",
        "County",
        "State",
        "Population",
        size_band(F.col("Population")).alias("SizeBand"),
        "Confirmed",
        "ConfirmedIncrease",
        "ConfirmedIncreasePct",
        "ConfirmedSeries",
        "TwoWeekAvg7DayConfirmedIncreasePct",
        "Deaths",
        "DeathsIncrease",
        "DeathsIncreasePct",
        "DeathsSeries",
        "TwoWeekAvg7DayDeathsIncreasePct",
    )


def shown_first(df: DataFrame, column: str, tie: Sequence[str]) -> DataFrame:
    """Rows in the order a page shows them: largest ``column`` first, unknown last, ties by ``tie``."""
    return df.orderBy(F.col(column).desc_nulls_last(), *tie)


def sorted_county_table(snapshot: DataFrame, averages: DataFrame) -> DataFrame:
    return shown_first(county_table(snapshot, averages), COUNTY_ORDER, ["FIPS"])


def sorted_state_table(progress: DataFrame) -> DataFrame:
    """`state_progress` in the order of its page."""
    return shown_first(progress, STATE_ORDER, ["State"])


def outbreak_circles(snapshot: DataFrame, view: str = "outbreak", sq_miles: float = 0.05, k: int = 100) -> DataFrame:
    """Circles of one map view: all outbreaks, or the ``k`` codes leading in the view's metric.

    Codes whose circle would have no radius are left out after ranking.
    """
    metric = VIEWS[view]
    flagged = snapshot.withColumn("OutbreakFlag", reaches(F.col("CasesPer100k")))
    shown = flagged.filter("OutbreakFlag") if view == "outbreak" else top_k(flagged, metric, ["FIPS"], k)
    return shown.select(
        "FIPS",
        "County",
        "State",
        "Lat",
        "Long_",
        "OutbreakFlag",
        outbreak_direction(F.col("OutbreakFlag"), F.col("OneWeekCasesPer100kChange")).alias("Direction"),
        F.col(metric).cast("double").alias("Metric"),
        bubble_radius(F.col(metric), sq_miles, view.endswith("_pct")).alias("Radius"),
    ).filter("Radius is not null")


def all_outbreak_circles(snapshot: DataFrame, sq_miles: float = 0.05, k: int = 100) -> DataFrame:
    """`outbreak_circles` of all views, with the view's name, in one pass over the snapshot.

    Every row is sent to each view with that view's metric and ranked within it; ranks above ``k`` go before the shuffle
    already. In the view of all outbreaks a row is a group by itself, so that no rank leaves it out.
    """
    row = F.struct("FIPS", "County", "State", "Lat", "Long_", "CasesPer100k", "OneWeekCasesPer100kChange")
    views = [F.struct(F.lit(view).alias("view"), F.col(metric).cast("double").alias("metric")) for view, metric in VIEWS.items()]
    sent = snapshot.select(row.alias("row"), reaches(F.col("CasesPer100k")).alias("flag"), F.explode(F.array(*views)).alias("v"))
    everything = F.col("v.view") == "outbreak"
    sent = sent.filter(~everything | F.col("flag")).withColumn("alone", F.when(everything, F.col("row.FIPS")))
    known = F.coalesce(F.col("v.metric"), F.lit(0))
    ranks = Window.partitionBy("v.view", "alone").orderBy(known.desc(), "row.FIPS")
    shown = sent.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= k)
    radius = [bubble_radius(F.col("v.metric"), sq_miles, percent) for percent in (True, False)]
    return shown.select(
        F.col("v.view").alias("View"),
        *[F.col(f"row.{c}") for c in ("FIPS", "County", "State", "Lat", "Long_")],
        F.col("flag").alias("OutbreakFlag"),
        outbreak_direction(F.col("flag"), F.col("row.OneWeekCasesPer100kChange")).alias("Direction"),
        F.col("v.metric").alias("Metric"),
        F.when(F.endswith(F.col("v.view"), F.lit("_pct")), radius[0]).otherwise(radius[1]).alias("Radius"),
    ).filter("Radius is not null")


def county_shapes(shapes: DataFrame, snapshot: DataFrame, averages: DataFrame, rates: DataFrame) -> DataFrame:
    """County outlines with shade, trend and short series; outlines without figures have ``has_info`` false."""
    figures = (
        snapshot.select(
            "FIPS",
            "County",
            "State",
            "CasesPer100k",
            shade_bucket(F.col("CasesPer100k")).alias("Shade"),
            trend_bucket(
                F.col("TwoWeekAvg7DayConfirmedIncrease"), F.col("TwoWeekAvg7DayConfirmedIncreasePct")
            ).alias("Trend"),
        )
        .join(_series(averages, {"Avg7DayConfirmedIncrease": "ConfirmedSeries"}), "FIPS", "left")
        .join(_rate_series(rates), "FIPS", "left")
    )
    return join_features(shapes, figures, "FIPS")


def _rate_series(rates: DataFrame) -> DataFrame:
    """All points of the rate export's last 31 days per code."""
    rates = rates.filter(F.col("Date") >= F.date_sub(rates.agg(F.max("Date")).scalar(), RATE_DAYS))
    points = rates.groupBy("FIPS").agg(F.array_sort(F.collect_list(F.struct("Date", "CasesPer100k"))).alias("points"))
    return points.select("FIPS", F.col("points.CasesPer100k").alias("RateSeries"))
