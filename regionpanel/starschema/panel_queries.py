"""Lags, rolling means, rates and doubling times on the region-day and nation-day panels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import clamp_zero, guarded_ratio, rate_change, rate_change_pct, rate_per
from ..operators.panel import (
    by_day,
    calendar_change,
    daily_increment,
    doubling_time,
    earlier,
    has_earlier,
    lagged_pair,
    rolling_calendar,
    rolling_rows,
)
from ..plans.counties import MONTH, base_of_months, county_base, county_progress, latest_progress, months_between
from ..session import new_folder, settle
from ..sinks import publish, read_table
from .registry import query
from .tables import (
    ND,
    PROGRESS_DOUBLES,
    RD,
    SQL_BASE,
    SQL_PROGRESS,
    SQL_REGION_DIM,
    code,
    county_totals,
    event_days,
    nation_day,
    region_day,
    region_people,
    sql_event_days,
    sql_totals,
)


@query(
    "clamped_increment",
    f"""WITH {RD}
SELECT t.region, t.day, t.n, greatest(t.n - coalesce(e.n, 0), 0) AS n_increase,
  CASE WHEN t.n_f - t.n_o < 0 THEN 0 ELSE t.n_f - t.n_o END AS clamped
FROM rd t LEFT JOIN rd e ON e.region = t.region AND e.day = t.day - 1""",
    dates=["day"],
)
def clamped_increment(spark, sf):
    rd = region_day(spark, sf)
    grown = daily_increment(rd, "region", "day", {"n": "n_increase"})
    return grown.select("region", "day", "n", "n_increase", clamp_zero(F.col("n_f") - F.col("n_o")).alias("clamped"))


def _lag_sql(days: int) -> str:
    return f"""WITH {RD}
SELECT t.region, t.day, t.cents, t.cents - coalesce(e.cents, 0) AS change,
  CASE WHEN e.cents > 0 THEN (t.cents - e.cents) / e.cents END AS change_pct
FROM rd t JOIN rd e ON e.region = t.region AND e.day = t.day - {days}"""


def _register_lag(days: int) -> None:
    @query(f"lag_change_{days}", _lag_sql(days), dates=["day"], doubles=["change_pct"])
    def lag_change(spark, sf):
        rd = region_day(spark, sf).select("region", "day", "cents")
        return calendar_change(rd, "region", "day", "cents", days)


def _lag_avg_sql(days: int) -> str:
    return f"""WITH {RD},
av AS (SELECT region, day, avg(n) OVER (PARTITION BY region ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n_avg FROM rd)
SELECT t.region, t.day, t.n_avg, t.n_avg - e.n_avg AS change,
  CASE WHEN e.n_avg > 0 THEN (t.n_avg - e.n_avg) / e.n_avg END AS change_pct
FROM av t JOIN av e ON e.region = t.region AND e.day = t.day - {days}"""


def _register_lag_avg(days: int) -> None:
    @query(f"lag_change_avg{days}", _lag_avg_sql(days), dates=["day"], doubles=["n_avg", "change", "change_pct"])
    def lag_change_avg(spark, sf):
        rd = region_day(spark, sf).select("region", "day", "n")
        smooth = rolling_rows(rd, "region", "day", {"n": "n_avg"}).drop("n")
        return calendar_change(smooth, "region", "day", "n_avg", days, null_as_zero=False)


for _days in (7, 14, 30):
    _register_lag(_days)
for _days in (14, 30):
    _register_lag_avg(_days)


def _rated(spark, sf):
    people = region_people(spark, sf).select(F.col("r_regionkey").alias("region"), "population")
    panel = region_day(spark, sf).join(people, "region")
    return panel.select("region", "day", rate_per(F.col("n"), F.col("population")).alias("rate"))


@query(
    "rate_change_7",
    f"""WITH {RD}, {SQL_REGION_DIM},
rated AS (SELECT region, day, n * 100000.0 / nullif("Population", 0) AS rate
  FROM rd JOIN dim ON lpad(CAST(region AS VARCHAR), 5, '0') = "FIPS")
SELECT t.region, t.day, t.rate, coalesce(t.rate, 0) - coalesce(e.rate, 0) AS change,
  (coalesce(t.rate, 0) - coalesce(e.rate, 0)) / nullif(e.rate, 0) AS change_pct
FROM rated t JOIN rated e ON e.region = t.region AND e.day = t.day - 7""",
    dates=["day"],
    doubles=["rate", "change", "change_pct"],
)
def rate_change_7(spark, sf):
    was = earlier("rate", "region", "day", 7)
    pairs = _rated(spark, sf).withColumns({"was": was, "paired": has_earlier("region", "day", 7)}).filter("paired")
    rate, before = F.col("rate"), F.col("was")
    return pairs.select(
        "region",
        "day",
        "rate",
        rate_change(rate, before).alias("change"),
        rate_change_pct(rate, before).alias("change_pct"),
    )


@query(
    "rate_per_100k",
    f"""WITH {RD}, {SQL_REGION_DIM}
SELECT t.region, t.day,
  greatest(coalesce(coalesce(t.n - e.n, 0) * 100000.0 / nullif("Population", 0), 0), 0) AS rate_clamped,
  (t.n - e.n) * 100000.0 / nullif("Population", 0) AS rate_plain
FROM rd t JOIN dim ON lpad(CAST(t.region AS VARCHAR), 5, '0') = "FIPS"
LEFT JOIN rd e ON e.region = t.region AND e.day = t.day - 14""",
    dates=["day"],
    doubles=["rate_clamped", "rate_plain"],
)
def rate_per_100k(spark, sf):
    people = region_people(spark, sf).select(F.col("r_regionkey").alias("region"), "population")
    grown = F.col("n") - earlier("n", "region", "day", 14)
    panel = region_day(spark, sf).join(people, "region").withColumn("grown", grown)
    return panel.select(
        "region",
        "day",
        rate_per(F.col("grown"), F.col("population"), clamp=True).alias("rate_clamped"),
        rate_per(F.col("grown"), F.col("population")).alias("rate_plain"),
    )


@query(
    "guarded_ratio",
    f"""WITH {RD} SELECT region, day, n_f / nullif(n, 0) AS share, n_f / nullif(n_o, 0) AS ratio FROM rd""",
    dates=["day"],
    doubles=["share", "ratio"],
)
def guarded_ratio_query(spark, sf):
    return region_day(spark, sf).select(
        "region",
        "day",
        guarded_ratio(F.col("n_f"), F.col("n")).alias("share"),
        guarded_ratio(F.col("n_f"), F.col("n_o")).alias("ratio"),
    )


@query(
    "rolling_rows_avg7",
    f"""WITH {RD}, {sql_totals("rd", "region")}, {SQL_BASE} SELECT * FROM base""",
    dates=['"Date"'],
    doubles=["Avg7DayConfirmedIncrease", "Avg7DayDeathsIncrease"],
)
def rolling_rows_avg7(spark, sf):
    return county_base(county_totals(region_day(spark, sf), "region"))


@query(
    "panel_update",
    f"""WITH {ND}, {sql_totals("nd", "nation")}, {SQL_BASE} SELECT * FROM base""",
    dates=['"Date"'],
    doubles=["Avg7DayConfirmedIncrease", "Avg7DayDeathsIncrease"],
)
def panel_update(spark, sf):
    # The base panel from totals of which three months came in wrong, brought up to date by what their correction reaches.
    totals = county_totals(nation_day(spark, sf), "nation").withColumn(MONTH, F.trunc("Date", "month"))
    first, last = dt.date(1995, 3, 1), dt.date(1995, 5, 1)
    wrong = F.col(MONTH).between(F.lit(first), F.lit(last))
    base, daily = new_folder(spark, "base"), new_folder(spark, "daily")
    late = totals.filter(~wrong | (F.dayofmonth("Date") % 2 == 0)).withColumn("Confirmed", F.when(wrong, 7).otherwise(F.col("Confirmed")))
    publish(county_base(late).withColumn(MONTH, F.trunc("Date", "month")), base, MONTH)
    publish(totals, daily, MONTH)
    rows, upto = base_of_months(read_table(spark, daily), first, last)
    publish(rows.withColumn(MONTH, F.trunc("Date", "month")), base, MONTH, months_between(first, upto))
    return read_table(spark, base).drop(MONTH)


@query(
    "rolling_calendar_sum7",
    f"""WITH {RD}
SELECT region, day, sum(n) OVER week / 7.0 AS n_avg, CAST(sum(cents) OVER week AS DOUBLE) / 7.0 AS cents_avg
FROM rd WINDOW week AS (PARTITION BY region ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
    dates=["day"],
    doubles=["n_avg", "cents_avg"],
)
def rolling_calendar_sum7(spark, sf):
    rolled = rolling_calendar(region_day(spark, sf), "region", "day", {"n": "n_avg", "cents": "cents_avg"})
    return rolled.select("region", "day", "n_avg", "cents_avg")


def region_dim(spark, sf):
    return region_people(spark, sf).select(
        code(F.col("r_regionkey")).alias("FIPS"), F.col("population").alias("Population")
    )


@query(
    "panel_progress",
    f"""WITH {RD}, {sql_totals("rd", "region")}, {SQL_BASE}, {SQL_REGION_DIM}, {SQL_PROGRESS}
SELECT * FROM progress""",
    dates=['"Date"'],
    doubles=PROGRESS_DOUBLES,
)
def panel_progress(spark, sf):
    base = county_base(county_totals(region_day(spark, sf), "region"))
    return county_progress(base, region_dim(spark, sf))


@query(
    "panel_progress_latest",
    f"""WITH {RD}, {sql_totals("rd", "region")}, {SQL_BASE}, {SQL_REGION_DIM}, {SQL_PROGRESS}
SELECT * FROM progress WHERE "Date" = (SELECT max("Date") FROM progress)""",
    dates=['"Date"'],
    doubles=PROGRESS_DOUBLES,
)
def panel_progress_latest(spark, sf):
    base = settle(county_base(county_totals(region_day(spark, sf), "region")))
    return latest_progress(base, region_dim(spark, sf))


@query(
    "lagged_pair",
    f"""WITH {ND}
SELECT a.nation, a.day, a.n, b.cents FROM nd a JOIN nd b ON a.nation = b.nation AND b.day = a.day + 14""",
    dates=["day"],
)
def lagged_pair_query(spark, sf):
    return lagged_pair(nation_day(spark, sf), "nation", "day", "n", "cents", 14)


_DOUBLING = """,
halves AS (
  SELECT t.{key}, t.day, t.v, max(e.day) AS half_day FROM points t JOIN points e USING ({key})
  WHERE e.day < t.day AND 2 * e.v <= t.v GROUP BY ALL)
SELECT h.{key}, h.day,
  CAST(round(CAST(CAST(h.v AS DOUBLE) * (h.day - half_day) / nullif(2 * (h.v - e.v), 0) AS DECIMAL(38, 9)), 2) AS DOUBLE) AS doubling_days
FROM halves h JOIN points e ON e.{key} = h.{key} AND e.day = half_day"""


@query(
    "doubling_time",
    f"""WITH {sql_event_days("event_type")},
points AS (SELECT event_type, day, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY day) AS BIGINT) AS v FROM ed){_DOUBLING.format(key="event_type")}""",
    dates=["day"],
    doubles=["doubling_days"],
)
def doubling_time_query(spark, sf):
    upto = by_day("event_type", "day").rowsBetween(Window.unboundedPreceding, 0)
    totals = event_days(spark, sf).select("event_type", "day", F.sum("n").over(upto).alias("v"))
    return doubling_time(totals, "event_type", "day", "v", "doubling_days", non_decreasing=True)


@query(
    "doubling_time_falling",
    f"""WITH {RD}, points AS (SELECT region, day, n AS v FROM rd){_DOUBLING.format(key="region")}""",
    dates=["day"],
    doubles=["doubling_days"],
)
def doubling_time_falling(spark, sf):
    points = region_day(spark, sf).select("region", "day", F.col("n").alias("v"))
    return doubling_time(points, "region", "day", "v", "doubling_days")
