"""Snapshots, rankings, buckets and short series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    bubble_radius,
    guarded_ratio,
    outbreak_direction,
    percent_label,
    reaches,
    shade_bucket,
    size_band,
    trend_bucket,
    upper_limit,
)
from ..functions.buckets import COUNT_LIMIT_ABOVE, COUNT_LIMITS, SHADE_LIMITS, TREND_BANDS
from ..operators.panel import calendar_change
from ..operators.ranks import rank_panels
from ..operators.report import recent_points, record_high, share_under, top_k
from ..plans.counties import (
    MONTH,
    county_averages_export,
    county_base,
    county_progress,
    county_snapshot,
    latest_progress,
    recent_rate_export,
)
from ..plans.reports import VIEWS, all_outbreak_circles, county_shapes, county_table, outbreak_circles
from ..session import new_folder, settle
from ..sinks import write_table
from .panel_queries import region_dim
from .registry import query
from .tables import (
    ND,
    PROGRESS_DOUBLES,
    RD,
    SQL_BASE,
    SQL_NATION_DIM,
    SQL_PROGRESS,
    SQL_REGION_DIM,
    code,
    county_totals,
    event_days,
    nation_day,
    nation_people,
    region_day,
    sql_event_days,
    sql_totals,
    sql_trend,
    sql_upper_limit,
    table,
)

_NATION_PROGRESS = f"""{ND}, {sql_totals("nd", "nation")}, {SQL_BASE}, {SQL_NATION_DIM}, {SQL_PROGRESS}"""
_REGION_PROGRESS = f"""{RD}, {sql_totals("rd", "region")}, {SQL_BASE}, {SQL_REGION_DIM}, {SQL_PROGRESS}"""


def nation_base(spark, sf):
    return county_base(county_totals(nation_day(spark, sf), "nation"))


def nation_dim(spark, sf):
    """Nations as counties of their region."""
    return nation_people(spark, sf).select(
        code(F.col("n_nationkey")).alias("FIPS"),
        F.col("n_name").alias("County"),
        F.col("r_name").alias("State"),
        F.lit("1.5").alias("Lat"),
        F.lit("-2.5").alias("Long_"),
        F.col("population").alias("Population"),
    )


def stored_base(spark, sf):
    """The base panel written once by month, for queries that look at it several times."""
    path = new_folder(spark, "base")
    write_table(nation_base(spark, sf).withColumn(MONTH, F.trunc("Date", "month")), path, [MONTH])
    return spark.read.parquet(path)


def nation_progress(spark, sf):
    return county_progress(nation_base(spark, sf), nation_dim(spark, sf))


def region_progress(spark, sf):
    base = county_base(county_totals(region_day(spark, sf), "region"))
    return county_progress(base, region_dim(spark, sf))


@query(
    "latest_snapshot",
    f"""WITH {_NATION_PROGRESS}
SELECT p.* EXCLUDE ("Date", "Avg7DayDeathsIncrease"), CAST("Date" AS VARCHAR) AS "Date", "County", substr("State", 1, 2) AS "State",
  '1.5' AS "Lat", '-2.5' AS "Long_", "Population"
FROM progress p JOIN dim ON p."FIPS" = dim."FIPS" WHERE "Date" = (SELECT max("Date") FROM progress)""",
    doubles=[c for c in PROGRESS_DOUBLES if c != "Avg7DayDeathsIncrease"],
)
def latest_snapshot(spark, sf):
    states = table(spark, sf, "region").select(
        F.col("r_name").alias("State"), F.substring("r_name", 1, 2).alias("StateAbbrev")
    )
    dim = nation_dim(spark, sf)
    return county_snapshot(latest_progress(stored_base(spark, sf), dim), dim, states)


@query(
    "trailing_days",
    f"""WITH {ND}, {sql_totals("nd", "nation")}, {SQL_BASE}
SELECT "FIPS", "Date", "Avg7DayConfirmedIncrease", "Avg7DayDeathsIncrease" FROM base WHERE "Date" >= (SELECT max("Date") FROM base) - 30""",
    dates=['"Date"'],
    doubles=["Avg7DayConfirmedIncrease", "Avg7DayDeathsIncrease"],
)
def trailing_days_query(spark, sf):
    return county_averages_export(stored_base(spark, sf))


@query(
    "trailing_rates",
    f"""WITH {_NATION_PROGRESS}
SELECT "FIPS", "Date", "CasesPer100k" FROM progress WHERE "Date" >= (SELECT max("Date") FROM base) - 30""",
    dates=['"Date"'],
    doubles=["CasesPer100k"],
)
def trailing_rates(spark, sf):
    return recent_rate_export(stored_base(spark, sf), nation_dim(spark, sf))


@query(
    "top_k_metric",
    """SELECT c_custkey, cents FROM customer LEFT JOIN
  (SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1) ON c_custkey = o_custkey
ORDER BY coalesce(cents, 0) DESC, c_custkey LIMIT 100""",
)
def top_k_metric(spark, sf):
    totals = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
    )
    customers = table(spark, sf, "customer").select("c_custkey").join(totals, "c_custkey", "left")
    return top_k(customers, "cents", ["c_custkey"], 100)


@query(
    "threshold_flag",
    f"""WITH {_REGION_PROGRESS}
SELECT "FIPS", "Date", coalesce("CasesPer100k" >= 12000, false) AS outbreak,
  CASE WHEN "CasesPer100k" >= 12000 AND "OneWeekCasesPer100kChange" > 0 THEN 'up' WHEN "CasesPer100k" >= 12000 THEN 'down' ELSE 'none' END AS direction
FROM progress""",
    dates=['"Date"'],
)
def threshold_flag(spark, sf):
    flag = reaches(F.col("CasesPer100k"), 12000)
    return region_progress(spark, sf).select(
        "FIPS",
        "Date",
        flag.alias("outbreak"),
        outbreak_direction(flag, F.col("OneWeekCasesPer100kChange")).alias("direction"),
    )


@query(
    "flagged_count",
    f"""WITH {_NATION_PROGRESS}
SELECT "Date", count(*) FILTER ("CasesPer100k" >= 25) AS flagged, count(*) AS counties FROM progress GROUP BY 1""",
    dates=['"Date"'],
)
def flagged_count(spark, sf):
    flag = reaches(F.col("CasesPer100k"))
    return (
        nation_progress(spark, sf)
        .groupBy("Date")
        .agg(F.count(F.when(flag, 1)).alias("flagged"), F.count(F.lit(1)).alias("counties"))
    )


@query(
    "shade_bucket",
    f"""SELECT o_orderkey, CASE WHEN p >= 25 THEN {sql_upper_limit("p", SHADE_LIMITS, "NULL")} END AS shade FROM (SELECT o_orderkey, o_totalprice / 400 AS p FROM orders)""",
)
def shade_bucket_query(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", shade_bucket(F.col("o_totalprice") / 400).alias("shade"))


@query(
    "trend_bucket",
    f"""WITH {RD}, t AS (
  SELECT t.region, t.day, t.n - e.n AS d, CASE WHEN e.n > 0 THEN (t.n - e.n) / e.n END AS p
  FROM rd t JOIN rd e ON e.region = t.region AND e.day = t.day - 14)
SELECT region, day, {sql_trend("d", "p", TREND_BANDS)} AS trend FROM t""",
    dates=["day"],
)
def trend_bucket_query(spark, sf):
    changes = calendar_change(region_day(spark, sf).select("region", "day", "n"), "region", "day", "n", 14)
    return changes.select("region", "day", trend_bucket(F.col("change"), F.col("change_pct")).alias("trend"))


@query(
    "bubble_radius",
    """SELECT c_custkey, CAST(floor(sqrt(c_acctbal * (0.05 * 2589988) / 3.14)) AS BIGINT) AS radius
FROM customer WHERE c_acctbal > 0 AND floor(sqrt(c_acctbal * (0.05 * 2589988) / 3.14)) > 0""",
)
def bubble_radius_query(spark, sf):
    radius = bubble_radius(F.col("c_acctbal"), 0.05)
    return table(spark, sf, "customer").select("c_custkey", radius.alias("radius")).filter("radius is not null")


@query(
    "size_band_filter",
    """SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal * 10 < 30000 THEN 'small' WHEN c_acctbal * 10 <= 90000 THEN 'medium' ELSE 'large' END AS band,
  c_mktsegment = 'BUILDING' AND c_acctbal * 10 >= 30000 AND c_acctbal * 10 <= 90000 AS shown FROM customer""",
)
def size_band_filter(spark, sf):
    band = size_band(F.col("c_acctbal") * 10)
    shown = (F.col("c_mktsegment") == "BUILDING") & (band == "medium")
    return table(spark, sf, "customer").select("c_custkey", "c_mktsegment", band.alias("band"), shown.alias("shown"))


@query(
    "percent_label",
    f"""WITH {ND}, t AS (SELECT nation, day, round(n_f / n, 4) * 100 AS share, round((n_f - n_o) / n, 4) * 100 AS gap FROM nd)
SELECT nation, day, printf('%.2f%%', share) AS share, CASE WHEN gap > 0 THEN '+' ELSE '' END || printf('%.2f%%', gap) AS gap FROM t""",
    dates=["day"],
)
def percent_label_query(spark, sf):
    return nation_day(spark, sf).select(
        "nation",
        "day",
        percent_label(guarded_ratio(F.col("n_f"), F.col("n"))).alias("share"),
        percent_label(guarded_ratio(F.col("n_f") - F.col("n_o"), F.col("n")), signed=True).alias("gap"),
    )


@query(
    "bucket_counts",
    f"""SELECT CASE WHEN c > 0 THEN {sql_upper_limit("c", COUNT_LIMITS, str(COUNT_LIMIT_ABOVE))} ELSE 0 END AS upper_limit, count(*) AS n
FROM (SELECT CAST(floor(o_totalprice / 100) AS BIGINT) AS c FROM orders) GROUP BY 1""",
)
def bucket_counts(spark, sf):
    label = upper_limit(F.floor(F.col("o_totalprice") / 100))
    return table(spark, sf, "orders").groupBy(label.alias("upper_limit")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "rising_fast_counts",
    f"""WITH {_NATION_PROGRESS}
SELECT "Date", {sql_upper_limit('"Confirmed"', COUNT_LIMITS, str(COUNT_LIMIT_ABOVE))} AS upper_limit, count(*) AS n
FROM progress WHERE "TwoWeekAvg7DayConfirmedIncreasePct" > 0.5 GROUP BY 1, 2""",
    dates=['"Date"'],
)
def rising_fast_counts(spark, sf):
    rising = nation_progress(spark, sf).filter(F.col("TwoWeekAvg7DayConfirmedIncreasePct") > 0.5)
    return rising.groupBy("Date", upper_limit(F.col("Confirmed")).alias("upper_limit")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "record_high_trend",
    f"""WITH {sql_event_days("user_id")},
last AS (SELECT max(day) AS d FROM ed),
record AS (SELECT user_id, day AS rd, cents AS rc, row_number() OVER (PARTITION BY user_id ORDER BY cents DESC, day DESC) AS rn FROM ed)
SELECT s.day, s.user_id, s.cents, CAST(rd AS VARCHAR) AS "RecordHighDate", rc AS "RecordHigh", s.cents - rc AS "FromHigh",
  CASE WHEN s.cents - e.cents > 0 THEN '+' ELSE '' END || CAST(s.cents - e.cents AS VARCHAR) AS "ChangeLast2Weeks",
  CASE WHEN s.cents - e.cents > 0 THEN 'Trending Up' ELSE 'Trending Down' END AS "TrendLast2Weeks"
FROM ed s JOIN last ON s.day = d JOIN record r ON r.user_id = s.user_id AND rn = 1 JOIN ed e ON e.user_id = s.user_id AND e.day = s.day - 14""",
    dates=["day"],
)
def record_high_trend(spark, sf):
    return record_high(settle(event_days(spark, sf, "user_id")), "user_id", "day", "cents")


@query(
    "rank_panels",
    f"""WITH {sql_event_days("user_id")},
latest AS (SELECT user_id, CAST(floor((row_number() OVER (ORDER BY cents DESC, user_id) - 1) / 10) AS INTEGER) AS panel
  FROM ed WHERE day = (SELECT max(day) FROM ed))
SELECT user_id, day, cents, panel FROM ed JOIN latest USING (user_id)""",
    dates=["day"],
)
def rank_panels_query(spark, sf):
    return rank_panels(settle(event_days(spark, sf, "user_id")), "user_id", "day", "cents")


@query(
    "sparkline_arrays",
    f"""WITH {ND}, recent AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY day DESC) AS rn FROM nd QUALIFY rn <= 15)
SELECT nation, array_to_string(list(CAST(n AS VARCHAR) ORDER BY day), ',') AS points, CAST(max(day) AS VARCHAR) AS last_day FROM recent GROUP BY 1""",
)
def sparkline_arrays(spark, sf):
    recent = recent_points(nation_day(spark, sf), "nation", "day", ["n"], 15)
    values = F.transform("points", lambda p: p["n"].cast("string"))
    return recent.select(
        "nation", F.array_join(values, ",").alias("points"), F.element_at("points", -1)["day"].alias("last_day")
    )


@query(
    "share_under_threshold",
    f"""WITH {_NATION_PROGRESS},
latest AS (SELECT p.*, "State" FROM progress p JOIN dim ON p."FIPS" = dim."FIPS" WHERE "Date" = (SELECT max("Date") FROM progress))
SELECT "State", CAST(sum(CASE WHEN "CasesPer100k" < 2500 THEN 1 ELSE 0 END) AS BIGINT) AS under, count(*) AS total,
  sum(CASE WHEN "CasesPer100k" < 2500 THEN 1 ELSE 0 END) / count(*) AS share
FROM latest GROUP BY 1""",
    doubles=["share"],
)
def share_under_threshold(spark, sf):
    dim = nation_dim(spark, sf)
    latest = latest_progress(stored_base(spark, sf), dim).join(dim.select("FIPS", "State"), "FIPS")
    return share_under(latest, "State", "CasesPer100k", 2500)


@query(
    "distinct_states",
    """SELECT DISTINCT o_orderstatus AS status, year(o_orderdate) AS year FROM orders""",
)
def distinct_states(spark, sf):
    return (
        table(spark, sf, "orders")
        .select(F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year"))
        .distinct()
        .orderBy("status", "year")
    )


def _snapshot(spark, sf, base):
    states = table(spark, sf, "region").select(F.col("r_name").alias("State"), F.col("r_name").alias("StateAbbrev"))
    dim = nation_dim(spark, sf)
    return county_snapshot(latest_progress(base, dim), dim, states)


def _joined(column: str):
    """A series in whole thousandths as one text."""
    return F.array_join(F.transform(column, lambda x: F.round(x * 1000).cast("long").cast("string")), ",")


_LATEST = """latest AS (
  SELECT p.*, "County", "State", "Population" FROM progress p JOIN dim ON p."FIPS" = dim."FIPS"
  WHERE "Date" = (SELECT max("Date") FROM progress))"""


def _sql_series(source: str, column: str, name: str, points: int) -> str:
    return f"""SELECT "FIPS", array_to_string(list(CAST(CAST(round({column} * 1000) AS BIGINT) AS VARCHAR) ORDER BY "Date"), ',') AS {name}
  FROM (SELECT *, row_number() OVER (PARTITION BY "FIPS" ORDER BY "Date" DESC) AS rn FROM {source}
    WHERE "Date" >= (SELECT max("Date") FROM base) - 30) WHERE rn <= {points} GROUP BY 1"""


@query(
    "county_table",
    f"""WITH {_NATION_PROGRESS}, {_LATEST},
cs AS ({_sql_series("base", '"Avg7DayConfirmedIncrease"', '"ConfirmedSeries"', 15)}),
ds AS ({_sql_series("base", '"Avg7DayDeathsIncrease"', '"DeathsSeries"', 15)})
SELECT l."FIPS", "County", "State", "Population",
  CASE WHEN "Population" < 30000 THEN 'small' WHEN "Population" <= 90000 THEN 'medium' ELSE 'large' END AS "SizeBand",
  "Confirmed", "ConfirmedIncrease", "ConfirmedIncreasePct", "ConfirmedSeries", "TwoWeekAvg7DayConfirmedIncreasePct",
  "Deaths", "DeathsIncrease", "DeathsIncreasePct", "DeathsSeries", "TwoWeekAvg7DayDeathsIncreasePct"
FROM latest l LEFT JOIN cs ON cs."FIPS" = l."FIPS" LEFT JOIN ds ON ds."FIPS" = l."FIPS\"""",
    doubles=[
        "ConfirmedIncreasePct",
        "TwoWeekAvg7DayConfirmedIncreasePct",
        "DeathsIncreasePct",
        "TwoWeekAvg7DayDeathsIncreasePct",
    ],
)
def county_table_query(spark, sf):
    base = stored_base(spark, sf)
    shown = county_table(_snapshot(spark, sf, base), county_averages_export(base))
    return shown.withColumns({c: _joined(c) for c in ("ConfirmedSeries", "DeathsSeries")})


@query(
    "outbreak_circles",
    f"""WITH {_NATION_PROGRESS}, {_LATEST},
top AS (SELECT *, CAST("MonthConfirmedIncrease" AS DOUBLE) AS m FROM latest ORDER BY coalesce(m, 0) DESC, "FIPS" LIMIT 100),
sized AS (SELECT *, CASE WHEN m > 0 THEN CAST(floor(sqrt(m * (0.05 * 2589988) / 3.14)) AS BIGINT) END AS r FROM top)
SELECT "FIPS", "County", "State", '1.5' AS "Lat", '-2.5' AS "Long_", "CasesPer100k" >= 25 AS "OutbreakFlag",
  CASE WHEN "CasesPer100k" < 25 THEN 'none' WHEN "OneWeekCasesPer100kChange" > 0 THEN 'up' ELSE 'down' END AS "Direction", m AS "Metric", r AS "Radius"
FROM sized WHERE r > 0""",
    doubles=["Metric"],
)
def outbreak_circles_query(spark, sf):
    return outbreak_circles(_snapshot(spark, sf, stored_base(spark, sf)), "month")


def _view_metric(at: int, view: str) -> str:
    """A figure per customer for every view of the map, some below zero, some equal."""
    whole = f"(((cents - cents % {at + 1}) / {at + 1}) % 5000 - 500)"
    return f"CAST({whole} / 1000.0 AS DOUBLE)" if view.endswith("_pct") else f"CAST({whole} AS BIGINT)"


_CUSTOMER_CENTS = "SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1"
_VIEW_SQL = " UNION ALL ".join(
    f"""SELECT '{view}' AS view, * FROM (SELECT o_custkey, rate, {_view_metric(at, view) if view != "outbreak" else "rate"} AS m FROM t
  {"WHERE rate >= 25" if view == "outbreak" else "ORDER BY m DESC, o_custkey LIMIT 100"})"""
    for at, view in enumerate(VIEWS)
)


@query(
    "outbreak_views",
    f"""WITH t AS (SELECT *, CAST(cents % 61 AS DOUBLE) AS rate FROM ({_CUSTOMER_CENTS})), shown AS ({_VIEW_SQL})
SELECT view, o_custkey, CAST(m AS DOUBLE) AS metric, CAST(floor(sqrt(m * (CASE WHEN view LIKE '%\\_pct' ESCAPE '\\' THEN 100 ELSE 1 END) * (0.05 * 2589988) / 3.14)) AS BIGINT) AS radius,
  CASE WHEN rate < 25 THEN 'none' WHEN o_custkey % 2 = 0 THEN 'up' ELSE 'down' END AS direction
FROM shown WHERE m > 0 AND floor(sqrt(greatest(m, 0) * (CASE WHEN view LIKE '%\\_pct' ESCAPE '\\' THEN 100 ELSE 1 END) * (0.05 * 2589988) / 3.14)) > 0""",
    doubles=["metric"],
)
def outbreak_views(spark, sf):
    # Customers stand for counties; there are more of them than a view shows.
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
    metrics = [F.expr(_view_metric(at, view)).alias(metric) for at, (view, metric) in enumerate(VIEWS.items()) if view != "outbreak"]
    place = [F.lit(None).cast("string").alias(c) for c in ("County", "State", "Lat", "Long_")]
    change = F.when(F.col("o_custkey") % 2 == 0, 1.0).otherwise(-1.0).alias("OneWeekCasesPer100kChange")
    rate = (F.col("cents") % 61).cast("double").alias("CasesPer100k")
    snapshot = orders.select(F.col("o_custkey").alias("FIPS"), *place, rate, change, *metrics)
    return all_outbreak_circles(snapshot).select(
        F.col("View").alias("view"), F.col("FIPS").alias("o_custkey"), F.col("Metric").alias("metric"), F.col("Radius").alias("radius"), F.col("Direction").alias("direction")
    )


@query(
    "county_shapes",
    f"""WITH {_NATION_PROGRESS}, {_LATEST},
cs AS ({_sql_series("base", '"Avg7DayConfirmedIncrease"', '"ConfirmedSeries"', 15)}),
rs AS ({_sql_series("progress", '"CasesPer100k"', '"RateSeries"', 31)})
SELECT d."FIPS", 'P' || c_custkey AS geometry, l."County", l."State", "CasesPer100k",
  CASE WHEN "CasesPer100k" >= 25 THEN {sql_upper_limit('"CasesPer100k"', SHADE_LIMITS, "NULL")} END AS "Shade",
  CASE WHEN l."FIPS" IS NOT NULL THEN {sql_trend("d2", "p2", TREND_BANDS)} END AS "Trend",
  "ConfirmedSeries", "RateSeries", l."FIPS" IS NOT NULL AS has_info
FROM (SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS "FIPS", c_custkey FROM customer) d
  LEFT JOIN (SELECT *, "TwoWeekAvg7DayConfirmedIncrease" AS d2, "TwoWeekAvg7DayConfirmedIncreasePct" AS p2 FROM latest) l ON l."FIPS" = d."FIPS"
  LEFT JOIN cs ON cs."FIPS" = l."FIPS" LEFT JOIN rs ON rs."FIPS" = l."FIPS\"""",
    doubles=["CasesPer100k"],
)
def county_shapes_query(spark, sf):
    # A customer stands for an outline; the nation's code is shared by all of its outlines.
    shapes = table(spark, sf, "customer").select(
        code(F.col("c_nationkey")).alias("FIPS"), F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("geometry")
    )
    base = stored_base(spark, sf)
    rates = recent_rate_export(base, nation_dim(spark, sf))
    shown = county_shapes(shapes, _snapshot(spark, sf, base), county_averages_export(base), rates)
    return shown.withColumns({c: _joined(c) for c in ("ConfirmedSeries", "RateSeries")})
