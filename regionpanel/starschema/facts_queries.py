"""State, nation and test-positivity tables, and the state report, on orders and events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import rate_per
from ..operators.panel import by_day, earlier, rolling_rows
from ..operators.report import first_last_change, first_last_pct, latest_nonnull, recent_points
from ..operators.rollup import pivot_rate, with_total
from ..plans.states import clean_tests, nation_facts, positivity, state_averages_export, state_facts, state_progress
from ..session import settle
from .registry import query
from .tables import (
    ND,
    RD,
    event_days,
    nation_day,
    nation_people,
    region_day,
    region_people,
    sql_event_days,
    table,
)

# The calendar of these queries, shorter than the orders, so that days outside it occur.
FIRST, END = "1996-01-01", "2001-01-01"


def _order_states(days):
    """Nation-days as state counts; the nation number stands for the abbreviation."""
    upto = by_day("nation", "day").rowsBetween(Window.unboundedPreceding, 0)
    unknown = F.lit(None).cast("long")
    return days.select(
        F.col("day").alias("Date"),
        F.col("nation").cast("string").alias("state"),
        F.sum("n").over(upto).alias("positive"),
        F.col("n").alias("positiveIncrease"),
        F.sum("n_f").over(upto).alias("death"),
        F.col("n_f").alias("deathIncrease"),
        unknown.alias("hospitalized"),
        unknown.alias("hospitalizedIncrease"),
        F.col("n_o").alias("totalTestResultsIncrease"),
    )


def _order_tests(days):
    """Orders per nation, day and status as test results."""
    status = F.array(
        *[
            F.struct(F.lit(s).alias("overall_outcome"), F.col(c).alias("new_results"))
            for s, c in (("F", "n_f"), ("O", "n_o"), ("P", "n_p"))
        ]
    )
    return days.select(
        F.col("nation").cast("string").alias("state"), F.col("day").alias("Date"), F.explode(status).alias("t")
    ).select("state", "Date", "t.*")


def _nation_dim(spark, sf):
    return nation_people(spark, sf).select(
        F.col("n_name").alias("State"),
        F.col("n_nationkey").cast("string").alias("StateAbbrev"),
        F.col("population").alias("Population"),
    )


ORDER_OUTCOMES = {"F": "negative", "O": "positive", "P": "inconclusive"}

_WEEK = "PARTITION BY nation ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW"
_UPTO = "PARTITION BY nation ORDER BY day ROWS UNBOUNDED PRECEDING"
_SHOWN = f"day >= DATE '{FIRST}' AND day < DATE '{END}'"

_STATES = f"""{ND},
shares AS (SELECT *, n_f + n_o + n_p AS tests, CASE WHEN n_f + n_o + n_p > 0 THEN n_o / (n_f + n_o + n_p) ELSE 0 END AS share FROM nd),
sums AS (
  SELECT *, CAST(sum(n) OVER ({_UPTO}) AS BIGINT) AS all_n, CAST(sum(n_f) OVER ({_UPTO}) AS BIGINT) AS all_f,
    sum(n) OVER ({_WEEK}) / 7.0 AS mean_n, sum(n_f) OVER ({_WEEK}) / 7.0 AS mean_f, sum(share) OVER ({_WEEK}) / 7.0 AS mean_share
  FROM shares),
grown AS (
  SELECT *, all_n - max(all_n) OVER (PARTITION BY nation ORDER BY day RANGE BETWEEN INTERVAL 14 DAYS PRECEDING AND INTERVAL 14 DAYS PRECEDING) AS gain
  FROM sums),
people AS (SELECT c_nationkey, count(*) AS people FROM customer GROUP BY 1)"""


@query(
    "entity_facts",
    f"""WITH {_STATES}
SELECT day AS "Date", CAST(nation AS VARCHAR) AS state, all_n AS positive, n AS "positiveIncrease", all_f AS death, n_f AS "deathIncrease",
  CAST(NULL AS BIGINT) AS hospitalized, CAST(NULL AS BIGINT) AS "hospitalizedIncrease", n_o AS "totalTestResultsIncrease", share AS "positivityRate",
  CASE WHEN {_SHOWN} THEN gain * 100000.0 / people END AS "CasesPer100k", CASE WHEN {_SHOWN} THEN mean_n END AS "Avg7DayPositiveIncrease",
  CASE WHEN {_SHOWN} THEN mean_f END AS "Avg7DayDeathIncrease", CASE WHEN {_SHOWN} THEN mean_share END AS "Avg7DayPositivityRate"
FROM grown LEFT JOIN people ON c_nationkey = nation""",
    dates=['"Date"'],
    doubles=["positivityRate", "CasesPer100k", "Avg7DayPositiveIncrease", "Avg7DayDeathIncrease", "Avg7DayPositivityRate"],
)
def entity_facts(spark, sf):
    days = settle(nation_day(spark, sf))
    tests = positivity(_order_tests(days), ORDER_OUTCOMES, FIRST, END)
    return state_facts(_order_states(days), _nation_dim(spark, sf), tests, FIRST, END)


@query(
    "entity_facts_without_end",
    f"""WITH {_STATES}, late AS (SELECT *, day + INTERVAL 30 YEARS AS later FROM grown)
SELECT CAST(later AS DATE) AS "Date", CAST(nation AS VARCHAR) AS state, gain * 100000.0 / people AS "CasesPer100k", mean_n AS "Avg7DayPositiveIncrease"
FROM late LEFT JOIN people ON c_nationkey = nation""",
    dates=['"Date"'],
    doubles=["CasesPer100k", "Avg7DayPositiveIncrease"],
)
def entity_facts_without_end(spark, sf):
    # The same days thirty years later, far past 2025: rates and means go on as long as the data.
    days = nation_day(spark, sf).withColumn("on", F.col("day"))
    facts = state_facts(_order_states(days), _nation_dim(spark, sf), positivity(_order_tests(days), ORDER_OUTCOMES, None), None)
    return facts.select((F.col("Date") + F.expr("INTERVAL 30 YEARS")).cast("date").alias("Date"), "state", "CasesPer100k", "Avg7DayPositiveIncrease")


@query(
    "pivot_rate_rolling",
    f"""WITH {_STATES}
SELECT CAST(nation AS VARCHAR) AS state, day AS "Date", CAST(n_f AS BIGINT) AS negative, CAST(n_o AS BIGINT) AS positive, CAST(n_p AS BIGINT) AS inconclusive,
  CAST(tests AS BIGINT) AS "totalTests", share AS "positivityRate", CASE WHEN {_SHOWN} THEN mean_share END AS "Avg7DayPositivityRate" FROM sums""",
    dates=['"Date"'],
    doubles=["positivityRate", "Avg7DayPositivityRate"],
)
def pivot_rate_rolling(spark, sf):
    delivered = _order_tests(nation_day(spark, sf)).select(
        "state",
        F.date_format("Date", "yyyy/MM/dd").alias("date"),
        "overall_outcome",
        F.col("new_results").cast("string").alias("new_results_reported"),
    )
    return positivity(clean_tests(delivered), ORDER_OUTCOMES, FIRST, END)


@query(
    "entity_rate_14",
    f"""WITH {RD}, dim AS (SELECT n_regionkey, count(*) AS population FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
totals AS (SELECT region, day, CAST(sum(n) OVER (PARTITION BY region ORDER BY day) AS BIGINT) AS total FROM rd)
SELECT t.region, t.day, (t.total - e.total) * 100000.0 / nullif(population, 0) AS rate
FROM totals t JOIN dim ON t.region = n_regionkey LEFT JOIN totals e ON e.region = t.region AND e.day = t.day - 14""",
    dates=["day"],
    doubles=["rate"],
)
def entity_rate_14(spark, sf):
    people = region_people(spark, sf).select(F.col("r_regionkey").alias("region"), "population")
    upto = by_day("region", "day").rowsBetween(Window.unboundedPreceding, 0)
    totals = region_day(spark, sf).join(people, "region").withColumn("total", F.sum("n").over(upto))
    grown = F.col("total") - earlier("total", "region", "day", 14)
    return totals.select("region", "day", rate_per(grown, F.col("population")).alias("rate"))


@query(
    "national_series",
    f"""WITH {_STATES},
daily AS (SELECT day AS date, CAST(sum(all_n) AS BIGINT) AS positive, CAST(sum(n) AS BIGINT) AS cases, CAST(sum(n_o) AS BIGINT) AS tests FROM sums GROUP BY 1)
SELECT date, positive, cases AS "positiveIncrease", tests AS "totalTestResultsIncrease",
  sum(cases) OVER seven / 7.0 AS "Avg7DayPositiveIncrease", sum(tests) OVER seven / 7.0 AS "Avg7DayTotalTestResultsIncrease",
  (positive - max(positive) OVER past) * 100000.0 / (SELECT count(*) FROM customer WHERE c_nationkey IN (SELECT nation FROM nd)) AS "CasesPer100k"
FROM daily WINDOW seven AS (ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW),
  past AS (ORDER BY date RANGE BETWEEN INTERVAL 14 DAYS PRECEDING AND INTERVAL 14 DAYS PRECEDING)""",
    dates=["date"],
    doubles=["Avg7DayPositiveIncrease", "Avg7DayTotalTestResultsIncrease", "CasesPer100k"],
)
def national_series(spark, sf):
    days = settle(nation_day(spark, sf))
    return nation_facts(_order_states(days), _nation_dim(spark, sf))


@query(
    "national_trend",
    f"""WITH {RD}, daily AS (SELECT day AS date, sum(n) AS n FROM rd GROUP BY 1)
SELECT * FROM (
  SELECT date, sum(n) OVER (ORDER BY date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) / 7.0 AS "Avg7DayPositiveIncrease" FROM daily)
WHERE date >= DATE '2000-03-01'""",
    dates=["date"],
    doubles=["Avg7DayPositiveIncrease"],
)
def national_trend(spark, sf):
    days = settle(nation_day(spark, sf))
    nation = nation_facts(_order_states(days), _nation_dim(spark, sf))
    return nation.filter(F.col("date") >= F.lit("2000-03-01").cast("date")).select("date", "Avg7DayPositiveIncrease")


def _event_outcomes(spark, sf):
    """Events per user, day and type; click, view and error stand for the outcomes of a test."""
    return (
        table(spark, sf, "events")
        .groupBy(
            F.col("user_id").cast("string").alias("state"),
            F.to_date("ts").alias("Date"),
            F.col("event_type").alias("overall_outcome"),
        )
        .agg(F.count(F.lit(1)).alias("new_results"))
    )


EVENT_OUTCOMES = {"click": "negative", "view": "positive", "error": "inconclusive"}

_EVENT_PIVOT = """pos AS (
  SELECT CAST(user_id AS VARCHAR) AS state, CAST(ts AS DATE) AS "Date",
    nullif(count(*) FILTER (event_type = 'click'), 0) AS negative, nullif(count(*) FILTER (event_type = 'view'), 0) AS positive,
    nullif(count(*) FILTER (event_type = 'error'), 0) AS inconclusive,
    count(*) FILTER (event_type IN ('click', 'view', 'error')) AS "totalTests",
    CASE WHEN "totalTests" > 0 THEN positive / "totalTests" ELSE 0 END AS "positivityRate"
  FROM events GROUP BY 1, 2)"""


@query("pivot_rate", f"""WITH {_EVENT_PIVOT} SELECT * FROM pos""", dates=['"Date"'], doubles=["positivityRate"])
def pivot_rate_query(spark, sf):
    return pivot_rate(
        _event_outcomes(spark, sf),
        ["state", "Date"],
        "overall_outcome",
        "new_results",
        EVENT_OUTCOMES,
        "positive",
        "totalTests",
        "positivityRate",
    )


@query(
    "latest_nonnull",
    f"""WITH {_EVENT_PIVOT},
numbered AS (SELECT *, row_number() OVER (PARTITION BY state ORDER BY "Date") AS i FROM pos),
hits AS (SELECT state, "Date", "positivityRate", row_number() OVER (PARTITION BY state ORDER BY "Date" DESC) AS rn
  FROM numbered WHERE i > 1 AND "positivityRate" <> 0)
SELECT state, "Date", "positivityRate" FROM hits WHERE rn = 1""",
    dates=['"Date"'],
    doubles=["positivityRate"],
)
def latest_nonnull_query(spark, sf):
    return latest_nonnull(pivot_rate_query.__wrapped__(spark, sf), "state", "Date", "positivityRate")


@query(
    "first_last_change",
    f"""WITH {ND},
recent AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY day DESC) AS rn FROM nd QUALIFY rn <= 14)
SELECT nation, arg_max(n, day) - arg_min(n, day) AS change,
  CASE WHEN arg_min(n, day) > 0 THEN (arg_max(n, day) - arg_min(n, day)) / arg_min(n, day) END AS change_pct
FROM recent GROUP BY 1""",
    doubles=["change_pct"],
)
def first_last_change_query(spark, sf):
    recent = recent_points(nation_day(spark, sf), "nation", "day", ["n"], 14)
    series = recent.select("nation", F.transform("points", lambda p: p["n"]).alias("s"))
    return series.select(
        "nation",
        first_last_change(F.col("s")).alias("change"),
        first_last_pct(F.col("s")).alias("change_pct"),
    )


@query(
    "rollup_row_union",
    f"""WITH {sql_event_days("event_type")}
SELECT event_type AS state, day, n, cents FROM ed WHERE event_type <> 'signup' AND n >= 0
UNION ALL SELECT 'US', day, CAST(sum(n) AS BIGINT), CAST(sum(cents) AS BIGINT) FROM ed WHERE event_type <> 'signup' AND n >= 0 GROUP BY day""",
    dates=["day"],
)
def rollup_row_union(spark, sf):
    days = event_days(spark, sf).select(F.col("event_type").alias("state"), "day", "n", "cents")
    return with_total(days, "state", "day", ["n", "cents"], "US", "n", ["signup"])


@query(
    "rollup_moving_avg",
    f"""WITH {sql_event_days("event_type")},
us AS (SELECT day, sum(n) AS n FROM ed GROUP BY day),
numbered AS (SELECT day, CAST(n AS DOUBLE) AS n, row_number() OVER (ORDER BY day DESC) AS back FROM us)
SELECT a.day, sum(b.n) / 7 AS avg7 FROM numbered a JOIN numbered b ON b.back BETWEEN a.back AND a.back + 6
WHERE a.back <= 15 GROUP BY a.day""",
    dates=["day"],
    doubles=["avg7"],
)
def rollup_moving_avg(spark, sf):
    days = event_days(spark, sf).select(F.col("event_type").alias("state"), "day", "n")
    nation = with_total(days, "state", "day", ["n"], "US", "n").filter("state = 'US'")
    moving = rolling_rows(nation, "state", "day", {"n": "avg7"})
    last = recent_points(moving, "state", "day", ["avg7"], 15)
    return last.select(F.explode("points").alias("p")).select("p.*")


def _user_states(spark, sf):
    """User-days as state counts, errors standing for deaths, with the events' positivity."""
    upto = by_day("state", "Date").rowsBetween(Window.unboundedPreceding, 0)
    days = event_days(spark, sf, "user_id").select(
        F.col("day").alias("Date"), F.col("user_id").cast("string").alias("state"), "n", "n_error"
    )
    unknown = F.lit(None).cast("long")
    return days.select(
        "Date",
        "state",
        F.sum("n").over(upto).alias("positive"),
        F.col("n").alias("positiveIncrease"),
        F.sum("n_error").over(upto).alias("death"),
        F.col("n_error").alias("deathIncrease"),
        unknown.alias("hospitalized"),
        unknown.alias("hospitalizedIncrease"),
        unknown.alias("totalTestResultsIncrease"),
    )


def _series_sql(column: str) -> str:
    return f"""array_to_string(list(CAST(CAST(round({column} * 1000) AS BIGINT) AS VARCHAR) ORDER BY "Date"), ',')"""


@query(
    "state_progress",
    f"""WITH {_EVENT_PIVOT}, {sql_event_days("user_id")},
facts AS (
  SELECT CAST(user_id AS VARCHAR) AS state, day AS "Date", CAST(sum(n) OVER w AS BIGINT) AS positive, n AS "positiveIncrease",
    CAST(sum(n_error) OVER w AS BIGINT) AS death, n_error AS "deathIncrease",
    (SELECT sum(x.n) FROM ed x WHERE x.user_id = ed.user_id AND x.day BETWEEN ed.day - 6 AND ed.day) / 7.0 AS cases,
    (SELECT sum(x.n_error) FROM ed x WHERE x.user_id = ed.user_id AND x.day BETWEEN ed.day - 6 AND ed.day) / 7.0 AS deaths,
    (SELECT sum(p."positivityRate") FROM pos p WHERE p.state = CAST(ed.user_id AS VARCHAR) AND p."Date" BETWEEN ed.day - 6 AND ed.day) / 7.0 AS pos7
  FROM ed WINDOW w AS (PARTITION BY user_id ORDER BY day)),
kept AS (
  SELECT f.*, p."positivityRate" FROM facts f JOIN pos p USING (state, "Date")
  WHERE "Date" >= (SELECT max("Date") FROM facts) - 28),
us AS (
  SELECT 'US' AS state, "Date", sum(positive) AS positive, sum("positiveIncrease") AS "positiveIncrease",
    sum(death) AS death, sum("deathIncrease") AS "deathIncrease" FROM kept GROUP BY 2),
rows AS (
  SELECT state, "Date", positive, "positiveIncrease", death, "deathIncrease", cases, deaths, pos7, "positivityRate" FROM kept
  UNION ALL SELECT state, "Date", positive, "positiveIncrease", death, "deathIncrease",
    avg("positiveIncrease") OVER (ORDER BY "Date" ROWS 6 PRECEDING), avg("deathIncrease") OVER (ORDER BY "Date" ROWS 6 PRECEDING), NULL, NULL FROM us),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY state ORDER BY "Date" DESC) AS back, row_number() OVER (PARTITION BY state ORDER BY "Date") AS i,
    count(*) FILTER ("positivityRate" <> 0) OVER (PARTITION BY state ORDER BY "Date" DESC) AS tested
  FROM rows),
latest AS (SELECT * FROM numbered WHERE back = 1),
recent AS (
  SELECT state, {_series_sql("cases")} AS "positiveSeries", {_series_sql("deaths")} AS "deathSeries",
    arg_min(cases, "Date") AS c0, arg_max(cases, "Date") AS c1, arg_min(deaths, "Date") AS d0, arg_max(deaths, "Date") AS d1
  FROM numbered WHERE back <= CASE WHEN state = 'US' THEN 15 ELSE 14 END GROUP BY state),
tests AS (
  SELECT state, {_series_sql("pos7")} AS "positivitySeries", arg_max(pos7, "Date") - arg_min(pos7, "Date") AS "positivityChange"
  FROM numbered WHERE "positivityRate" <> 0 AND tested <= 14 GROUP BY state),
last_test AS (SELECT state, arg_max("positivityRate", "Date") AS "positivityRate" FROM numbered WHERE i > 1 AND "positivityRate" <> 0 GROUP BY state)
SELECT l.state AS "State", CAST(l.positive AS BIGINT) AS positive, CAST(l."positiveIncrease" AS BIGINT) AS "positiveIncrease",
  l."positiveIncrease" / nullif(l.positive - l."positiveIncrease", 0) AS "positiveIncreasePct",
  "positiveSeries", CASE WHEN c0 > 0 THEN (c1 - c0) / c0 END AS "positiveChangePct",
  lt."positivityRate", coalesce("positivitySeries", '') AS "positivitySeries", "positivityChange",
  CAST(l.death AS BIGINT) AS death, CAST(l."deathIncrease" AS BIGINT) AS "deathIncrease",
  l."deathIncrease" / nullif(l.death - l."deathIncrease", 0) AS "deathIncreasePct",
  "deathSeries", CASE WHEN d0 > 0 THEN (d1 - d0) / d0 END AS "deathChangePct"
FROM latest l JOIN recent r USING (state) LEFT JOIN tests t USING (state) LEFT JOIN last_test lt USING (state)""",
    doubles=[
        "positiveIncreasePct",
        "positiveChangePct",
        "positivityRate",
        "positivityChange",
        "deathIncreasePct",
        "deathChangePct",
    ],
)
def state_progress_query(spark, sf):
    first, end = "2024-01-01", "2025-01-01"
    tests = positivity(_event_outcomes(spark, sf), EVENT_OUTCOMES, first, end)
    people = spark.createDataFrame([], "State string, StateAbbrev string, Population long")
    facts = settle(state_facts(_user_states(spark, sf), people, tests, first, end))
    table_rows = state_progress(state_averages_export(facts))

    def text(c: str):
        return F.array_join(F.transform(c, lambda x: F.round(x * 1000).cast("long").cast("string")), ",").alias(c)

    return table_rows.select(*[text(c) if c.endswith("Series") else F.col(c) for c in table_rows.columns])
