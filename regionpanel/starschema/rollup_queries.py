"""Shares, weekly buckets, year comparisons, patches and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import concat_key, week_ending, yes_flag
from ..operators.panel import dedupe, entities_with_data, keep_entities
from ..operators.rollup import (
    bucket_sum,
    mean_gap,
    patch_group,
    prior_year_delta,
    share_of_total,
    yearly_total,
    yoy_weeks,
)
from ..plans.cases import weekly_report
from ..plans.deaths import clean_weekly_deaths, state_deaths
from ..session import settle
from .registry import query
from .tables import NW, nation_day, nation_weeks, table

BASE_YEAR = 1999


def _line_cases(spark, sf):
    """Line items as cases: shipping week, line status as group, two return flags as outcomes."""
    flag = F.col("l_returnflag")
    return table(spark, sf, "lineitem").select(
        week_ending(F.to_date("l_shipdate")).alias("week_ending_date"),
        F.col("l_linestatus").alias("race_ethnicity_combined"),
        yes_flag(F.when(flag == "R", "Yes")).alias("death_flag"),
        yes_flag(F.when(flag == "A", "Yes")).alias("icu_flag"),
    )


_LINE_CASES = """cases AS (
  SELECT CAST(l_shipdate AS DATE) + 6 - CAST(dayofweek(CAST(l_shipdate AS DATE)) AS INTEGER) AS week_ending_date,
    l_linestatus AS race_ethnicity_combined,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS death_flag, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS icu_flag
  FROM lineitem)"""


@query(
    "share_of_total",
    f"""WITH {_LINE_CASES},
grouped AS (
  SELECT week_ending_date, race_ethnicity_combined, count(*) AS cases, CAST(sum(death_flag) AS BIGINT) AS death,
    CAST(sum(icu_flag) AS BIGINT) AS icu FROM cases GROUP BY 1, 2)
SELECT *, CAST(sum(cases) OVER week AS BIGINT) AS cases_total, cases / sum(cases) OVER week AS cases_pct,
  death / nullif(sum(death) OVER week, 0) AS death_pct
FROM grouped WINDOW week AS (PARTITION BY week_ending_date)""",
    dates=["week_ending_date"],
    doubles=["cases_pct", "death_pct"],
)
def share_of_total_query(spark, sf):
    return weekly_report(_line_cases(spark, sf))


@query(
    "share_by_supplier_nation",
    """SELECT s_nationkey, l_returnflag, count(*) AS lines, CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_lines,
  CAST(sum(count(*)) OVER (PARTITION BY s_nationkey) AS BIGINT) AS lines_total,
  count(*) / sum(count(*)) OVER (PARTITION BY s_nationkey) AS lines_pct
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""",
    doubles=["lines_pct"],
)
def share_by_supplier_nation(spark, sf):
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_returnflag", yes_flag(F.when(F.col("l_linestatus") == "O", "Yes")).alias("open")
    )
    joined = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return share_of_total(joined, "s_nationkey", "l_returnflag", {"open": "open_lines"}, ["lines"], "lines")


@query(
    "interval_bucket_sum",
    f"""WITH {NW}, ends AS (SELECT DISTINCT "Week_Ending_Date" AS end_date FROM nw)
SELECT nation, end_date, CAST(sum(n) AS BIGINT) AS total FROM nd JOIN ends ON day <= end_date AND day >= end_date - 6 GROUP BY 1, 2""",
    dates=["end_date"],
)
def interval_bucket_sum(spark, sf):
    days = settle(nation_day(spark, sf))
    ends = nation_weeks(days).select(F.col("Week_Ending_Date").alias("end_date"))
    return bucket_sum(days, ends, "nation", "day", "n", "end_date", "total")


@query(
    "interval_bucket_sum90",
    f"""WITH {NW}, ends AS (SELECT DISTINCT "Week_Ending_Date" AS end_date FROM nw)
SELECT nation, end_date, CAST(sum(n) AS BIGINT) AS total FROM nd JOIN ends ON day <= end_date AND day >= end_date - 89 GROUP BY 1, 2""",
    dates=["end_date"],
)
def interval_bucket_sum90(spark, sf):
    # Windows of ninety days that overlap twelve times.
    days = settle(nation_day(spark, sf))
    ends = nation_weeks(days).select(F.col("Week_Ending_Date").alias("end_date"))
    return bucket_sum(days, ends, "nation", "day", "n", "end_date", "total", days=90)


@query(
    "yoy_weeks",
    f"""WITH {NW}
SELECT "State", "Week_Of_Year", max("All_Cause") FILTER ("Year" = {BASE_YEAR}) AS "All_Cause1999",
  max("All_Cause") FILTER ("Year" = {BASE_YEAR} + 1) AS "All_Cause2000", max("All_Cause") FILTER ("Year" = {BASE_YEAR} + 2) AS "All_Cause2001"
FROM nw GROUP BY 1, 2 HAVING bool_or("Year" = {BASE_YEAR}) AND bool_or("Year" = {BASE_YEAR} + 1)""",
)
def yoy_weeks_query(spark, sf):
    return yoy_weeks(nation_weeks(nation_day(spark, sf)), "State", "Year", "Week_Of_Year", "All_Cause", BASE_YEAR)


_EXCESS = f"""{NW},
reported AS (
  SELECT 'NATION_' || nation AS "State", day + 6 - CAST(dayofweek(day) AS INTEGER) AS ends, CAST(sum(n_f) AS BIGINT) AS n_f FROM nd GROUP BY ALL),
weeks AS (
  SELECT "State", "Week_Of_Year", avg("All_Cause") FILTER ("Year" <= {BASE_YEAR}) AS "AvgDeaths_1994_1999",
    max("Week_Ending_Date") FILTER ("Year" = {BASE_YEAR} + 1) AS "Week_Ending_Date2000",
    max("Week_Ending_Date") FILTER ("Year" = {BASE_YEAR} + 2) AS "Week_Ending_Date2001",
    max("All_Cause") FILTER ("Year" = {BASE_YEAR}) AS "Deaths1999", max("All_Cause") FILTER ("Year" = {BASE_YEAR} + 1) AS "Deaths2000",
    max("All_Cause") FILTER ("Year" = {BASE_YEAR} + 2) AS "Deaths2001"
  FROM nw GROUP BY ALL),
excess AS (
  SELECT weeks.*, "Deaths2000" - "AvgDeaths_1994_1999" AS "Excess2000", 100.0 * "Excess2000" / "AvgDeaths_1994_1999" AS "ExcessPct2000",
    coalesce("Deaths2001", 0) - "AvgDeaths_1994_1999" AS "Excess2001", 100.0 * "Excess2001" / "AvgDeaths_1994_1999" AS "ExcessPct2001",
    n_f AS "Covid19DeathsForWeek"
  FROM weeks LEFT JOIN reported ON reported."State" = weeks."State" AND ends = "Week_Ending_Date2000"
  WHERE "Deaths1999" IS NOT NULL AND "Deaths2000" IS NOT NULL)"""


@query(
    "excess_over_baseline",
    f"WITH {_EXCESS} SELECT * FROM excess",
    dates=["Week_Ending_Date2000", "Week_Ending_Date2001"],
    doubles=["AvgDeaths_1994_1999", "Excess2000", "ExcessPct2000", "Excess2001", "ExcessPct2001"],
)
def excess_over_baseline_query(spark, sf):
    days = settle(nation_day(spark, sf))
    facts = days.select(
        F.concat(F.lit("N"), F.col("nation").cast("string")).alias("state"),
        F.col("day").alias("Date"),
        F.col("n_f").alias("deathIncrease"),
    )
    short = table(spark, sf, "nation").select(
        F.col("n_name").alias("state"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("abbreviation")
    )
    return state_deaths(nation_weeks(days), facts, short, BASE_YEAR)


@query(
    "excess_vs_reported",
    f"""WITH {_EXCESS}, m AS (SELECT "State", avg("Covid19DeathsForWeek") AS avg_reported, avg("Excess2000") AS avg_excess FROM excess GROUP BY 1)
SELECT *, avg_excess - avg_reported AS diff, (avg_excess - avg_reported) / nullif(avg_reported, 0) * 100 AS diff_pct FROM m""",
    doubles=["avg_reported", "avg_excess", "diff", "diff_pct"],
    places=9,
)
def excess_vs_reported(spark, sf):
    return mean_gap(excess_over_baseline_query.__wrapped__(spark, sf), "State", "Covid19DeathsForWeek", "Excess2000")


def _yearly(spark, sf):
    return yearly_total(nation_weeks(nation_day(spark, sf)), "Year", "All_Cause", "Deaths")


_YEARLY = f"""{NW}, yearly AS (SELECT "Year", sum("All_Cause") / 1000.0 AS "Deaths" FROM nw GROUP BY 1)"""


@query("yearly_total", f"WITH {_YEARLY} SELECT * FROM yearly", doubles=["Deaths"])
def yearly_total_query(spark, sf):
    return _yearly(spark, sf)


_DELTA = f"""{_YEARLY}, delta AS (
  SELECT a."Year", a."Deaths", b."Deaths" AS "DeathsPriorYear", (a."Deaths" - b."Deaths") / nullif(b."Deaths", 0) * 100.0 AS "Delta"
  FROM yearly a JOIN yearly b ON a."Year" = b."Year" + 1)"""


@query("prior_year_delta", f"WITH {_DELTA} SELECT * FROM delta", doubles=["Deaths", "DeathsPriorYear", "Delta"])
def prior_year_delta_query(spark, sf):
    return prior_year_delta(settle(_yearly(spark, sf)), "Year", "Deaths")


@query(
    "mean_prior_year_delta",
    f"""WITH {_DELTA} SELECT avg("Delta") AS mean_delta FROM delta WHERE "Year" <= {BASE_YEAR}""",
    doubles=["mean_delta"],
)
def mean_prior_year_delta(spark, sf):
    delta = prior_year_delta(settle(_yearly(spark, sf)), "Year", "Deaths")
    return delta.filter(F.col("Year") <= BASE_YEAR).agg(F.avg("Delta").alias("mean_delta"))


@query(
    "override_patch",
    """WITH t AS (
  SELECT c_mktsegment || '/' || c_nationkey AS code, count(*) AS population FROM customer GROUP BY 1
  UNION ALL SELECT r_name, CAST(max(n_nationkey) AS BIGINT) FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY 1),
patch AS (SELECT CAST(sum(population) AS BIGINT) AS p FROM t WHERE code IN ('BUILDING/1', 'BUILDING/2', 'MACHINERY/3', 'HOUSEHOLD/4'))
SELECT code, CASE WHEN code = 'BUILDING/1' THEN coalesce((SELECT p FROM patch), population) ELSE population END AS population FROM t""",
)
def override_patch(spark, sf):
    groups = (
        table(spark, sf, "customer")
        .groupBy(concat_key(F.col("c_mktsegment"), F.lit("/"), F.col("c_nationkey").cast("string")).alias("code"))
        .agg(F.count(F.lit(1)).alias("population"))
    )
    extra = (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .filter(F.col("r_name") == "ASIA")
        .groupBy(F.col("r_name").alias("code"))
        .agg(F.max("n_nationkey").cast("long").alias("population"))
    )
    members = ["BUILDING/1", "BUILDING/2", "MACHINERY/3", "HOUSEHOLD/4"]
    return patch_group(groups.unionByName(extra), "code", "population", "BUILDING/1", members)


@query(
    "regions_with_data",
    """WITH line AS (
  SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned, sum(CASE WHEN l_discount >= 0.1 THEN 1 ELSE 0 END) AS cheap
  FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_orderstatus FROM orders o
WHERE EXISTS (SELECT 1 FROM line WHERE l_orderkey = o.o_orderkey AND (returned > 0 OR cheap > 0))""",
)
def regions_with_data_query(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned"),
        F.when(F.col("l_discount") >= 0.1, 1).otherwise(0).alias("cheap"),
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return keep_entities(orders, entities_with_data(lines, "o_orderkey", ["returned", "cheap"]), "o_orderkey")


@query(
    "dedupe_keep_max",
    """WITH t AS (
  SELECT o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day, o_totalprice, o_orderkey,
    row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY CAST(o_orderdate AS DATE) DESC, o_totalprice DESC, o_orderkey) AS rn
  FROM orders)
SELECT o_custkey, o_orderstatus, day, o_totalprice, o_orderkey FROM t WHERE rn = 1""",
    dates=["day"],
    doubles=["o_totalprice"],
)
def dedupe_keep_max(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"), "o_totalprice", "o_orderkey"
    )
    order = [F.col("day").desc(), F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return dedupe(orders, ["o_custkey", "o_orderstatus"], order)


@query("union_eras", f"WITH {NW} SELECT * FROM nw", dates=["Week_Ending_Date"])
def union_eras_query(spark, sf):
    # Weekly rows as delivered in two eras: other date formats, other spelling of the count.
    weeks = settle(nation_weeks(nation_day(spark, sf)))

    def delivered(rows, pattern: str, count: str):
        return rows.select(
            F.col("State").alias("Jurisdiction_of_Occurrence"),
            F.col("Year").cast("string").alias("MMWR_Year"),
            F.col("Week_Of_Year").cast("string").alias("MMWR_Week"),
            F.date_format("Week_Ending_Date", pattern).alias("Week_Ending_Date"),
            F.col("All_Cause").cast("string").alias(count),
        )

    new = delivered(weeks.filter("Year >= 1998"), "yyyy-MM-dd", "All_Cause")
    old = delivered(weeks.filter("Year < 1998"), "M/d/yyyy", "All__Cause")
    return clean_weekly_deaths(new, old)


@query(
    "concat_key",
    """SELECT lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS code, count(*) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def concat_key_query(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    rows = table(spark, sf, "customer").select("c_nationkey").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    state = F.lpad(F.col("n_regionkey").cast("string"), 2, "0")
    county = F.lpad(F.col("c_nationkey").cast("string"), 3, "0")
    return rows.groupBy(concat_key(state, county).alias("code")).agg(F.count(F.lit(1)).alias("customers"))
