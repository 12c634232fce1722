"""Panels built from the star-schema tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import week_ending, week_number
from ..operators.panel import by_day


# Schemas by path, read from the footers once: opening a table again starts no job.
_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def order_days(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Orders per entity (``region`` or ``nation``) and day: count, counts by status, and cents.

    The customer table carries the entity; whether it is broadcast is left to its size, and a customer with a
    great many orders to the skew handling of the join. Grouping combines before the shuffle.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    if entity == "region":
        nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
        placed = placed.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("n_regionkey" if entity == "region" else "c_nationkey")

    def with_status(s: str):
        return F.count(F.when(F.col("o_orderstatus") == s, 1))

    return placed.groupBy(key.alias(entity), F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        with_status("F").alias("n_f"),
        with_status("O").alias("n_o"),
        with_status("P").alias("n_p"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"),
    )


def region_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_days(spark, sf_dir, "region")


def nation_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_days(spark, sf_dir, "nation")


def code(entity: Column) -> Column:
    """Entity number as a five-digit region code."""
    return F.lpad(entity.cast("string"), 5, "0")


def county_totals(days: DataFrame, entity: str) -> DataFrame:
    """Day counts as running totals under the county panel's column names."""
    coded = days.withColumns({"Date": F.col("day"), "FIPS": code(F.col(entity))})
    upto = by_day("FIPS", "Date").rowsBetween(Window.unboundedPreceding, 0)
    return coded.select(
        "Date",
        "FIPS",
        F.sum("n").over(upto).alias("Confirmed"),
        F.sum("n_f").over(upto).alias("Deaths"),
        F.sum("n_o").over(upto).alias("Recovered"),
        F.sum("n_p").over(upto).alias("Active"),
    )


def region_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions with their number of customers as population."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    counts = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_regionkey").alias("r_regionkey"))
        .agg(F.count(F.lit(1)).alias("population"))
    )
    return table(spark, sf_dir, "region").join(counts, "r_regionkey", "left")


def nation_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with region name and number of customers as population."""
    counts = (
        table(spark, sf_dir, "customer")
        .groupBy(F.col("c_nationkey").alias("n_nationkey"))
        .agg(F.count(F.lit(1)).alias("population"))
    )
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(counts, "n_nationkey", "left")
    )


def nation_weeks(days: DataFrame) -> DataFrame:
    """Nation-days per nation, year and week under the weekly deaths table's column names."""
    return days.groupBy(
        F.concat(F.lit("NATION_"), F.col("nation").cast("string")).alias("State"),
        F.year("day").alias("Year"),
        week_number(F.col("day")).alias("Week_Of_Year"),
        week_ending(F.col("day")).alias("Week_Ending_Date"),
    ).agg(F.sum("n").alias("All_Cause"))


def event_days(spark: SparkSession, sf_dir: str, entity: str = "event_type") -> DataFrame:
    """Events per entity and day with their value in cents."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(entity, F.to_date("ts").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col("event_type") == "error", 1)).alias("n_error"),
            F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"),
        )
    )


def sql_order_days(entity: str, name: str) -> str:
    key = "n_regionkey" if entity == "region" else "c_nationkey"
    return f"""{name} AS (
  SELECT {key} AS {entity}, CAST(o_orderdate AS DATE) AS day, count(*) AS n,
    count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') AS n_o,
    count(*) FILTER (o_orderstatus = 'P') AS n_p,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)"""


RD = sql_order_days("region", "rd")
ND = sql_order_days("nation", "nd")


def sql_totals(days: str, entity: str, name: str = "totals") -> str:
    upto = f"OVER (PARTITION BY {entity} ORDER BY day ROWS UNBOUNDED PRECEDING)"
    return f"""{name} AS (
  SELECT day AS "Date", lpad(CAST({entity} AS VARCHAR), 5, '0') AS "FIPS",
    CAST(sum(n) {upto} AS BIGINT) AS "Confirmed", CAST(sum(n_f) {upto} AS BIGINT) AS "Deaths",
    CAST(sum(n_o) {upto} AS BIGINT) AS "Recovered", CAST(sum(n_p) {upto} AS BIGINT) AS "Active"
  FROM {days})"""


# The base panel by self-join on the day before.
SQL_BASE = """increments AS (
  SELECT t."Date", t."FIPS", t."Confirmed",
    CASE WHEN t."Confirmed" IS NOT NULL THEN greatest(t."Confirmed" - coalesce(e."Confirmed", 0), 0) END AS "ConfirmedIncrease",
    t."Deaths",
    CASE WHEN t."Deaths" IS NOT NULL THEN greatest(t."Deaths" - coalesce(e."Deaths", 0), 0) END AS "DeathsIncrease",
    t."Recovered", t."Active"
  FROM totals t LEFT JOIN totals e ON t."FIPS" = e."FIPS" AND e."Date" = t."Date" - 1),
base AS (
  SELECT *,
    avg("ConfirmedIncrease") OVER w AS "Avg7DayConfirmedIncrease",
    avg("DeathsIncrease") OVER w AS "Avg7DayDeathsIncrease"
  FROM increments WINDOW w AS (PARTITION BY "FIPS" ORDER BY "Date" ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""

def _changes(prefix: str, measure: str, back: str, diff_blank: str, pct_blank: str) -> str:
    """Change of a measure over a window ``back`` that holds one day only, and the change as a share of that day's value."""
    then = f'max("{measure}") OVER {back}'
    gain = f'"{measure}" - {then}'
    share = f"CASE WHEN {then} > 0 THEN ({gain}) / {then} END"
    blank = {"zero": "coalesce({}, 0)", "null": "{}"}
    return f'{blank[diff_blank].format(gain)} AS "{prefix}", {blank[pct_blank].format(share)} AS "{prefix}Pct"'


_MEAN = "Avg7DayConfirmedIncrease"
_CHANGES = (
    ("OneWeekConfirmedIncrease", "Confirmed", "d7", "zero", "zero"),
    ("TwoWeekConfirmedIncrease", "Confirmed", "d14", "zero", "zero"),
    ("MonthConfirmedIncrease", "Confirmed", "d30", "zero", "zero"),
    (f"TwoWeek{_MEAN}", _MEAN, "d14", "zero", "null"),
    (f"Month{_MEAN}", _MEAN, "d30", "zero", "zero"),
    ("TwoWeekAvg7DayDeathsIncrease", "Avg7DayDeathsIncrease", "d14", "zero", "zero"),
    ("MonthAvg7DayDeathsIncrease", "Avg7DayDeathsIncrease", "d30", "null", "null"),
)
_BACK = ", ".join(
    f'd{n} AS (PARTITION BY "FIPS" ORDER BY "Date" RANGE BETWEEN INTERVAL {n} DAYS PRECEDING AND INTERVAL {n} DAYS PRECEDING)' for n in (7, 14, 30)
)

# The progress panel by frames that hold the one day so many days ago; needs CTEs base and dim(FIPS, Population).
SQL_PROGRESS = f"""wide AS (
  SELECT "FIPS", "Date", "Confirmed", "ConfirmedIncrease", "{_MEAN}", "Deaths", "DeathsIncrease", "Avg7DayDeathsIncrease",
    "ConfirmedIncrease" / nullif("Confirmed" - "ConfirmedIncrease", 0) AS "ConfirmedIncreasePct",
    "DeathsIncrease" / nullif("Deaths" - "DeathsIncrease", 0) AS "DeathsIncreasePct",
    {", ".join(_changes(*c) for c in _CHANGES)},
    greatest(coalesce(100000.0 * coalesce("Confirmed" - max("Confirmed") OVER d14, 0) / nullif("Population", 0), 0), 0) AS "CasesPer100k"
  FROM base JOIN (SELECT "FIPS" AS code, "Population" FROM dim) ON "FIPS" = code WINDOW {_BACK}),
weekly AS (SELECT *, max("CasesPer100k") OVER d7 AS rate7 FROM wide WINDOW {_BACK}),
progress AS (
  SELECT * EXCLUDE (rate7), "CasesPer100k" - rate7 AS "OneWeekCasesPer100kChange",
    ("CasesPer100k" - rate7) / nullif(rate7, 0) AS "OneWeekCasesPer100kChangePct"
  FROM weekly WHERE rate7 IS NOT NULL)"""

PROGRESS_DOUBLES = (
    "ConfirmedIncreasePct",
    "Avg7DayConfirmedIncrease",
    "OneWeekConfirmedIncreasePct",
    "TwoWeekConfirmedIncreasePct",
    "MonthConfirmedIncreasePct",
    "TwoWeekAvg7DayConfirmedIncrease",
    "TwoWeekAvg7DayConfirmedIncreasePct",
    "MonthAvg7DayConfirmedIncrease",
    "MonthAvg7DayConfirmedIncreasePct",
    "DeathsIncreasePct",
    "Avg7DayDeathsIncrease",
    "TwoWeekAvg7DayDeathsIncrease",
    "TwoWeekAvg7DayDeathsIncreasePct",
    "MonthAvg7DayDeathsIncrease",
    "MonthAvg7DayDeathsIncreasePct",
    "CasesPer100k",
    "OneWeekCasesPer100kChange",
    "OneWeekCasesPer100kChangePct",
)

SQL_REGION_DIM = """dim AS (
  SELECT lpad(CAST(n_regionkey AS VARCHAR), 5, '0') AS "FIPS", count(*) AS "Population"
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)"""

SQL_NATION_DIM = """dim AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS "FIPS", n_name AS "County", r_name AS "State",
    (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS "Population"
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

NW = f"""{ND},
nw AS (
  SELECT 'NATION_' || nation AS "State", CAST(year(day) AS INTEGER) AS "Year",
    CAST(strftime(day, '%U') AS INTEGER) AS "Week_Of_Year", day + 6 - CAST(dayofweek(day) AS INTEGER) AS "Week_Ending_Date",
    CAST(sum(n) AS BIGINT) AS "All_Cause"
  FROM nd GROUP BY 1, 2, 3, 4)"""


def sql_upper_limit(value: str, limits, above: str) -> str:
    """The smallest limit that is not below the value."""
    return f"coalesce(list_min(list_filter({list(limits)}, lambda x: x >= {value})), {above})"


def sql_trend(change: str, pct: str, bands) -> str:
    """Direction and band: how many bands the size of the change leaves behind; a fall past the last one has no label."""
    passed = f"coalesce(len(list_filter({list(bands)}, lambda x: x < abs({pct}))), 0)"
    return (
        f"CASE WHEN coalesce({change}, 0) = 0 OR ({change} < 0 AND {passed} = {len(bands)}) THEN 'none' "
        f"ELSE CASE WHEN {change} > 0 THEN 'up' ELSE 'down' END || ({passed} + 1) END"
    )


def sql_event_days(entity: str, name: str = "ed") -> str:
    return f"""{name} AS (
  SELECT {entity}, CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (event_type = 'error') AS n_error,
    CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM events GROUP BY 1, 2)"""
