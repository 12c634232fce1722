"""Repairs, parses and flags on text derived from the tables, and the cleaned county panel end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    compact_date,
    is_placeable,
    numeric_text,
    parse_date,
    repair_code,
    week_ending,
    week_number,
    yes_flag,
)
from ..plans.cases import case_level
from ..plans.counties import clean_daily, county_base, county_dim, county_population, filtered_daily
from ..plans.states import clean_state_daily, state_dim
from .registry import query
from .tables import ND, code, nation_day, nation_people, table


@query(
    "flag_predicate",
    """SELECT o_orderkey, CAST(o_orderstatus <> 'P' AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  AND o_totalprice BETWEEN 50000 AND 400000 AS INTEGER) AS flag FROM orders""",
)
def flag_predicate(spark, sf):
    orders = table(spark, sf, "orders")
    priority, price = F.col("o_orderpriority"), F.col("o_totalprice")
    country = F.when(F.col("o_orderstatus") == "P", "CA").otherwise("US")
    county = (
        F.when(priority == "1-URGENT", "Unassigned")
        .when(priority == "2-HIGH", "Unknown")
        .when(priority == "3-MEDIUM", F.concat(F.lit("Out of "), F.col("o_orderstatus")))
        .when(priority != "5-LOW", "Adams")
    )
    province = F.when(price > 400000, "Recovered").when(price >= 50000, "Ohio")
    return orders.select("o_orderkey", is_placeable(country, county, province).alias("flag"))


@query(
    "code_repair",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN CAST(k AS VARCHAR) WHEN k < 100000 THEN lpad(CAST(k AS VARCHAR), 5, '0') END AS code
FROM (SELECT *, CASE WHEN c_custkey % 7 = 0 THEN 123400 + c_custkey ELSE c_custkey END AS k FROM customer)""",
)
def code_repair(spark, sf):
    # Every seventh key has six digits, many of them with the same first five.
    key = F.when(F.col("c_custkey") % 7 == 0, F.col("c_custkey") + 123400).otherwise(F.col("c_custkey")).cast("string")
    # Keys of four digits would gain a sixth character and stay recognisable; plain five-digit codes pass as they are.
    text = F.when((F.col("c_mktsegment") == "BUILDING") & (F.length(key) != 3), F.concat(key, F.lit(".0"))).otherwise(key)
    raw = F.when(F.col("c_acctbal") < 0, key).otherwise(text)
    flag = F.when(F.col("c_acctbal") < 0, 0).otherwise(1)
    return table(spark, sf, "customer").select("c_custkey", repair_code(raw, flag).alias("code"))


@query(
    "numeric_text_cast",
    """SELECT c_custkey, CAST(CASE WHEN c_acctbal < 0 THEN -floor(-c_acctbal + 0.5) ELSE floor(c_acctbal + 0.5) END AS BIGINT) AS whole,
  CAST(NULL AS BIGINT) AS bad, c_custkey AS same FROM customer""",
)
def numeric_text_cast(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        numeric_text(F.col("c_acctbal").cast("string")).alias("whole"),
        numeric_text(F.col("c_name")).alias("bad"),
        numeric_text(F.concat(F.col("c_custkey").cast("string"), F.lit(".0"))).alias("same"),
    )


@query(
    "parse_dates",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS compact, CAST(o_orderdate AS DATE) AS us, CAST(o_orderdate AS DATE) AS slashed,
  CAST(o_orderdate AS DATE) AS short, CAST(NULL AS DATE) AS bad, strftime(o_orderdate, '%Y%m%d') AS back FROM orders""",
    dates=["compact", "us", "slashed", "short"],
)
def parse_dates(spark, sf):
    day = F.to_date("o_orderdate")

    def back(pattern: str, *more: str):
        return parse_date(F.date_format(day, pattern), (pattern, *more))

    return table(spark, sf, "orders").select(
        "o_orderkey",
        back("yyyyMMdd").alias("compact"),
        back("MM/dd/yyyy").alias("us"),
        back("yyyy/MM/dd", "yyyy-MM-dd").alias("slashed"),
        back("M/d/yyyy").alias("short"),
        parse_date(F.col("o_orderpriority"), "yyyyMMdd").alias("bad"),
        compact_date(day).alias("back"),
    )


@query(
    "week_parts",
    """SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(strftime(l_shipdate, '%U') AS INTEGER) AS week_of_year,
  CAST(l_shipdate AS DATE) + 6 - CAST(dayofweek(l_shipdate) AS INTEGER) AS week_ending_date FROM lineitem""",
    dates=["week_ending_date"],
)
def week_parts(spark, sf):
    day = F.to_date("l_shipdate")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.year(day).alias("year"),
        week_number(day).alias("week_of_year"),
        week_ending(day).alias("week_ending_date"),
    )


@query(
    "flag_columns",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS f_flag, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS u_flag
FROM orders""",
)
def flag_columns(spark, sf):
    def answer(c, yes: str):
        return F.when(F.col(c) == yes, "Yes").when(F.col("o_totalprice") > 100000, "No")

    return table(spark, sf, "orders").select(
        "o_orderkey",
        yes_flag(answer("o_orderstatus", "F")).alias("f_flag"),
        yes_flag(answer("o_orderpriority", "1-URGENT")).alias("u_flag"),
    )


@query(
    "case_level_rows",
    """SELECT CAST(l_shipdate AS DATE) AS first_day, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(strftime(l_shipdate, '%U') AS INTEGER) AS week_of_year,
  count(*) AS cases, count(*) FILTER (l_returnflag = 'R') AS deaths, count(*) FILTER (l_linestatus = 'O') AS hosp,
  CAST(max(l_shipdate) AS DATE) + 6 - CAST(dayofweek(max(l_shipdate)) AS INTEGER) AS week_ending_date
FROM lineitem GROUP BY 1, 2, 3""",
    dates=["first_day", "week_ending_date"],
)
def case_level_rows(spark, sf):
    day = F.date_format("l_shipdate", "yyyy/MM/dd")
    blank = F.lit(None).cast("string")
    raw = table(spark, sf, "lineitem").select(
        day.alias("cdc_case_earliest_dt"),
        day.alias("cdc_report_dt"),
        blank.alias("pos_spec_dt"),
        blank.alias("onset_dt"),
        F.lit("Laboratory-confirmed case").alias("current_status"),
        blank.alias("sex"),
        blank.alias("age_group"),
        F.col("l_linestatus").alias("race_ethnicity_combined"),
        F.when(F.col("l_linestatus") == "O", "Yes").otherwise("No").alias("hosp_yn"),
        F.lit("Missing").alias("icu_yn"),
        F.when(F.col("l_returnflag") == "R", "Yes").alias("death_yn"),
        blank.alias("medcond_yn"),
    )
    cases = case_level(raw)
    return cases.groupBy(F.col("cdc_case_earliest_dt").alias("first_day"), "year", "week_of_year", "week_ending_date").agg(
        F.count(F.lit(1)).alias("cases"), F.sum("death_flag").alias("deaths"), F.sum("hosp_flag").alias("hosp")
    )


def raw_county_rows(spark, sf):
    """Nation-days as delivered daily county rows: text, codes without leading zeros, a lower duplicate per row."""
    days = nation_day(spark, sf).withColumn("number", F.col("nation") + 1001)
    copies = days.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    short = F.when(F.col("n") % 2 == 0, F.concat(F.col("number").cast("string"), F.lit(".0"))).otherwise(
        F.col("number").cast("string")
    )
    blank = F.lit(None).cast("string")

    def count(c: str):
        return F.concat((F.col(c) - F.col("copy")).cast("string"), F.lit(".0"))

    return copies.select(
        compact_date(F.col("day")).alias("Date"),
        short.alias("FIPS"),
        F.concat(F.lit("County "), F.col("nation").cast("string")).alias("Admin2"),
        F.lit("Ohio").alias("Province_State"),
        F.lit("US").alias("Country_Region"),
        blank.alias("Last_Update"),
        F.lit("1.5").alias("Lat"),
        F.lit("-2.5").alias("Long_"),
        count("n").alias("Confirmed"),
        count("n_f").alias("Deaths"),
        blank.alias("Recovered"),
        F.lit("0").alias("Active"),
        F.concat(F.col("nation").cast("string"), F.lit(", Ohio, US")).alias("Combined_Key"),
    )


@query(
    "county_facts",
    f"""WITH {ND}, t AS (
  SELECT day AS "Date", '0' || (nation + 1001) AS "FIPS", n AS "Confirmed", n_f AS "Deaths" FROM nd),
i AS (
  SELECT t.*, greatest(t."Confirmed" - coalesce(e."Confirmed", 0), 0) AS "ConfirmedIncrease",
    greatest(t."Deaths" - coalesce(e."Deaths", 0), 0) AS "DeathsIncrease"
  FROM t LEFT JOIN t e ON e."FIPS" = t."FIPS" AND e."Date" = t."Date" - 1)
SELECT *, CAST(NULL AS BIGINT) AS "Recovered", CAST(0 AS BIGINT) AS "Active",
  avg("ConfirmedIncrease") OVER w AS "Avg7DayConfirmedIncrease", avg("DeathsIncrease") OVER w AS "Avg7DayDeathsIncrease"
FROM i WINDOW w AS (PARTITION BY "FIPS" ORDER BY "Date" ROWS 6 PRECEDING)""",
    dates=['"Date"'],
    doubles=["Avg7DayConfirmedIncrease", "Avg7DayDeathsIncrease"],
)
def county_facts(spark, sf):
    return county_base(filtered_daily(clean_daily(raw_county_rows(spark, sf))))


@query(
    "entity_dim",
    """WITH last AS (SELECT c_nationkey, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT '0' || (c_nationkey + 1001) AS "FIPS", 'County ' || c_nationkey AS "County", 'Ohio' AS "State", '1.5' AS "Lat", '-2.5' AS "Long_",
  c_nationkey || ', Ohio, US' AS "Combined_Key", (SELECT count(*) FROM customer c WHERE c.c_nationkey = last.c_nationkey) AS "Population",
  CAST(50000 + c_nationkey AS BIGINT) AS "MedianIncome", CAST(30.5 + c_nationkey AS DOUBLE) AS "MedianAge"
FROM last""",
    doubles=["MedianAge"],
)
def entity_dim(spark, sf):
    people = nation_people(spark, sf)
    number = F.col("n_nationkey") + 1001
    padded = code(number)
    state, county = F.substring(padded, 1, 2), F.substring(padded, 3, 3)
    counties = people.select(
        F.lit("Ohio").alias("STNAME"),
        F.col("n_name").alias("CTYNAME"),
        state.alias("STATE"),
        county.alias("COUNTY"),
        F.col("population").cast("string").alias("POPESTIMATE2019"),
    )
    states = people.select(F.col("r_name").alias("NAME"), F.col("population").cast("string").alias("POPESTIMATE2019"))
    survey = people.select(
        state.alias("state"),
        county.alias("county"),
        (F.col("n_nationkey") + 50000).cast("string").alias("CP03_2014_2018_062E"),
        (F.col("n_nationkey") + 30.5).cast("string").alias("CP05_2014_2018_018E"),
    )
    filtered = filtered_daily(clean_daily(raw_county_rows(spark, sf)))
    return county_dim(filtered, county_population(counties, states), survey)


@query(
    "state_dim",
    """SELECT n_name AS "State", CASE WHEN r_name <> 'ASIA' THEN 'N' || n_nationkey END AS "StateAbbrev",
  (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS "Population"
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey > 0""",
)
def state_dim_query(spark, sf):
    people = nation_people(spark, sf)
    population = people.select(
        F.col("n_name").alias("NAME"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("STATE"),
        F.col("population").cast("string").alias("POPESTIMATE2019"),
    )
    short = people.filter(F.col("r_name") != "ASIA").select(
        F.col("n_name").alias("state"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("abbreviation")
    )
    return state_dim(population, short)


@query(
    "clean_state_rows",
    f"""WITH {ND} SELECT day AS "Date", CAST(nation AS VARCHAR) AS state, n AS positive, greatest(n_f - n_o, 0) AS "positiveIncrease",
  n_f AS death, n_f - n_p AS "deathIncrease", CAST(NULL AS BIGINT) AS hospitalized, CAST(NULL AS BIGINT) AS "hospitalizedIncrease",
  CAST(NULL AS BIGINT) AS "totalTestResultsIncrease" FROM nd""",
    dates=['"Date"'],
)
def clean_state_rows(spark, sf):
    raw = nation_day(spark, sf).select(
        F.date_format("day", "MM/dd/yyyy").alias("submission_date"),
        F.col("nation").cast("string").alias("state"),
        F.col("n").cast("string").alias("tot_cases"),
        (F.col("n_f") - F.col("n_o")).cast("string").alias("new_case"),
        F.col("n_f").cast("string").alias("tot_death"),
        (F.col("n_f") - F.col("n_p")).cast("string").alias("new_death"),
    )
    return clean_state_daily(raw)
