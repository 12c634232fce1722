"""County panel: cleaned daily rows, base panel, progress panel and their exports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    change_pct,
    guarded_ratio,
    is_placeable,
    iso_date,
    numeric_text,
    parse_date,
    rate_change,
    rate_change_pct,
    rate_per,
    repair_code,
)
from ..functions.codes import HOME_COUNTRY
from ..operators.panel import (
    base_panel,
    dedupe,
    earlier,
    entities_with_data,
    first_rows_after,
    has_earlier,
    keep_entities,
    latest_per,
    with_rows_before,
)
from ..operators.report import trailing_days
from ..operators.rollup import patch_group

TOTALS = ("Confirmed", "Deaths", "Recovered", "Active")
#: Partition column of stored panels: the first of the date's month.
MONTH = "month"
EXPORT_DAYS = 30
#: Days before a row that its changes look at, rows of a mean, and months in which its rows are looked for first.
REACH = 30
MEAN_ROWS = 7
NEAR_MONTHS = 2

# Codes that repeat a territory, a city reported under one of its five counties, and the code
# under which a territory's own total is added.
REPEATED_CODES = ("00078", "00066")
CITY_CODE = "36061"
CITY_MEMBERS = ("36061", "36005", "36047", "36081", "36085")
TERRITORY_NAME = "Puerto Rico"
TERRITORY_CODE = "00072"


def clean_daily(raw: DataFrame) -> DataFrame:
    """Raw daily rows with repaired codes and whole numbers."""
    placeable = is_placeable(F.col("Country_Region"), F.col("Admin2"), F.col("Province_State"))
    flagged = raw.withColumn("ShouldHaveFIPS", placeable)
    return flagged.withColumns(
        {
            "FIPS": repair_code(F.col("FIPS"), F.col("ShouldHaveFIPS")),
            **{c: numeric_text(F.col(c)) for c in TOTALS},
        }
    )


def _home(clean: DataFrame) -> DataFrame:
    return clean.filter(
        (F.col("Country_Region") == HOME_COUNTRY) & ~F.col("FIPS").isin(*REPEATED_CODES) & (F.length("FIPS") > 0)
    )


def regions_with_data(clean: DataFrame) -> DataFrame:
    """Codes of the home country with any count above zero, territories counted once."""
    return entities_with_data(_home(clean), "FIPS", TOTALS)


def monthly_totals(clean: DataFrame) -> DataFrame:
    """Sums per code and month, from which `entities_with_data` gives what `regions_with_data` does."""
    return _home(clean).groupBy(MONTH, "FIPS").agg(*[F.sum(c).alias(c) for c in TOTALS])


def filtered_daily(clean: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """One row per code and day; of repeated rows the one with the higher counts.

    ``entities`` are the codes to keep, those of `regions_with_data` by default.

    Repeats go before the codes are looked up: they are dropped ahead of each shuffle, so a code with a great
    many copies reaches the join with one row per day.
    """
    rows = clean.filter("ShouldHaveFIPS = 1 and FIPS is not null").withColumn(
        "Date", parse_date(F.col("Date"), "yyyyMMdd")
    )
    # Rows of the same counts are told apart by one number, the same in every run.
    rest = F.xxhash64(*[c for c in rows.columns if c not in ("FIPS", "Date", "Confirmed", "Deaths", MONTH)])
    order = [F.col("Confirmed").desc_nulls_last(), F.col("Deaths").desc_nulls_last(), rest]
    known = regions_with_data(clean) if entities is None else entities
    return keep_entities(dedupe(rows, ["FIPS", "Date"], order), known, "FIPS")


def county_population(counties: DataFrame, states: DataFrame) -> DataFrame:
    """Population by code, the territory's total added and the city's counties summed under the city's code."""
    by_county = counties.select(
        "STNAME",
        "CTYNAME",
        F.concat("STATE", "COUNTY").alias("FIPS"),
        numeric_text(F.col("POPESTIMATE2019")).alias("Population"),
    )
    territory = states.filter(F.col("NAME") == TERRITORY_NAME).select(
        F.col("NAME").alias("STNAME"),
        F.col("NAME").alias("CTYNAME"),
        F.lit(TERRITORY_CODE).alias("FIPS"),
        numeric_text(F.col("POPESTIMATE2019")).alias("Population"),
    )
    return patch_group(by_county.unionByName(territory), "FIPS", "Population", CITY_CODE, CITY_MEMBERS)


def county_dim(filtered: DataFrame, population: DataFrame, survey: DataFrame) -> DataFrame:
    """Latest attributes of each code with population and survey figures."""
    latest = latest_per(filtered, "FIPS", "Date", F.col("Combined_Key").desc_nulls_last()).select(
        "FIPS", F.col("Admin2").alias("County"), F.col("Province_State").alias("State"), "Lat", "Long_", "Combined_Key"
    )
    figures = survey.select(
        F.concat("state", "county").alias("FIPS"),
        numeric_text(F.col("CP03_2014_2018_062E")).alias("MedianIncome"),
        F.col("CP05_2014_2018_018E").try_cast("double").alias("MedianAge"),
    )
    people = population.select("FIPS", "Population")
    return latest.join(people, "FIPS", "left").join(figures, "FIPS", "left").distinct()


def county_base(filtered: DataFrame) -> DataFrame:
    """Running totals, daily increments and row-based 7-day means per code and day."""
    panel = filtered.select("Date", "FIPS", *TOTALS)
    return base_panel(
        panel,
        "FIPS",
        "Date",
        {"Confirmed": "ConfirmedIncrease", "Deaths": "DeathsIncrease"},
        {"ConfirmedIncrease": "Avg7DayConfirmedIncrease", "DeathsIncrease": "Avg7DayDeathsIncrease"},
    ).select(
        "Date",
        "FIPS",
        "Confirmed",
        "ConfirmedIncrease",
        "Deaths",
        "DeathsIncrease",
        "Recovered",
        "Active",
        "Avg7DayConfirmedIncrease",
        "Avg7DayDeathsIncrease",
    )


def month_end(day: dt.date) -> dt.date:
    return (day.replace(day=1) + dt.timedelta(days=32)).replace(day=1) - dt.timedelta(days=1)


def months_between(first: dt.date, last: dt.date) -> list[str]:
    """First days of all months from that of ``first`` to that of ``last``, as a table's parts are named."""
    begin, end = (d.year * 12 + d.month - 1 for d in (first, last))
    return [dt.date(m // 12, m % 12 + 1, 1).isoformat() for m in range(begin, end + 1)]


def base_of_months(daily: DataFrame, first: dt.date, last: dt.date) -> tuple[DataFrame, dt.date]:
    """`county_base` for changes in the months ``first`` to ``last`` (their first days): all days they reach, to the end
    of a month, and the last day reached. ``daily`` is stored by month.

    A mean over seven rows reaches the six rows after a change, whenever these are, and needs the six before it.
    """
    later = daily.filter(F.col(MONTH) > F.lit(last))
    reached = first_rows_after(later, "FIPS", "Date", MEAN_ROWS - 1).agg(F.max("Date")).first()[0]
    upto = reached or month_end(last)
    here = daily.filter(F.col(MONTH).between(F.lit(first), F.lit(upto.replace(day=1))))
    near = F.add_months(F.lit(first), -NEAR_MONTHS)
    before = daily.filter((F.col(MONTH) >= near) & (F.col(MONTH) < F.lit(first)))
    older = daily.filter(F.col(MONTH) < near)
    panel = with_rows_before(here, before, older, "FIPS", "Date", MEAN_ROWS - 1)
    return county_base(panel).filter(F.col("Date").between(F.lit(first), F.lit(month_end(upto)))), upto


def progress_of_months(base: DataFrame, dim: DataFrame, first: dt.date, upto: dt.date) -> tuple[DataFrame, dt.date]:
    """`county_progress` of the days that changes of ``base`` from ``first`` to ``upto`` reach, and the last of them.

    Changes look back ``REACH`` days, and at rates a week ago.
    """
    last = upto + dt.timedelta(days=REACH)
    begin = first - dt.timedelta(days=REACH + 7)
    near = base.filter((F.col(MONTH) >= F.trunc(F.lit(begin), "month")) & (F.col(MONTH) <= F.trunc(F.lit(last), "month")))
    rows = county_progress(near.filter(F.col("Date") >= F.lit(begin)).drop(MONTH), dim)
    return rows.filter(F.col("Date").between(F.lit(first), F.lit(month_end(last)))), last


def county_progress(base: DataFrame, dim: DataFrame) -> DataFrame:
    """Changes over a day, a week, two weeks and a month, and the two-week rate with its weekly change.

    Keeps days whose code also has a row a week earlier. Every lag is a frame of windows over the same
    partitions, so the panel is shuffled and sorted once.
    """
    panel = base.join(dim.select("FIPS", "Population"), "FIPS")
    lagged = panel.withColumns(
        {
            **{f"_c{k}": earlier("Confirmed", "FIPS", "Date", k) for k in (7, 14, 30)},
            **{f"_has{k}": has_earlier("FIPS", "Date", k) for k in (7, 14, 30)},
            **{f"_ac{k}": earlier("Avg7DayConfirmedIncrease", "FIPS", "Date", k) for k in (14, 30)},
            **{f"_ad{k}": earlier("Avg7DayDeathsIncrease", "FIPS", "Date", k) for k in (14, 30)},
        }
    )
    confirmed, avg_c, avg_d = F.col("Confirmed"), F.col("Avg7DayConfirmedIncrease"), F.col("Avg7DayDeathsIncrease")

    def grown(k: int) -> Column:
        return F.when(F.col(f"_has{k}"), confirmed - F.coalesce(F.col(f"_c{k}"), F.lit(0)))

    def or_zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0.0))

    def whole_or_zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0).cast("long"))

    wide = lagged.select(
        "FIPS",
        "Date",
        "Confirmed",
        "ConfirmedIncrease",
        guarded_ratio(F.col("ConfirmedIncrease"), confirmed - F.col("ConfirmedIncrease")).alias("ConfirmedIncreasePct"),
        "Avg7DayConfirmedIncrease",
        whole_or_zero(grown(7)).alias("OneWeekConfirmedIncrease"),
        or_zero(change_pct(confirmed, F.col("_c7"))).alias("OneWeekConfirmedIncreasePct"),
        whole_or_zero(grown(14)).alias("TwoWeekConfirmedIncrease"),
        or_zero(change_pct(confirmed, F.col("_c14"))).alias("TwoWeekConfirmedIncreasePct"),
        whole_or_zero(grown(30)).alias("MonthConfirmedIncrease"),
        or_zero(change_pct(confirmed, F.col("_c30"))).alias("MonthConfirmedIncreasePct"),
        or_zero(avg_c - F.col("_ac14")).alias("TwoWeekAvg7DayConfirmedIncrease"),
        change_pct(avg_c, F.col("_ac14")).alias("TwoWeekAvg7DayConfirmedIncreasePct"),
        or_zero(avg_c - F.col("_ac30")).alias("MonthAvg7DayConfirmedIncrease"),
        or_zero(change_pct(avg_c, F.col("_ac30"))).alias("MonthAvg7DayConfirmedIncreasePct"),
        "Deaths",
        "DeathsIncrease",
        guarded_ratio(F.col("DeathsIncrease"), F.col("Deaths") - F.col("DeathsIncrease")).alias("DeathsIncreasePct"),
        "Avg7DayDeathsIncrease",
        or_zero(avg_d - F.col("_ad14")).alias("TwoWeekAvg7DayDeathsIncrease"),
        or_zero(change_pct(avg_d, F.col("_ad14"))).alias("TwoWeekAvg7DayDeathsIncreasePct"),
        (avg_d - F.col("_ad30")).alias("MonthAvg7DayDeathsIncrease"),
        change_pct(avg_d, F.col("_ad30")).alias("MonthAvg7DayDeathsIncreasePct"),
        rate_per(grown(14), F.col("Population"), clamp=True).alias("CasesPer100k"),
    )
    week_ago = earlier("CasesPer100k", "FIPS", "Date", 7)
    return (
        wide.withColumns({"_week_ago": week_ago, "_has_week_ago": has_earlier("FIPS", "Date", 7)})
        .filter("_has_week_ago")
        .withColumns(
            {
                "OneWeekCasesPer100kChange": rate_change(F.col("CasesPer100k"), F.col("_week_ago")),
                "OneWeekCasesPer100kChangePct": rate_change_pct(F.col("CasesPer100k"), F.col("_week_ago")),
            }
        )
        .drop("_week_ago", "_has_week_ago")
    )


# Columns of the rate-of-change export that come straight from the progress panel, in export order.
SNAPSHOT_MEASURES = (
    "Confirmed",
    "ConfirmedIncrease",
    "ConfirmedIncreasePct",
    "Avg7DayConfirmedIncrease",
    "OneWeekConfirmedIncrease",
    "OneWeekConfirmedIncreasePct",
    "TwoWeekConfirmedIncrease",
    "TwoWeekConfirmedIncreasePct",
    "MonthConfirmedIncrease",
    "MonthConfirmedIncreasePct",
    "TwoWeekAvg7DayConfirmedIncrease",
    "TwoWeekAvg7DayConfirmedIncreasePct",
    "MonthAvg7DayConfirmedIncrease",
    "MonthAvg7DayConfirmedIncreasePct",
    "Deaths",
    "DeathsIncrease",
    "DeathsIncreasePct",
    "TwoWeekAvg7DayDeathsIncrease",
    "TwoWeekAvg7DayDeathsIncreasePct",
    "MonthAvg7DayDeathsIncrease",
    "MonthAvg7DayDeathsIncreasePct",
)


def latest_progress(base: DataFrame, dim: DataFrame) -> DataFrame:
    """The latest day of the progress panel, from the month of base rows it looks at.

    That day is the last on which some code has a row a week earlier, too. Finding it takes a count over codes
    and dates alone; the wide windows then run over 31 days instead of the whole history.
    """
    known = base.select("FIPS", "Date").join(dim.select("FIPS"), "FIPS", "left_semi")
    last = known.withColumn("_has", has_earlier("FIPS", "Date", 7)).filter("_has").agg(F.max("Date")).scalar()
    month = base.filter((F.col("Date") >= F.date_sub(last, 30)) & (F.col("Date") <= last))
    return county_progress(month, dim).filter(F.col("Date") == last)


def county_snapshot(latest: DataFrame, counties: DataFrame, states: DataFrame) -> DataFrame:
    """Progress rows of the latest day with place names: the rate-of-change export, 31 columns.

    ``latest`` is the result of `latest_progress`, or of `latest_day` on a stored progress panel.
    """
    place = counties.join(states.select("State", "StateAbbrev"), "State").select(
        "FIPS", "County", F.col("StateAbbrev").alias("State"), "Lat", "Long_", "Population"
    )
    return latest.join(place, "FIPS").select(
        "FIPS",
        iso_date(F.col("Date")).alias("Date"),
        "County",
        "State",
        "Lat",
        "Long_",
        *SNAPSHOT_MEASURES,
        "Population",
        "CasesPer100k",
        "OneWeekCasesPer100kChange",
        "OneWeekCasesPer100kChangePct",
    )


def _with_month(df: DataFrame, *columns: str) -> DataFrame:
    """The columns, and the partition column if the frame is read from a table stored by month."""
    return df.select(*columns, *[c for c in (MONTH,) if c in df.columns])


def county_averages_export(base: DataFrame, days: int = EXPORT_DAYS) -> DataFrame:
    """7-day means of the last 30 days."""
    columns = ("FIPS", "Date", "Avg7DayConfirmedIncrease", "Avg7DayDeathsIncrease")
    return trailing_days(_with_month(base, *columns), "Date", days, month=MONTH).select(*columns)


def county_rate_export(progress: DataFrame, base: DataFrame, days: int = EXPORT_DAYS) -> DataFrame:
    """Rates of the last 30 days, counted back from the latest day of the base panel."""
    columns = ("FIPS", "Date", "CasesPer100k")
    return trailing_days(_with_month(progress, *columns), "Date", days, of=base, month=MONTH).select(*columns)


def recent_rate_export(base: DataFrame, dim: DataFrame, days: int = EXPORT_DAYS) -> DataFrame:
    """`county_rate_export` of a progress panel that is made only for the days it shows.

    The frames look back ``REACH`` days, so they run over that many more, not over the whole history.
    """
    near = trailing_days(base, "Date", days + REACH, month=MONTH).drop(MONTH)
    columns = ("FIPS", "Date", "CasesPer100k")
    return trailing_days(county_progress(near, dim).select(*columns), "Date", days, of=near)
