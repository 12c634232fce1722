"""State and nation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clamp_zero, guarded_ratio, numeric_text, parse_date, rate_per
from ..operators.panel import earlier, rolling_calendar, rolling_rows, series_windows
from ..operators.report import first_last_change, first_last_pct, trailing_days
from ..operators.rollup import pivot_rate, with_total
from ..sources.calendar import CALENDAR_FIRST, in_calendar

# Test outcomes as published, and the column each is counted in.
TEST_OUTCOMES = {"Negative": "negative", "Positive": "positive", "Inconclusive": "inconclusive"}
NATION_LABEL = "US"
LEFT_OUT_OF_NATION = ("AS",)


def state_dim(population: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """States with abbreviation and population; rows coded 0 are sums of states."""
    short = abbreviations.select(F.col("state").alias("NAME"), F.col("abbreviation").alias("StateAbbrev"))
    return (
        population.filter(numeric_text(F.col("STATE")) > 0)
        .join(short, "NAME", "left")
        .select(
            F.col("NAME").alias("State"), "StateAbbrev", numeric_text(F.col("POPESTIMATE2019")).alias("Population")
        )
    )


def clean_state_daily(raw: DataFrame) -> DataFrame:
    """State counts typed, negative new cases set to zero; hospital and test counts are not delivered."""
    unknown = F.lit(None).cast("long")
    return raw.select(
        parse_date(F.col("submission_date"), "MM/dd/yyyy").alias("Date"),
        "state",
        numeric_text(F.col("tot_cases")).alias("positive"),
        clamp_zero(numeric_text(F.col("new_case"))).alias("positiveIncrease"),
        numeric_text(F.col("tot_death")).alias("death"),
        numeric_text(F.col("new_death")).alias("deathIncrease"),
        unknown.alias("hospitalized"),
        unknown.alias("hospitalizedIncrease"),
        unknown.alias("totalTestResultsIncrease"),
    )


def clean_state_daily_old(raw: DataFrame) -> DataFrame:
    """The earlier publisher's state counts in the same columns, plus its own positivity."""
    whole = {
        c: numeric_text(F.col(c))
        for c in ("positive", "death", "deathIncrease", "hospitalized", "hospitalizedIncrease", "totalTestResultsIncrease")
    }
    gained = numeric_text(F.col("positiveIncrease"))
    return raw.select(
        parse_date(F.col("Date"), "yyyyMMdd").alias("Date"),
        "state",
        whole["positive"].alias("positive"),
        clamp_zero(gained).alias("positiveIncrease"),
        *[whole[c].alias(c) for c in list(whole)[1:]],
        guarded_ratio(gained, whole["totalTestResultsIncrease"]).alias("PositivityRate"),
    )


def clean_tests(raw: DataFrame) -> DataFrame:
    return raw.select(
        "state",
        parse_date(F.col("date"), ("yyyy/MM/dd", "yyyy-MM-dd")).alias("Date"),
        "overall_outcome",
        numeric_text(F.col("new_results_reported")).alias("new_results"),
    )


def positivity(
    tests: DataFrame, outcomes=TEST_OUTCOMES, first: str | None = CALENDAR_FIRST, end: str | None = None
) -> DataFrame:
    """Test outcomes side by side per state and day, the positive share, and its 7-day calendar mean."""
    wide = pivot_rate(
        tests, ["state", "Date"], "overall_outcome", "new_results", outcomes, "positive", "totalTests", "positivityRate"
    )
    rolled = rolling_calendar(wide, "state", "Date", {"positivityRate": "Avg7DayPositivityRate"})
    return _only_in_calendar(rolled, ["Avg7DayPositivityRate"], first, end)


def _only_in_calendar(df: DataFrame, columns: list[str], first: str | None, end: str | None) -> DataFrame:
    """Blank columns on days the calendar does not hold; without ``end`` it goes on as long as the data."""
    known = in_calendar(F.col("Date"), first, end)
    return df.withColumns({c: F.when(known, F.col(c)) for c in columns})


def state_facts(
    states: DataFrame, dim: DataFrame, tests: DataFrame, first: str | None = CALENDAR_FIRST, end: str | None = None
) -> DataFrame:
    """Counts, two-week rate, 7-day calendar means and positivity per state and day, 14 columns.

    ``tests`` is the result of `positivity`. Rates and means need the day in the calendar, rates also the state
    in the dimension.
    """
    people = dim.filter(F.col("StateAbbrev").isNotNull()).select(F.col("StateAbbrev").alias("state"), "Population")
    rolled = rolling_calendar(
        states.join(people, "state", "left"),
        "state",
        "Date",
        {"positiveIncrease": "Avg7DayPositiveIncrease", "deathIncrease": "Avg7DayDeathIncrease"},
    )
    grown = F.col("positive") - earlier("positive", "state", "Date", 14)
    rated = rolled.withColumn("CasesPer100k", rate_per(grown, F.col("Population")))
    known = _only_in_calendar(rated, ["CasesPer100k", "Avg7DayPositiveIncrease", "Avg7DayDeathIncrease"], first, end)
    shares = tests.select("state", "Date", "positivityRate", "Avg7DayPositivityRate")
    return known.join(shares, ["state", "Date"], "left").select(
        "Date",
        "state",
        "positive",
        "positiveIncrease",
        "death",
        "deathIncrease",
        "hospitalized",
        "hospitalizedIncrease",
        "totalTestResultsIncrease",
        "positivityRate",
        "CasesPer100k",
        "Avg7DayPositiveIncrease",
        "Avg7DayDeathIncrease",
        "Avg7DayPositivityRate",
    )


def nation_facts(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """National sums by day, 7-day calendar means and the two-week rate over the states with data."""
    reporting = facts.select(F.col("state").alias("StateAbbrev")).distinct()
    people = dim.join(reporting, "StateAbbrev", "left_semi").agg(F.sum("Population")).scalar()
    daily = facts.groupBy(F.col("Date").alias("date")).agg(
        *[F.sum(c).alias(c) for c in ("positive", "positiveIncrease", "totalTestResultsIncrease")]
    )
    rolled = series_windows(
        daily,
        "date",
        {"positiveIncrease": "_cases7", "totalTestResultsIncrease": "_tests7"},
        {"positive": "_positive14"},
    )
    return rolled.select(
        "date",
        "positive",
        "positiveIncrease",
        "totalTestResultsIncrease",
        (F.col("_cases7") / F.lit(7.0)).alias("Avg7DayPositiveIncrease"),
        (F.col("_tests7") / F.lit(7.0)).alias("Avg7DayTotalTestResultsIncrease"),
        rate_per(F.col("positive") - F.col("_positive14"), people).alias("CasesPer100k"),
    )


def state_averages_export(facts: DataFrame, days: int = 28) -> DataFrame:
    """Counts and means of the last four weeks under the names the report pages read."""
    return trailing_days(facts, "Date", days, month="month").select(
        F.col("state").alias("State"),
        "Date",
        "positive",
        "positiveIncrease",
        "death",
        "deathIncrease",
        "positivityRate",
        F.col("Avg7DayPositiveIncrease").alias("Avg7DayConfirmedIncrease"),
        F.col("Avg7DayDeathIncrease").alias("Avg7DayDeathsIncrease"),
        "Avg7DayPositivityRate",
    )


def state_progress(
    recent: DataFrame, label: str = NATION_LABEL, leave_out: tuple[str, ...] = LEFT_OUT_OF_NATION, points: int = 14, days: int = 28
) -> DataFrame:
    """One row per state and one for the nation: latest counts, short series and their first-to-last changes.

    ``recent`` is the result of `state_averages_export`, or the whole history under the same names: only its last
    ``days`` days are looked at, so a state's rows fit an array. The nation has no means of its own; it takes the mean of its last 7 rows, and one point more.
    """
    recent = trailing_days(recent, "Date", days)
    rows = with_total(
        recent, "State", "Date", ["positive", "positiveIncrease", "death", "deathIncrease"], label, "positiveIncrease", leave_out
    )
    means = rolling_rows(rows, "State", "Date", {"positiveIncrease": "_cases", "deathIncrease": "_deaths"})
    nation = F.col("State") == label
    shown = means.select(
        "State",
        "Date",
        "positive",
        "positiveIncrease",
        "death",
        "deathIncrease",
        "positivityRate",
        "Avg7DayPositivityRate",
        F.when(nation, F.col("_cases")).otherwise(F.col("Avg7DayConfirmedIncrease")).alias("cases"),
        F.when(nation, F.col("_deaths")).otherwise(F.col("Avg7DayDeathsIncrease")).alias("deaths"),
    )
    series = shown.groupBy("State").agg(
        F.array_sort(F.collect_list(F.struct("Date", *[c for c in shown.columns if c not in ("State", "Date")]))).alias("s")
    )
    keep = F.when(nation, points + 1).otherwise(points)

    def last(rows, n):
        return F.slice(rows, F.greatest(F.size(rows) - n + 1, F.lit(1)), n)

    tested = F.filter("s", lambda r: r["positivityRate"].isNotNull() & (r["positivityRate"] != 0))
    # The very first row is never looked at for the latest rate.
    later_tested = F.filter(
        F.slice(F.col("s"), 2, F.greatest(F.size("s") - 1, F.lit(0))),
        lambda r: r["positivityRate"].isNotNull() & (r["positivityRate"] != 0),
    )
    now = F.element_at("s", -1)
    wide = series.select(
        "State",
        now.alias("now"),
        F.try_element_at(later_tested, F.lit(-1))["positivityRate"].alias("positivityRate"),
        F.transform(last(F.col("s"), keep), lambda r: r["cases"]).alias("positiveSeries"),
        F.transform(last(tested, F.lit(points)), lambda r: r["Avg7DayPositivityRate"]).alias("positivitySeries"),
        F.transform(last(F.col("s"), keep), lambda r: r["deaths"]).alias("deathSeries"),
    )
    return wide.select(
        "State",
        F.col("now.positive").alias("positive"),
        F.col("now.positiveIncrease").alias("positiveIncrease"),
        guarded_ratio(F.col("now.positiveIncrease"), F.col("now.positive") - F.col("now.positiveIncrease")).alias("positiveIncreasePct"),
        "positiveSeries",
        first_last_pct(F.col("positiveSeries")).alias("positiveChangePct"),
        "positivityRate",
        "positivitySeries",
        first_last_change(F.col("positivitySeries")).alias("positivityChange"),
        F.col("now.death").alias("death"),
        F.col("now.deathIncrease").alias("deathIncrease"),
        guarded_ratio(F.col("now.deathIncrease"), F.col("now.death") - F.col("now.deathIncrease")).alias("deathIncreasePct"),
        "deathSeries",
        first_last_pct(F.col("deathSeries")).alias("deathChangePct"),
    )
