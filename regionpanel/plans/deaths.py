"""Weekly deaths of all causes against their usual level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric_text, parse_date
from ..operators.rollup import bucket_sum, excess_over_baseline, union_eras

# Fixed values.
BASE_YEAR = 2019
ALL_STATES = "United States"


def clean_weekly_deaths(new: DataFrame, old: DataFrame) -> DataFrame:
    """Both eras in the same columns. Week ends are parsed as written in either era, whatever the year."""

    def era(df: DataFrame, count: str, day: Column) -> DataFrame:
        return df.select(
            F.col("Jurisdiction_of_Occurrence").alias("State"),
            numeric_text(F.col("MMWR_Year")).alias("Year"),
            numeric_text(F.col("MMWR_Week")).alias("Week_Of_Year"),
            day.alias("Week_Ending_Date"),
            numeric_text(F.col(count)).alias("All_Cause"),
        )

    end = F.col("Week_Ending_Date")
    return union_eras(
        era(new, "All_Cause", parse_date(end, "yyyy-MM-dd")), era(old, "All__Cause", parse_date(end, "M/d/yyyy"))
    )


def state_deaths(deaths: DataFrame, facts: DataFrame, abbreviations: DataFrame, base_year: int = BASE_YEAR) -> DataFrame:
    """Deaths of a week in the base year and the two after it, the usual level, the excess and the reported share."""
    names = {
        "baseline": "AvgDeaths",
        "value": "Deaths",
        "end": "Week_Ending_Date",
        "excess": "Excess",
        "pct": "ExcessPct",
    }
    rows = deaths.filter(F.col("State") != ALL_STATES).select(
        "State", "Year", "Week_Of_Year", "Week_Ending_Date", F.col("All_Cause")
    )
    wide = excess_over_baseline(
        rows, "State", "Year", "Week_Of_Year", "Week_Ending_Date", "All_Cause", base_year, names
    )
    y1, y2 = base_year + 1, base_year + 2
    reported = bucket_sum(
        facts, deaths, "state", "Date", "deathIncrease", "Week_Ending_Date", "Covid19DeathsForWeek"
    ).select(
        F.col("state").alias("_abbr"), F.col("Week_Ending_Date").alias(f"Week_Ending_Date{y1}"), "Covid19DeathsForWeek"
    )
    short = abbreviations.select(F.col("state").alias("State"), F.col("abbreviation").alias("_abbr"))
    return (
        wide.join(short, "State", "left")
        .join(reported, ["_abbr", f"Week_Ending_Date{y1}"], "left")
        .select(
            "State",
            "Week_Of_Year",
            F.col("AvgDeaths").alias(f"AvgDeaths_{base_year - 5}_{base_year}"),
            f"Week_Ending_Date{y1}",
            f"Week_Ending_Date{y2}",
            *[f"Deaths{y}" for y in (base_year, y1, y2)],
            f"Excess{y1}",
            f"ExcessPct{y1}",
            f"Excess{y2}",
            f"ExcessPct{y2}",
            "Covid19DeathsForWeek",
        )
    )
