"""Case-level rows and the weekly report over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse_date, week_ending, week_number, yes_flag
from ..operators.rollup import share_of_total

CASE_DAYS = ("cdc_case_earliest_dt", "cdc_report_dt", "pos_spec_dt", "onset_dt")
CASE_ATTRIBUTES = ("current_status", "sex", "age_group", "race_ethnicity_combined")
CASE_ANSWERS = ("hosp", "icu", "death", "medcond")


def case_level(raw: DataFrame) -> DataFrame:
    """Typed case rows with week parts of the earliest date and 0/1 flags."""
    first = F.col("cdc_case_earliest_dt")
    typed = raw.withColumns({c: parse_date(F.col(c), "yyyy/MM/dd") for c in CASE_DAYS})
    return typed.select(
        first,
        F.year(first).alias("year"),
        week_number(first).alias("week_of_year"),
        week_ending(first).alias("week_ending_date"),
        *CASE_DAYS[1:],
        *CASE_ATTRIBUTES,
        *[f"{a}_yn" for a in CASE_ANSWERS],
        *[yes_flag(F.col(f"{a}_yn")).alias(f"{a}_flag") for a in CASE_ANSWERS],
    )


def weekly_report(cases: DataFrame) -> DataFrame:
    """Cases, deaths and intensive care per week and group, with shares of the week's cases and deaths."""
    return share_of_total(
        cases, "week_ending_date", "race_ethnicity_combined", {"death_flag": "death", "icu_flag": "icu"}, ["cases", "death"]
    )
