"""What each delivered source looks like: separator, encoding and the columns the library needs."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Contract:
    name: str
    tag: str
    columns: tuple[str, ...]
    sep: str = ","
    encoding: str = "UTF-8"
    key: tuple[str, ...] = ()


# Column names as the publishers deliver them.
COUNTY_DAILY_FIELDS = (
    "FIPS",
    "Admin2",
    "Province_State",
    "Country_Region",
    "Last_Update",
    "Lat",
    "Long_",
    "Confirmed",
    "Deaths",
    "Recovered",
    "Active",
    "Combined_Key",
)

_DEATHS_KEY = ("Jurisdiction_of_Occurrence", "MMWR_Year", "MMWR_Week")

CONTRACTS = {
    c.name: c
    for c in (
        Contract("county_daily", "county_daily", COUNTY_DAILY_FIELDS, key=("Date", "FIPS")),
        Contract(
            "state_daily",
            "state_daily",
            ("submission_date", "state", "tot_cases", "new_case", "tot_death", "new_death"),
            sep="\t",
            key=("submission_date", "state"),
        ),
        Contract(
            "state_daily_old",
            "state_daily_old",
            (
                "Date",
                "state",
                "positive",
                "positiveIncrease",
                "death",
                "deathIncrease",
                "hospitalized",
                "hospitalizedIncrease",
                "totalTestResultsIncrease",
            ),
            key=("Date", "state"),
        ),
        Contract(
            "tests",
            "tests",
            ("state", "date", "overall_outcome", "new_results_reported"),
            sep="\t",
        ),
        Contract(
            "weekly_deaths_new",
            "weekly_deaths",
            (*_DEATHS_KEY, "Week_Ending_Date", "All_Cause"),
            sep="\t",
            key=_DEATHS_KEY,
        ),
        Contract(
            "weekly_deaths_old",
            "weekly_deaths",
            (*_DEATHS_KEY, "Week_Ending_Date", "All__Cause"),
            sep="\t",
            key=_DEATHS_KEY,
        ),
        Contract(
            "cases",
            "cases",
            (
                "cdc_case_earliest_dt",
                "cdc_report_dt",
                "pos_spec_dt",
                "onset_dt",
                "current_status",
                "sex",
                "age_group",
                "race_ethnicity_combined",
                "hosp_yn",
                "icu_yn",
                "death_yn",
                "medcond_yn",
            ),
            sep="\t",
        ),
        Contract(
            "county_population",
            "reference_data",
            ("STNAME", "CTYNAME", "STATE", "COUNTY", "POPESTIMATE2019"),
            encoding="ISO-8859-1",
            key=("STATE", "COUNTY"),
        ),
        Contract(
            "state_population",
            "reference_data",
            ("NAME", "STATE", "POPESTIMATE2019"),
            encoding="ISO-8859-1",
            key=("NAME",),
        ),
        Contract(
            "county_survey",
            "reference_data",
            ("state", "county", "CP03_2014_2018_062E", "CP05_2014_2018_018E"),
            encoding="ISO-8859-1",
            key=("state", "county"),
        ),
        Contract("calendar", "reference_data", ("Date", "Minus1Day", "Minus7Days", "Minus14Days", "Minus30Days"), key=("Date",)),
        Contract("state_abbreviations", "reference_data", ("state", "abbreviation"), key=("state",)),
        Contract("gazetteer", "gazetteer", (), sep="\t", encoding="ISO-8859-1"),
    )
}


def source(name: str) -> Contract:
    return CONTRACTS[name]
