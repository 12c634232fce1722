"""Build every table and export from delivered files, in one Spark application."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .. import __version__
from ..operators.panel import entities_with_data, require_unique
from ..operators.report import latest_day
from ..session import scratch
from ..sinks import pointer, publish, read_table, write_json, write_tsv
from ..sinks.versions import Pointer, read_parts
from ..sources import fingerprint
from ..sources.calendar import CALENDAR_FIRST
from ..sources.daily_files import FIRST_DAY
from ..sources.seeds import state_abbreviations
from . import cases, counties, deaths, states
from .counties import MONTH, months_between
from .deliveries import DAILY, Delivery, receive, reject_counts

KEYS = {
    "county_daily": ["FIPS", "Date"],
    "county_population": ["FIPS"],
    "county_dim": ["FIPS"],
    "state_dim": ["State"],
    "state_tests": ["state", "Date"],
    "state_facts": ["state", "Date"],
    "weekly_deaths": ["State", "Year", "Week_Of_Year"],
}

# The delivered sources each table rests on, directly or through other tables.
_COUNTY = {"county_daily"}
_PLACES = {"county_population", "state_population", "county_survey"}
_STATE_DIM = {"state_population", "state_abbreviations"}
_STATE = {"state_daily", "tests", *_STATE_DIM}
_WEEKLY = {"weekly_deaths_new", "weekly_deaths_old"}
NEEDS = {
    "county_clean": _COUNTY,
    "county_totals": _COUNTY,
    "county_daily": _COUNTY,
    "county_population": {"county_population", "state_population"},
    "county_dim": _COUNTY | _PLACES,
    "county_base": _COUNTY,
    "county_progress": _COUNTY | _PLACES,
    "state_dim": _STATE_DIM,
    "state_tests": {"tests"},
    "state_facts": _STATE,
    "nation_facts": _STATE,
    "weekly_deaths": _WEEKLY,
    "state_deaths": _STATE | _WEEKLY,
    "case_level": {"cases"},
    "cases_by_week": {"cases"},
}


def _keep(spark: SparkSession, out: str, name: str, mark: str, write: Callable[[], None]) -> None:
    """Run ``write`` unless the export is noted as made from ``mark``.

    The note is withdrawn before and set after the export is written, so a build that dies in between makes the
    export again next time.
    """
    path = f"{out}/made_from/{name}"
    try:
        noted = spark.read.text(path).first()
    except AnalysisException:
        noted = None
    if noted is not None and noted["value"] == mark:
        return

    def note(text: str) -> None:
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    note("unfinished")
    write()
    note(mark)


def _differing(now: Mapping[str, str], then: Mapping[str, str]) -> list[dt.date]:
    """Months whose marks differ, in order."""
    return [dt.date.fromisoformat(m) for m in sorted(m for m in now.keys() | then.keys() if now.get(m) != then.get(m))]


#: Rows of some months, and the months that they are all rows of.
Part = tuple[DataFrame, list[str]]


class Tables:
    """The stored tables of one build below ``out/tables``; see `build`."""

    def __init__(self, spark: SparkSession, out: str, sources: Mapping[str, Delivery], span: str):
        self.spark, self.out, self.sources, self.span = spark, out, sources, span
        self.made: dict[str, DataFrame] = {}

    def rows(self, name: str) -> DataFrame:
        return self.sources[name].rows.drop(MONTH)

    def __getitem__(self, name: str) -> DataFrame:
        return self.made[name].drop(MONTH)

    def can_make(self, name: str) -> bool:
        return NEEDS[name] <= set(self.sources)

    def mark_of(self, names: Iterable[str]) -> str:
        return "; ".join(f"{n}: {self.sources[n].mark}" for n in sorted({n for t in names for n in NEEDS[t]})) + f"; {self.span}"

    def _check(self, name: str) -> Callable[[DataFrame], object] | None:
        return (lambda df: require_unique(df, KEYS[name], name)) if name in KEYS else None

    def _use(self, name: str, at: Pointer) -> None:
        self.made[name] = read_parts(self.spark, f"{self.out}/tables/{name}", at)

    def store(self, name: str, make: Callable[[], DataFrame], date: str | None = None) -> None:
        """A table made as a whole, unless it is there from the same sources; with ``date`` it is kept by month."""
        if not self.can_make(name):
            return
        path, mark = f"{self.out}/tables/{name}", self.mark_of([name])
        at = pointer(self.spark, path)
        if at is None or at.mark != mark:
            df = make()
            df = df.withColumn(MONTH, F.trunc(date, "month")) if date else df
            at = publish(df, path, MONTH if date else None, mark=mark, check=self._check(name))
        self._use(name, at)

    def store_months(
        self, name: str, mark: str, make: Callable[[], DataFrame], some: Callable[[dt.date, dt.date], Part], date: str | None = "Date"
    ) -> None:
        """A table by month that rests on the daily files: of the months these differ in from what it was made from, only
        what they reach is made, by ``some`` from the first and the last of them. Another ``mark`` makes all of it.
        """
        if not self.can_make(name):
            return
        path, marks = f"{self.out}/tables/{name}", self.sources[DAILY].months
        at = pointer(self.spark, path)
        dirty = _differing(marks, at.basis) if at else []

        def stored(df: DataFrame, replaces: list[str] | None) -> Pointer:
            df = df.withColumn(MONTH, F.trunc(date, "month")) if date else df
            return publish(df, path, MONTH, replaces, mark, marks, self._check(name))

        if at is None or at.mark != mark:
            at = stored(make(), None)
        elif dirty:
            at = stored(*some(dirty[0], dirty[-1]))
        self._use(name, at)


def _county_tables(t: Tables) -> None:
    """Tables that rest on the daily files, brought up to date by month."""
    if DAILY not in t.sources:
        return
    made_by = f"version {__version__}; {t.span}"

    def within(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
        return df.filter(F.col(MONTH).between(F.lit(first), F.lit(last)))

    def clean(first: dt.date, last: dt.date) -> Part:
        return counties.clean_daily(within(t.sources[DAILY].rows, first, last)), months_between(first, last)

    def totals(first: dt.date, last: dt.date) -> Part:
        return counties.monthly_totals(within(t.made["county_clean"], first, last)), months_between(first, last)

    t.store_months("county_clean", made_by, lambda: counties.clean_daily(t.sources[DAILY].rows), clean, None)
    t.store_months("county_totals", made_by, lambda: counties.monthly_totals(t.made["county_clean"]), totals, None)
    entities = entities_with_data(t.made["county_totals"], "FIPS", counties.TOTALS)
    # A code that comes to have data, or has none any more, concerns all its days.
    made_by += "; codes {} {}".format(*fingerprint(entities).first())

    def daily(first: dt.date, last: dt.date) -> Part:
        return counties.filtered_daily(within(t.made["county_clean"], first, last), entities), months_between(first, last)

    def base(first: dt.date, last: dt.date) -> Part:
        rows, upto = counties.base_of_months(t.made["county_daily"], first, last)
        return rows, months_between(first, upto)

    t.store_months("county_daily", made_by, lambda: counties.filtered_daily(t.made["county_clean"], entities), daily)
    t.store_months("county_base", made_by, lambda: counties.county_base(t["county_daily"]), base)
    t.store("county_population", lambda: counties.county_population(t.rows("county_population"), t.rows("state_population")))
    t.store("county_dim", lambda: counties.county_dim(t["county_daily"], t["county_population"], t.rows("county_survey")))
    if "county_dim" not in t.made:
        return
    made_by += "; people {} {}".format(*fingerprint(t["county_dim"].select("FIPS", "Population")).first())

    def progress(first: dt.date, last: dt.date) -> Part:
        _, reached = counties.base_of_months(t.made["county_daily"], first, last)
        rows, upto = counties.progress_of_months(t.made["county_base"], t["county_dim"], first, reached)
        return rows, months_between(first, upto)

    t.store_months("county_progress", made_by, lambda: counties.county_progress(t["county_base"], t["county_dim"]), progress)


def build(
    spark: SparkSession, paths: Mapping[str, str], out: str, since: str = FIRST_DAY, first: str | None = CALENDAR_FIRST, end: str | None = None
) -> dict[str, DataFrame]:
    """Bring all tables below ``out/tables`` and all exports below ``out/exports`` up to date; returns the stored tables.

    Tables are made for the sources that are given; those that rest on others are left out. Of the sources only files that
    are new or changed are read; only tables and exports whose sources have other content are made again, and of the
    county tables only the months that changes reach. Every table is written beside the one in use, checked if it has a
    key, and then taken into use by its pointer (`read_table` follows it), so a build that fails or dies at any point
    leaves all tables readable as they were. ``since`` is the first day of the daily files, ``first`` and ``end`` bound
    the days with state rates and means; no end by default.
    """
    with scratch(spark):
        return _build(spark, paths, out, since, first, end)


def _build(
    spark: SparkSession, paths: Mapping[str, str], out: str, since: str, first: str | None, end: str | None
) -> dict[str, DataFrame]:
    # Deliveries do not depend on each other, so their jobs run side by side.
    with ThreadPoolExecutor(max(len(paths), 1)) as pool:
        received = pool.map(lambda name: receive(spark, name, paths[name], out, since), paths)
        sources = dict(zip(paths, received, strict=True))
    if sources:
        publish(reject_counts(spark, list(sources), out).coalesce(1), f"{out}/tables/reject_counts")
    if "state_abbreviations" not in sources:
        sources["state_abbreviations"] = Delivery(state_abbreviations(spark), f"version {__version__}")
    t = Tables(spark, out, sources, f"{since}, {first}, {end}")
    _county_tables(t)
    t.store("county_population", lambda: counties.county_population(t.rows("county_population"), t.rows("state_population")))
    t.store("state_dim", lambda: states.state_dim(t.rows("state_population"), t.rows("state_abbreviations")))
    t.store("state_tests", lambda: states.positivity(states.clean_tests(t.rows("tests")), first=first, end=end), "Date")
    t.store(
        "state_facts",
        lambda: states.state_facts(states.clean_state_daily(t.rows("state_daily")), t["state_dim"], t["state_tests"], first, end),
        "Date",
    )
    t.store("nation_facts", lambda: states.nation_facts(t["state_facts"], t["state_dim"]))
    t.store("weekly_deaths", lambda: deaths.clean_weekly_deaths(t.rows("weekly_deaths_new"), t.rows("weekly_deaths_old")))
    t.store("state_deaths", lambda: deaths.state_deaths(t["weekly_deaths"], t["state_facts"], t.rows("state_abbreviations")))
    t.store("case_level", lambda: cases.case_level(t.rows("cases")))
    t.store("cases_by_week", lambda: cases.weekly_report(t["case_level"]))
    tables = t.made

    def snapshot() -> DataFrame:
        return counties.county_snapshot(latest_day(t["county_progress"], "Date"), t["county_dim"], t["state_dim"])

    exports = {
        "counties_rate_of_change": (("county_progress", "county_dim", "state_dim"), write_json, snapshot, ["FIPS", "Date"]),
        "counties_7day_avg": (("county_base",), write_tsv, lambda: counties.county_averages_export(tables["county_base"]), ["Date", "FIPS"]),
        "counties_casesper100k": (
            ("county_progress", "county_base"),
            write_tsv,
            lambda: counties.county_rate_export(tables["county_progress"], tables["county_base"]),
            ["FIPS", "Date"],
        ),
        "states_7day_avg": (("state_facts",), write_tsv, lambda: states.state_averages_export(tables["state_facts"]), ["State", "Date"]),
        "state_population": (("state_dim",), write_json, lambda: t["state_dim"], ["State"]),
        "cases_by_week": (("cases_by_week",), write_tsv, lambda: t["cases_by_week"], ["week_ending_date", "race_ethnicity_combined"]),
    }

    def export(name: str) -> None:
        needs, write, make, order = exports[name]
        _keep(spark, out, f"exports/{name}", t.mark_of(needs), lambda: write(make(), f"{out}/exports/{name}", order))

    # Exports do not depend on each other, so their jobs run side by side.
    with ThreadPoolExecutor(len(exports)) as pool:
        list(pool.map(export, [n for n, (needs, *_) in exports.items() if set(needs) <= set(tables)]))
    return {name: df.drop(MONTH) for name, df in tables.items()}
