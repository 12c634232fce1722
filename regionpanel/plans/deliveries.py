"""Delivered files as stored text tables: only files that are new or changed are read, each record once.

``out/manifest`` holds a row per file: what the listing says of it, how many of its records were good, and a hash of them.
``out/raw`` holds all records with the file they come from; daily files by month, so that a new file rewrites its month
and nothing else. Records that cannot be used stay there with the reason and are shown in ``out/rejects``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import __version__
from ..functions import is_placeable, numeric_text, parse_date, repair_code
from ..sinks import pointer, publish, read_table
from ..sources import dated_files, differences, ingest_json_rows, list_files, read_by_name, read_daily_files, row_hash, source
from ..sources.daily_files import FIRST_DAY, file_day
from ..sources.delimited import MALFORMED, reject_reason
from .counties import MONTH

DAILY = "county_daily"
SURVEY = "county_survey"
#: Columns of a raw table beside the delivered ones: the file of a record, and why it cannot be used.
FILE, REASON = "_file", "_reason"
COUNTS = ("delivered", "good", "rejected", "unread_numbers", "unread_dates")
MANIFEST = "path string, size long, modified long, part string, delivered long, good long, rejected long, unread_numbers long, unread_dates long, hash decimal(38,0)"


def _day(column: str, *formats: str) -> Column:
    return parse_date(F.col(column), formats)


def _number(column: str) -> Column:
    return numeric_text(F.col(column))


def key_parsers(name: str) -> Mapping[str, Column | None]:
    """Columns that a record cannot do without, with what reads them (None: any text)."""
    if name == DAILY:
        # Rows of no place have no code; what stands in the others must be one.
        placeable = is_placeable(F.col("Country_Region"), F.col("Admin2"), F.col("Province_State"))
        code = repair_code(F.col("FIPS"), placeable)
        return {"FIPS": F.when((placeable == 1) & F.col("FIPS").isNotNull(), code).otherwise("")}
    week = {"Jurisdiction_of_Occurrence": None, "MMWR_Year": _number("MMWR_Year"), "MMWR_Week": _number("MMWR_Week")}
    return {
        "state_daily": {"submission_date": _day("submission_date", "MM/dd/yyyy"), "state": None},
        "tests": {"state": None, "date": _day("date", "yyyy/MM/dd", "yyyy-MM-dd")},
        "weekly_deaths_new": week,
        "weekly_deaths_old": week,
        "county_population": {"STATE": None, "COUNTY": None},
        "state_population": {"NAME": None},
    }.get(name, {})


#: Columns that must be numbers or dates where they are not blank, to count what a delivery loses.
NUMBERS = {
    "county_daily": ("Confirmed", "Deaths"),
    "state_daily": ("tot_cases", "new_case", "tot_death", "new_death"),
    "tests": ("new_results_reported",),
    "weekly_deaths_new": ("All_Cause",),
    "weekly_deaths_old": ("All__Cause",),
    "county_population": ("POPESTIMATE2019",),
    "state_population": ("POPESTIMATE2019",),
}
DATES = {
    "weekly_deaths_new": {"Week_Ending_Date": "yyyy-MM-dd"},
    "weekly_deaths_old": {"Week_Ending_Date": "M/d/yyyy"},
    "cases": dict.fromkeys(("cdc_case_earliest_dt", "cdc_report_dt", "pos_spec_dt", "onset_dt"), "yyyy/MM/dd"),
}


@dataclass(frozen=True)
class Delivery:
    """A source as stored: its good rows, a mark of their content, and marks by month for daily files."""

    rows: DataFrame
    mark: str
    months: Mapping[str, str] = field(default_factory=dict)


def receive(spark: SparkSession, name: str, path: str | Sequence[str], out: str, since: str = FIRST_DAY) -> Delivery:
    """Bring the stored table of a source up to date with the files at ``path``.

    The manifest is written last. A run that dies before it reads the same files again and puts their records in place
    of those it left.
    """
    raw, manifest = f"{out}/raw/{name}", f"{out}/manifest/{name}"
    mark = f"version {__version__}" + (f", since {since}" if name == DAILY else "")
    listed = dated_files(spark, path, since).drop("day") if name == DAILY else list_files(spark, path)
    at = pointer(spark, manifest)
    known = at is not None and at.mark == mark and pointer(spark, raw) is not None
    then = read_table(spark, manifest) if known else spark.createDataFrame([], MANIFEST)
    # One row per file that differs; these files are named in the scan, whose listing Spark keeps on the driver too.
    change = {r["path"]: r["change"] for r in differences(listed, then).collect()}
    if change or not known:
        _replace(spark, name, raw, manifest, listed, then, change, known, mark, out)
    return _stored(spark, name, raw, manifest)


def _part(name: str, path: Column) -> Column:
    """The month of a daily file, nothing for others."""
    return F.date_format(F.trunc(F.to_date(file_day(path), "yyyyMMdd"), "month"), "yyyy-MM-dd") if name == DAILY else F.lit("")


def _parse(spark: SparkSession, name: str, files: list[str]) -> DataFrame:
    paths = [unquote(f) for f in files]
    if name == SURVEY:
        contract = source(name)
        rows = ingest_json_rows(spark, paths, contract.columns, contract.encoding, FILE).withColumn(MALFORMED, F.lit(None).cast("string"))
    elif name == DAILY:
        rows = read_daily_files(spark, paths, path_column=FILE, since="")
    else:
        rows = read_by_name(spark, paths, source(name), path_column=FILE)
    return rows.withColumn(REASON, reject_reason(key_parsers(name)))


def _replace(
    spark: SparkSession, name: str, raw: str, manifest: str, listed: DataFrame, then: DataFrame, change: Mapping[str, str], known: bool, mark: str, out: str
) -> None:
    """Put the records of changed files in place of their earlier ones, then their counts into the manifest."""
    touched = spark.createDataFrame([(f,) for f in change], f"{FILE} string")
    arrived = sorted(f for f, kind in change.items() if kind != "gone")
    months = sorted({r["m"] for r in touched.select(_part(name, F.col(FILE)).alias("m")).collect()}) if name == DAILY else None
    new = _parse(spark, name, arrived) if arrived else None
    if new is not None and name == DAILY:
        new = new.withColumn(MONTH, _part(name, F.col(FILE)).cast("date"))
    if known:
        old = read_table(spark, raw)
        old = old.filter(F.col(MONTH).isin(*[F.lit(m).cast("date") for m in months])) if months else old
        old = old.join(touched, FILE, "left_anti")
        new = old if new is None else new.unionByName(old, allowMissingColumns=True)
    if new is None:
        raise ValueError(f"{name}: no file")
    by = MONTH if name == DAILY else None
    publish(new, raw, by, months if known else None)
    stored = read_table(spark, raw)
    if months:
        stored = stored.filter(F.col(MONTH).isin(*[F.lit(m).cast("date") for m in months]))
    bad = stored.filter(F.col(REASON).isNotNull())
    own = [c for c in stored.columns if c not in (FILE, REASON, MALFORMED, MONTH)]
    record = F.coalesce(MALFORMED, F.to_json(F.struct(*[f"`{c}`" for c in own])))
    shown = bad.select(F.lit(name).alias("source"), F.col(REASON).alias("reason"), F.col(FILE).alias("file"), record.alias("record"), *([MONTH] if by else []))
    publish(shown, f"{out}/rejects/{name}", by, months if known else None)
    good = F.col(REASON).isNull()

    def unread(typed: Mapping[str, Column]) -> Column:
        counts = [F.count_if(good & F.col(c).isNotNull() & value.isNull()) for c, value in typed.items()]
        return sum(counts[1:], counts[0]) if counts else F.lit(0).cast("long")

    counts = stored.join(touched, FILE, "left_semi").groupBy(FILE).agg(
        F.count(F.lit(1)).alias("delivered"),
        F.count_if(good).alias("good"),
        F.count_if(~good).alias("rejected"),
        unread({c: _number(c) for c in NUMBERS.get(name, ())}).alias("unread_numbers"),
        unread({c: _day(c, f) for c, f in DATES.get(name, {}).items()}).alias("unread_dates"),
        F.coalesce(F.sum(F.when(good, row_hash(own))), F.lit(0)).cast("decimal(38,0)").alias("hash"),
    )
    here = listed.join(touched, F.col("path") == F.col(FILE), "left_semi").join(counts, F.col("path") == F.col(FILE), "left")
    rows = here.select(
        "path", "size", "modified", _part(name, F.col("path")).alias("part"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS], F.coalesce("hash", F.lit(0)).cast("decimal(38,0)").alias("hash"),
    )
    stay = then.join(touched, F.col("path") == F.col(FILE), "left_anti")
    publish(stay.unionByName(rows).coalesce(1 if name != DAILY else 8), manifest, mark=mark)


def _stored(spark: SparkSession, name: str, raw: str, manifest: str) -> Delivery:
    files = read_table(spark, manifest)
    total = files.groupBy("part").agg(F.sum("good").alias("n"), F.sum("hash").alias("h"), F.sum("delivered").alias("d"))
    # One row per month.
    parts = {r["part"]: r for r in total.collect()}
    if parts and sum(r["d"] for r in parts.values()) and not sum(r["n"] for r in parts.values()):
        raise ValueError(f"{name}: none of the delivered records can be used")
    rows = read_table(spark, raw)
    hidden = [c for c in (FILE, REASON, MALFORMED) if c in rows.columns]
    rows = rows.filter(F.col(REASON).isNull()).drop(*hidden)
    n, h = (sum(r[c] for r in parts.values()) for c in ("n", "h"))
    months = {p: f"{r['n']} rows, {r['h']}" for p, r in parts.items()} if name == DAILY else {}
    return Delivery(rows, f"{n} rows, {h}, version {__version__}", months)


def reject_counts(spark: SparkSession, names: Sequence[str], out: str) -> DataFrame:
    """A row per source: delivered = good + rejected, and the values of good records that could not be read."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in COUNTS]
    whole = None
    for name in names:
        one = read_table(spark, f"{out}/manifest/{name}").agg(*sums).select(F.lit(name).alias("source"), *COUNTS)
        whole = one if whole is None else whole.unionByName(one)
    return whole
