"""Union of daily report files whose column order changes over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .contracts import COUNTY_DAILY_FIELDS
from .delimited import MALFORMED, PATH, clean_names, first_lines, good_rows, header_cells, layouts, read_layout, require
from .manifest import list_files

# Reports are named by day, and older ones have another layout.
DAY_IN_NAME = r"(\d{2})-(\d{2})-(\d{4})\.csv"
FIRST_DAY = "20200322"


def file_day(path: Column, part: int = -1) -> Column:
    """``yyyyMMdd`` out of one part of a path, its last by default; empty when that names no day."""
    name = F.element_at(F.split(path, "/"), part)
    return F.concat(*[F.regexp_extract(name, DAY_IN_NAME, i) for i in (3, 1, 2)])


def dated_files(spark: SparkSession, paths: str | Sequence[str], since: str = FIRST_DAY, part: int = -1) -> DataFrame:
    """`list_files` with the ``day`` in each file's name, from ``since`` on; a file whose name holds no day raises."""
    listed = list_files(spark, paths if isinstance(paths, str) else list(paths)).withColumn("day", file_day(F.col("path"), part))
    undated = listed.filter("day = ''").first()
    if undated is not None:
        raise ValueError(f"{undated['path']}: the name holds no day")
    return listed.filter(F.col("day") >= since)


def read_daily_files(
    spark: SparkSession, paths: str | Sequence[str], fields: Sequence[str] = COUNTY_DAILY_FIELDS, since: str = FIRST_DAY, part: int = -1, path_column: str | None = None
) -> DataFrame:
    """Date, ``fields`` and `MALFORMED` as text from all daily files from ``since`` on, columns picked by header name.

    Files with the same header are read together, so there are as many scans as layouts, not as files. A file whose
    name holds no day raises. ``part`` is the part of the path that names the day, counted from the end;
    ``path_column`` names a further column with the path.
    """
    day = file_day(F.col("_metadata.file_path"), part)
    dated_files(spark, paths, since, part)
    whole = None
    for layout in layouts(first_lines(spark, paths, "UTF-8", day >= since), listed=True):
        cells = header_cells(layout.header, ",", layout.files[0])
        if len(set(fields) & {c.strip() for c in cells}) < min(2, len(fields)):
            raise ValueError(f"{layout.files[0]}: no header line")
        names = clean_names(cells, layout.files[0])
        require(names, fields, layout.files[0])
        rows = read_layout(spark, layout.files, names, ",", "UTF-8", layout.broken, PATH, layout.long)
        kept = [F.col(PATH).alias(path_column)] if path_column else []
        rows = rows.select(file_day(F.col(PATH), part).alias("Date"), *fields, *kept, MALFORMED)
        whole = rows if whole is None else whole.unionByName(rows)
    if whole is None:
        raise ValueError(f"{paths}: no daily file from {since} on")
    return whole


def ingest_daily_files(
    spark: SparkSession, path: str, fields: Sequence[str] = COUNTY_DAILY_FIELDS, since: str = FIRST_DAY, part: int = -1
) -> DataFrame:
    """The rows of `read_daily_files` that fit their header."""
    return good_rows(read_daily_files(spark, path, fields, since, part))
