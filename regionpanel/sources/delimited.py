"""Delimited files as all-text tables, columns bound by header name."""

from __future__ import annotations

import csv
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions import clean_name
from ..session import settle
from .contracts import Contract
from .fingerprint import same_content
from .quoted import read_quoted

#: Holds the text of a record whose cells do not fit its header.
MALFORMED = "_malformed"
#: Path of a record's file, while it is read.
PATH = "_path"
MARKS = "[\ufeff\\r]"


def require(columns: Sequence[str], needed: Sequence[str], where: str) -> None:
    present = {c.lower() for c in columns}
    missing = [c for c in needed if c.lower() not in present]
    if missing:
        raise ValueError(f"{where}: missing columns {', '.join(missing)}")


def header_cells(header: str, sep: str, where: str) -> list[str]:
    """The cells of a header line; a quoted one may hold the separator."""
    if header.count('"') % 2:
        raise ValueError(f"{where}: a header cell holds a line break: {header}")
    return next(csv.reader([header], delimiter=sep), [])


def clean_names(header: Sequence[str], where: str) -> list[str]:
    """Cleaned header names; two that fall together raise."""
    names = [clean_name(c) for c in header]
    twice = [n for n, count in Counter(n.lower() for n in names).items() if count > 1]
    if twice:
        raise ValueError(f"{where}: columns fall together: {', '.join(twice)}")
    return names


def first_lines(spark: SparkSession, paths: str | Sequence[str], encoding: str, keep: Column | None = None) -> DataFrame:
    """``file``, its first line ``header``, whether a quoted cell of it holds a line break (``broken``), and whether the
    file has several blocks (``long``).

    Only lines of a file's first block are compared; of the others nothing but quotes is counted. ``keep`` is a
    condition on the file's path, checked before its lines are looked at.
    """
    path = F.col("_metadata.file_path")
    lines = spark.read.option("encoding", encoding).text(paths)
    lines = lines.filter(keep) if keep is not None else lines
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    rows = lines.select(
        path.alias("file"),
        F.when(F.col("_metadata.file_block_start") == 0, F.struct(F.monotonically_increasing_id().alias("at"), "value")).alias("line"),
        (quotes % 2 == 1).alias("odd"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    rows = rows.groupBy("file").agg(F.min("line")["value"].alias("header"), F.max("odd").alias("broken"), (F.max("block") > 0).alias("long"))
    return rows.withColumn("header", F.regexp_replace("header", MARKS, ""))


def read_layout(
    spark: SparkSession, files: str | Sequence[str], names: Sequence[str], sep: str, encoding: str, broken: bool, path: str, long: bool = False
) -> DataFrame:
    """Files of one header as text columns ``names``, the file's ``path`` as listings have it, and `MALFORMED`.

    Cells may hold quoted line breaks only where ``broken`` says so. Spark splits files without them over tasks, and reads
    those with them whole; ``long`` ones are read block by block all the same.
    """
    # Without pruning, as else only the cells a query asks for are counted, and a record that does not fit goes unseen.
    options = {"sep": sep, "escape": '"', "columnNameOfCorruptRecord": MALFORMED, "columnPruning": "false"}
    if broken and long:
        return read_quoted(spark, files, names, MALFORMED, encoding, options).withColumnRenamed("file", path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, MALFORMED]])
    rows = spark.read.options(**options).option("header", True).option("encoding", encoding).option("multiLine", broken).schema(schema).csv(files)
    return rows.withColumn(path, F.col("_metadata.file_path"))


class Layout(NamedTuple):
    header: str
    broken: bool
    long: bool
    files: list[str] | None


def layouts(found: DataFrame, listed: bool = False) -> Iterator[Layout]:
    """Distinct headers, whether cells hold line breaks, whether a file is long, and the files: none to name if there is one
    header only.

    ``found`` is the result of `first_lines`; the text is read once for it. With several headers, or where ``listed``
    asks for it, the files are listed, which is the listing Spark keeps on the driver to plan a scan.
    """
    found = settle(found, "headers")
    rows = found.groupBy("header").agg(F.max("broken").alias("broken"), F.max("long").alias("long")).collect()
    files: dict[str, list[str]] = defaultdict(list)
    if listed or len(rows) > 1:
        for row in found.select("file", "header").toLocalIterator():
            files[row["header"]].append(unquote(row["file"]))
    for r in sorted(rows, key=lambda r: r["header"]):
        yield Layout(r["header"], r["broken"], r["long"], sorted(files[r["header"]]) if files else None)


def read_by_name(
    spark: SparkSession, paths: str | Sequence[str], contract: Contract, file_column: str | None = None, path_column: str | None = None
) -> DataFrame:
    """All columns of the files as text under cleaned header names, blanks as NULL, and `MALFORMED`.

    Every file's cells are bound by its own header, so files may order their columns differently and have more of
    them. Files of one header are read together. ``file_column`` names a further column with the file's name,
    ``path_column`` one with its path as listings have it.
    """
    where, whole = contract.name, None
    for layout in layouts(first_lines(spark, paths, contract.encoding)):
        names = clean_names(header_cells(layout.header, contract.sep, where), where)
        require(names, contract.columns, where)
        part = read_layout(spark, layout.files or paths, names, contract.sep, contract.encoding, layout.broken, PATH, layout.long)
        if file_column:
            part = part.withColumn(file_column, F.url_decode(F.element_at(F.split(PATH, "/"), -1)))
        part = part.withColumnRenamed(PATH, path_column) if path_column else part.drop(PATH)
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    if whole is None:
        raise ValueError(f"{where}: no file with a header line at {paths}")
    return whole.select(*[c for c in whole.columns if c != MALFORMED], MALFORMED)


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)


def rejects(df: DataFrame, source: str, column: str | None = None) -> DataFrame:
    """The records whose cells do not fit their header: ``source``, ``reason``, ``cell``, ``record`` (their text).

    ``cell`` is what was read into ``column``, one that every file has; the first by default.
    """
    bad = df.filter(F.col(MALFORMED).isNotNull())
    # Spark refuses to read the malformed text alone, so a cell comes with it.
    return bad.select(
        F.lit(source).alias("source"),
        F.lit("cells do not fit the header").alias("reason"),
        F.col(column or df.columns[0]).alias("cell"),
        F.col(MALFORMED).alias("record"),
    )


def reject_reason(needed: Mapping[str, Column | None]) -> Column:
    """Why a record of `read_by_name` cannot be used, NULL if it can.

    ``needed`` names the columns a record cannot do without and what reads them: a blank one is missing, one that reads
    as NULL cannot be read. None takes any text. A column whose reader never looks at blanks may be blank.
    """
    reason = F.when(F.col(MALFORMED).isNotNull(), "cells do not fit the header")
    for column, value in needed.items():
        if value is None:
            reason = reason.when(F.col(column).isNull(), f"{column} is missing")
        else:
            blank = F.col(column).isNull()
            reason = reason.when(value.isNull(), F.when(blank, f"{column} is missing").otherwise(f"{column} cannot be read"))
    return reason


def reject_summary(df: DataFrame, source: str, typed: Mapping[str, Column]) -> DataFrame:
    """One row: ``source``, records ``delivered`` = ``good`` + ``rejected``, and ``lost``: by column the good records
    whose text ``typed`` could not read (without ``typed``, those whose first cell is blank). ``df`` is the result of `read_by_name`, read once."""
    bad = F.col(MALFORMED).isNotNull()
    unread = [F.count_if(~bad & F.col(c).isNotNull() & value.isNull()).alias(c) for c, value in typed.items()]
    unread = unread or [F.count_if(~bad & F.col(df.columns[0]).isNull()).alias("blank_first_cell")]
    return df.agg(
        F.count(F.lit(1)).alias("delivered"), F.count_if(~bad).alias("good"), F.count_if(bad).alias("rejected"),
        F.struct(*unread).alias("lost"),
    ).withColumn("source", F.lit(source))


def ingest_delimited(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """All columns of the file(s) as text under cleaned header names, blanks as NULL.

    Columns beyond the contract are kept; missing ones raise. Records that do not fit their header are left out;
    `read_by_name` with `rejects` gives them.
    """
    return good_rows(read_by_name(spark, path, contract))


def reload_table(df: DataFrame, path: str) -> bool:
    """Replace the table at ``path`` unless it already holds the same rows; tells whether it was written."""
    spark = df.sparkSession
    try:
        current = spark.read.parquet(path)
    except AnalysisException:
        current = None
    if current is not None and set(current.columns) == set(df.columns) and same_content(current, df):
        return False
    df.write.mode("overwrite").parquet(path)
    return True
