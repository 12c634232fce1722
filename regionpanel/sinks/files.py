"""Exports as TSV and JSON, tables as partitioned Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle


def write_tsv(df: DataFrame, path: str, order: Sequence[str] = (), null: str = "") -> None:
    """Tab-separated text with a header; ``order`` sorts over all files. Unknown values are blank by default."""
    ordered = df.orderBy(*order) if order else df
    ordered.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", null).csv(path)


def write_json(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """JSON Lines, one object per row, unknown values written as null."""
    ordered = df.orderBy(*order) if order else df
    ordered.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_json_array(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Text files whose lines, joined in file order, form one JSON array of objects; ``[]`` without rows.

    The rows are made once, and stay sorted over many files; only the brackets and commas are added, so nothing is
    gathered in one place. The first row in order opens the array and the last closes it, so ``order`` must be unique.
    """
    rows = settle(df, "json-array")
    if rows.isEmpty():
        df.sparkSession.createDataFrame([("[]",)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return
    key = F.struct(*order)
    ends = rows.agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    body = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    line = F.concat(F.when(key == lo, "[").otherwise(""), body, F.when(key == hi, "]").otherwise(","))
    rows.orderBy(*order).select(line.alias("value")).write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full rebuild as Parquet, rows of one partition value brought together before writing.

    The rebalance hint lets Spark split the tasks of a value that holds much of the table and merge small ones.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
