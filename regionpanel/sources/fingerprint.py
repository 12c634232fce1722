"""Content fingerprint of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(columns: Sequence[str]) -> Column:
    """Hash of a row as a decimal that can be summed.

    Each value is hashed with its column's name and whether it is NULL, so a value in another column, a NULL in
    another place and a renamed column all show.
    """
    parts = [x for c in sorted(columns) for x in (F.lit(c), F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(*parts).cast("decimal(38,0)")


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and summed row hashes: free of row and column order, and duplicates still count.

    An empty table shows its columns by their names' hash.
    """
    names = F.xxhash64(*[F.lit(c) for c in sorted(df.columns)]).cast("decimal(38,0)")
    return df.agg(
        F.count(F.lit(1)).alias("table_rows"),
        F.coalesce(F.sum(row_hash(df.columns)), names).alias("table_hash"),
    )


def same_content(a: DataFrame, b: DataFrame) -> bool:
    return fingerprint(a).first() == fingerprint(b).first()
