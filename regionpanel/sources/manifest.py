"""Which delivered files are new, changed or gone since the last run, told from the listing alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a listing; they tell a changed file without reading it.
LISTED = ("path", "size", "modified")


def list_files(spark: SparkSession, paths: str | list[str], keep: Column | None = None) -> DataFrame:
    """``path``, ``size`` and ``modified`` (UTC microseconds) of the files; no file is opened. ``keep`` is a condition on
    ``path``."""
    meta = F.col("_metadata")
    files = spark.read.format("binaryFile").load(paths).select(
        meta["file_path"].alias("path"), meta["file_size"].alias("size"), F.unix_micros(meta["file_modification_time"]).alias("modified")
    )
    return files if keep is None else files.filter(keep)


def differences(listed: DataFrame, known: DataFrame) -> DataFrame:
    """``path`` and ``change`` of the files that differ between two listings: new, changed or gone."""
    now, then = (df.select("path", F.struct("size", "modified").alias(c)) for df, c in ((listed, "now"), (known, "then")))
    both = now.join(then, "path", "full_outer")
    change = F.when(F.col("then").isNull(), "new").when(F.col("now").isNull(), "gone").when(F.col("now") != F.col("then"), "changed")
    return both.select("path", change.alias("change")).filter("change IS NOT NULL")
