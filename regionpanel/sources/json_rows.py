"""Tables delivered as JSON arrays of arrays, the first of which is the header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .delimited import clean_names, require
from .json_blocks import json_elements
from .manifest import list_files


#: Files from this size on are read block by block.
LONG_FILE = 64_000_000


def ingest_json_rows(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] = (), encoding: str = "UTF-8", path_column: str | None = None, long_file: int = LONG_FILE
) -> DataFrame:
    """All cells as text, columns named by the header of the first file; every file has its own header row.

    Cells are picked by header name, so files may order their columns differently; cells a row does not have are
    NULL, cells beyond the header are left out, and so are elements that are null. Small files are parsed whole, one task
    a file; if one has ``long_file`` bytes, all are read by many tasks each. ``path_column`` names a further column with
    the file's path as listings have it.
    """
    paths = path if isinstance(path, str) else list(path)
    sizes = list_files(spark, paths).agg(F.max("size").alias("most")).first()
    rows = _by_block(spark, paths, encoding) if (sizes["most"] or 0) >= long_file else _whole(spark, paths, encoding)
    header = rows.filter(F.col("h").isNotNull()).select("h").first()
    if header is None:
        raise ValueError(f"{path}: no header row")
    names = clean_names(header["h"], str(path))
    require(names, columns, str(path))
    # The place of each column is looked up once per file, not per row.
    places = [F.array_position("h", raw).cast("int").alias(f"at{i}") for i, raw in enumerate(header["h"])]
    cells = rows.select("file", *places, "rows").select("*", F.explode("rows").alias("cells")).filter("cells IS NOT NULL")
    picked = [F.when(F.col(f"at{i}") > 0, F.try_element_at("cells", F.col(f"at{i}"))).alias(n) for i, n in enumerate(names)]
    return cells.select(*picked, *([F.col("file").alias(path_column)] if path_column else []))


def _whole(spark: SparkSession, paths: str | list[str], encoding: str) -> DataFrame:
    """``file``, its header ``h`` and its ``rows``."""
    text = F.decode(F.col("content"), encoding)
    docs = spark.read.format("binaryFile").load(paths)
    docs = docs.select(F.from_json(text, "array<array<string>>").alias("all"), F.col("_metadata.file_path").alias("file"))
    return docs.select("file", F.get("all", F.lit(0)).alias("h"), F.slice("all", 2, F.greatest(F.size("all"), F.lit(1))).alias("rows"))


def _by_block(spark: SparkSession, paths: str | list[str], encoding: str) -> DataFrame:
    """The same with a row's cells in an array by themselves, so that a file is many rows."""
    elements = json_elements(spark, paths, "]", 2, encoding).withColumn("cells", F.from_json("record", "array<string>"))
    headers = elements.filter("first").select("file", F.col("cells").alias("h"))
    return elements.filter("NOT first").select("file", F.array("cells").alias("rows")).join(headers, "file")


#: What a feature of a collection has; further members are left out.
FEATURE = "properties struct<STATE: string, COUNTY: string>, geometry string"


def read_features(spark: SparkSession, path: str | Sequence[str], key: str = "FIPS") -> DataFrame:
    """GeoJSON feature collections in files as one row per feature: key and geometry text; each file is read by many tasks."""
    found = json_elements(spark, path if isinstance(path, str) else list(path), "}", 3).filter("member = 'features'")
    parsed = found.select(F.from_json("record", FEATURE).alias("f")).filter("f IS NOT NULL")
    return parsed.select(F.concat("f.properties.STATE", "f.properties.COUNTY").alias(key), F.col("f.geometry").alias("geometry"))
