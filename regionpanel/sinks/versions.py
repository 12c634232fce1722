"""Parquet tables that are replaced as a whole: new rows go to new folders, then a pointer names the folders that count.

A write that dies leaves folders no pointer names, and every reader goes on reading what it read before. A table may be
kept in parts by a date column (the month, say): a write can then replace some parts and leave the files of the others
alone, and filters on that column still prune. The pointer is a folder of one-line text files, one per write, the last
of which holds; a file is there as soon as Spark commits it. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

#: Partition column of the folders of one write, below the part's.
VERSION = "version"
NO_PART = ""


@dataclass(frozen=True)
class Pointer:
    """``parts``: folder of every part by its value; ``mark`` and ``basis`` (marks of the parts of what it was made from)
    are the writer's own notes."""

    number: int
    parts: Mapping[str, str]
    by: str | None
    table_schema: str
    mark: str = ""
    basis: Mapping[str, str] = field(default_factory=dict)


def _pointers(spark: SparkSession, path: str) -> list[Pointer]:
    """All pointers of a table, the latest first: as many as writes."""
    try:
        lines = spark.read.text(f"{path}/pointer").collect()
    except AnalysisException:
        return []
    return sorted((Pointer(**json.loads(r["value"])) for r in lines), key=lambda p: -p.number)


def pointer(spark: SparkSession, path: str) -> Pointer | None:
    """What the table at ``path`` consists of; None where there is none yet."""
    return next(iter(_pointers(spark, path)), None)


def _folder(path: str, by: str | None, part: str, version: str) -> str:
    return f"{path}/data/{f'{by}={part}/' if by else ''}{VERSION}={version}"


def read_parts(spark: SparkSession, path: str, at: Pointer) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(at.table_schema))
    folders = [_folder(path, at.by, part, version) for part, version in sorted(at.parts.items())]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)
    return rows.select(*[f"`{f.name}`" for f in schema.fields])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as the last finished write left it."""
    at = pointer(spark, path)
    if at is None:
        raise ValueError(f"{path}: no table")
    return read_parts(spark, path, at)


def publish(
    df: DataFrame, path: str, by: str | None = None, replaces: Iterable[str] | None = None,
    mark: str = "", basis: Mapping[str, str] | None = None, check: Callable[[DataFrame], object] | None = None,
) -> Pointer:
    """Write ``df`` and let the table at ``path`` consist of it.

    ``by`` keeps the table in parts by a date column; ``replaces`` names the parts (ISO dates) that the rows stand for:
    parts without rows go, parts not named stay as they are. Without it all parts are replaced. ``check`` sees the new
    rows as written and may raise; the table is then as before.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    before = pointer(spark, path)
    if by is None:
        df.write.parquet(_folder(path, None, NO_PART, version))
        written = {NO_PART: version}
    else:
        rows = df.hint("rebalance", F.col(by)).withColumn(VERSION, F.lit(version))
        rows.write.mode("append").partitionBy(by, VERSION).parquet(f"{path}/data")
        written = dict.fromkeys(_parts_of(spark, path, by, version), version)
    schema = json.dumps(T.StructType([f for f in df.schema.fields if f.name != by] + [f for f in df.schema.fields if f.name == by]).jsonValue())
    number = before.number + 1 if before else 1
    new = Pointer(number, written, by, schema, mark, dict(basis or {}))
    if check is not None:
        check(read_parts(spark, path, new))
    if before and replaces is not None and by == before.by:
        gone = set(replaces)
        new = Pointer(number, {p: v for p, v in before.parts.items() if p not in gone} | written, by, schema, mark, new.basis)
    line = spark.createDataFrame([(json.dumps(asdict(new)),)], "value string")
    line.coalesce(1).write.mode("append").text(f"{path}/pointer")
    _drop_unused(spark, path, [new, *([before] if before else [])])
    return new


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    return hadoop, place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _below(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it does not exist."""
    _, place, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def _parts_of(spark: SparkSession, path: str, by: str, version: str) -> list[str]:
    """Parts that a write has made: a look at folder names, as many as the table has parts."""
    parts = [n.split("=", 1)[1] for n in _below(spark, f"{path}/data") if n.startswith(f"{by}=")]
    return [p for p in parts if f"{VERSION}={version}" in _below(spark, f"{path}/data/{by}={p}")]


def _drop_unused(spark: SparkSession, path: str, keep: list[Pointer]) -> None:
    """Delete folders that neither the last pointer nor the one before names, and older pointers' rows stay as notes.

    Readers of the table before the last write can finish. Folders of writes that died go as well.
    """
    used = {(p.by, part, version) for p in keep for part, version in p.parts.items()}
    for name in _below(spark, f"{path}/data"):
        if name.startswith(f"{VERSION}="):
            found = [(None, NO_PART, name)]
        elif "=" in name:
            by, part = name.split("=", 1)
            found = [(by, part, v) for v in _below(spark, f"{path}/data/{name}") if v.startswith(f"{VERSION}=")]
        else:
            continue
        for by, part, folder in found:
            version = folder.split("=", 1)[1]
            if (by, part, version) not in used:
                _, place, fs = _file_system(spark, _folder(path, by, part, version))
                fs.delete(place, True)
