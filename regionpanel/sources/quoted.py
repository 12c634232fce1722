"""Records of delimited files whose quoted cells hold line breaks, read block by block.

Whether a line break ends a record depends on the quotes before it, back to the beginning of the file. A block, however,
does one of two things to "inside quotes": it leaves it as it is or turns it round. One pass finds which, per block; running
these over the blocks of a file says how each block begins. Then every task reads its blocks for itself; only the pieces of
records that blocks cut, at most two a block, are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import settle

QUOTE = '"'
PIECES = "file string, block long, first boolean, head boolean, open boolean, record string"


def _lines(spark: SparkSession, files: str | Sequence[str], encoding: str) -> DataFrame:
    # Line feeds only: carriage returns inside cells stay.
    lines = spark.read.option("encoding", encoding).option("lineSep", "\n").text(files)
    meta = F.col("_metadata")
    return lines.select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), "value")


def block_states(lines: DataFrame) -> DataFrame:
    """``file`` and ``block`` of the blocks that begin inside quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE)))
    turns = lines.groupBy("file", "block").agg((F.sum(quotes % 2) % 2).alias("turns"))
    # A row per block; a file has as many as its size says.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2 == 1
    return turns.withColumn("inside", inside).filter("inside").select("file", "block")


class _Block:
    """The records of one block as its lines come by: what is open is kept, what is whole goes out."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block, self.inside, self.head, self.first = file, block, inside, inside, block == 0 and not inside
        self.kept: list[str] = []

    def take(self, lines: pa.Array, out: list[tuple]) -> None:
        odd = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False) % 2
        after = (np.cumsum(odd) + self.inside) % 2
        texts = lines.to_pylist()
        at = 0
        for end in np.flatnonzero(after == 0):
            out.append(self._row("\n".join([*self.kept, *texts[at : end + 1]]), False))
            self.kept, self.head, self.first = [], False, False
            at = end + 1
        self.kept += texts[at:]
        self.inside = bool(after[-1])

    def close(self, out: list[tuple]) -> None:
        if self.kept:
            out.append(self._row("\n".join(self.kept), True))

    def _row(self, record: str, open_: bool) -> tuple:
        return self.file, self.block, self.first, self.head, open_, record


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces of records of the blocks of a task, whose lines come in order."""
    at: _Block | None = None
    names = ["file", "block", "first", "head", "open", "record"]
    types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        files, blocks, inside, lines = batch.columns
        if not len(lines):
            continue
        out: list[tuple] = []
        other = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1])) if len(lines) > 1 else pa.array([], pa.bool_())
        edges = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist(), len(lines)]
        for a, b in zip(edges, edges[1:], strict=False):
            file, block = files[a].as_py(), blocks[a].as_py()
            if at is None or (at.file, at.block) != (file, block):
                if at is not None:
                    at.close(out)
                at = _Block(file, block, inside[a].as_py())
            at.take(lines[a:b], out)
        yield made(out)
    if at is not None:
        out = []
        at.close(out)
        yield made(out)


def quoted_records(spark: SparkSession, files: str | Sequence[str], encoding: str) -> DataFrame:
    """``file`` and ``record`` (its text, line breaks in cells included) of all records but each file's first, the header."""
    lines = _lines(spark, files, encoding)
    # A row per block that begins inside quotes: a millionth of the text at most. Broadcast, so that the lines stay in order.
    cut = F.broadcast(block_states(lines).withColumn("inside", F.lit(True)))
    marked = lines.join(cut, ["file", "block"], "left")
    marked = marked.select("file", "block", F.coalesce("inside", F.lit(False)).alias("inside"), "value")
    # Stored, as whole records and pieces are read from it.
    pieces = settle(marked.mapInArrow(_pieces, PIECES), "records")
    whole = pieces.filter("NOT head AND NOT open AND NOT first").select("file", "record")
    parts = pieces.filter("head OR open")
    # At most two rows a block: the end of a record begun before, then the beginning of one that goes on.
    along = Window.partitionBy("file").orderBy("block", F.col("head").desc())
    parts = parts.withColumn("chain", F.sum(F.when(F.col("head"), 0).otherwise(1)).over(along))
    row = F.array_sort(F.collect_list(F.struct("block", (~F.col("head")).alias("tail"), "record")))
    joined = parts.groupBy("file", "chain").agg(F.array_join(F.transform(row, lambda p: p["record"]), "\n").alias("record"), F.max("first").alias("first"))
    return whole.unionByName(joined.filter("NOT first").select("file", "record"))


def read_quoted(
    spark: SparkSession, files: str | Sequence[str], names: Sequence[str], malformed: str, encoding: str, options: Mapping[str, str]
) -> DataFrame:
    """Text columns ``names``, ``malformed`` (the text of a record that does not fit) and ``file``."""
    schema = ", ".join(f"`{n}` string" for n in [*names, malformed])
    records = quoted_records(spark, files, encoding)
    text = F.regexp_replace("record", "\r$", "")
    records = records.select("file", text.alias("record")).filter(F.trim("record") != "")
    cells = F.from_csv("record", schema, dict(options))
    return records.select(cells.alias("c"), "file").select("c.*", "file")
