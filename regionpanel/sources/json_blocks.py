"""Elements of one long JSON value, read block by block: the rows of an array of arrays, the features of a collection.

Spark cuts the file at a closing bracket instead of at line ends, so no line break is needed. Whether a bracket counts, and
what it closes, depends on all text before: is it inside a string, and how deep? A block turns "inside a string" round or
not, and adds to the depth one of two numbers, depending on how it begins. One pass finds these, per block; run over the
blocks of a file they say how each begins. Then every task cuts the elements of its blocks out, and the pieces of elements
that blocks cut are brought together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import settle

# A string, maybe without its end, or a bracket; and the rest of a string begun before. An escape outside strings is no
# JSON, but seen by a reader that takes strings for what is between them; skipped, it leaves both with the same quotes.
_TOKEN = re.compile(r'(?P<escape>\\.)|"(?:[^"\\]|\\.)*(?P<end>"?)|(?P<open>[\[{])|(?P<close>[\]}])', re.DOTALL)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)

EFFECT = "file string, block long, turns boolean, outside long, inside long"
PIECES = "file string, block long, first boolean, head boolean, open boolean, member string, record string"


class _Reader:
    """Goes through the text of a block, piece by piece; every piece ended with the closing bracket ``close``."""

    def __init__(self, close: str, depth: int, level: int, in_string: bool):
        self.close, self.depth, self.level, self.in_string = close, depth, level, in_string
        self.member: str | None = None
        self.key: str | None = None
        self.kept: list[str] | None = [] if level >= depth else None

    def take(self, text: str) -> str | None:
        """Read a piece; gives the element that ends with it, if one does."""
        at, begin = 0, 0
        if self.in_string:
            found = _STRING_END.match(text)
            at = found.end() if found else len(text)
            self.in_string = not found
        if not self.in_string:
            for m in _TOKEN.finditer(text, at):
                if m["escape"]:
                    continue
                if m["open"]:
                    self.level += 1
                    if self.level == self.depth - 1:
                        self.member = self.key
                    elif self.level == self.depth and self.kept is None:
                        self.kept, begin = [], m.start()
                elif m["close"]:
                    self.level -= 1
                elif not m["end"]:
                    self.in_string = True
                elif self.level == self.depth - 2:
                    self.key = m[0][1:-1]
        if self.kept is not None:
            self.kept.append(text[begin:] + self.close)
        if not self.in_string:
            self.level -= 1
            if self.level < self.depth and self.kept is not None:
                element, self.kept = "".join(self.kept), None
                return element
        return None


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str], bool]]:
    """Runs of pieces of one block: what is told of the block, the pieces, and whether the block is new."""
    last = None
    for batch in batches:
        *told, texts = (c.to_pylist() for c in batch.columns)
        begin = 0
        marks = list(zip(*told, strict=True))
        for i in range(1, len(marks) + 1):
            if i == len(marks) or marks[i] != marks[begin]:
                yield marks[begin], texts[begin:i], marks[begin] != last
                last, begin = marks[begin], i


def _effects(close: str):
    """What each block does to a reader that begins outside and to one that begins inside a string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers, mark, out = (), None, []

        def row() -> tuple:
            outside, inside = readers
            return *mark, outside.in_string, outside.level, inside.level

        for at, texts, new in _runs(batches):
            if new:
                if mark is not None:
                    out.append(row())
                # So deep that no element is ever kept.
                mark, readers = at, tuple(_Reader(close, 1 << 40, 0, s) for s in (False, True))
            for text in texts:
                for reader in readers:
                    reader.take(text)
        if mark is not None:
            out.append(row())
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file", "block", "turns", "outside", "inside"])

    return run


def _elements(close: str, depth: int):
    names = ["file", "block", "first", "head", "open", "member", "record"]
    types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, at, head, first, out = None, None, False, False, []

        def row(record: str | None, open_: bool) -> tuple:
            return at[0], at[1], first, head, open_, reader.member, record

        def end() -> None:
            if reader is not None:
                if reader.kept:
                    out.append(row("".join(reader.kept), True))
                out.append(row(None, False))

        def made() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for mark, texts, new in _runs(batches):
            if new:
                end()
                file, block, inside, level = mark
                at, reader = (file, block), _Reader(close, depth, level, inside)
                head, first = reader.kept is not None, block == 0
            for text in texts:
                element = reader.take(text)
                if element is not None:
                    out.append(row(element, False))
                    head = first = False
            yield made()
        end()
        yield made()

    return run


def json_elements(spark: SparkSession, paths: str | Sequence[str], close: str, depth: int, encoding: str = "UTF-8") -> DataFrame:
    """``file``, ``first`` (of its file), ``member`` and ``record`` of all elements that open at ``depth`` and end with ``close``.

    ``depth`` counts brackets: 2 are the arrays in an array, 3 the objects in an array of an object, of which ``member`` is
    the name of the array. Other elements (null, numbers) are left out. A file that is no JSON gives what its brackets say.
    """
    text = spark.read.option("encoding", encoding).option("lineSep", close).text(paths)
    meta = F.col("_metadata")
    text = text.select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), "value")
    effects = settle(text.mapInArrow(_effects(close), EFFECT), "effects")
    # A row per block; a file has as many as its size says.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = effects.withColumn("in_string", F.coalesce(F.sum(F.col("turns").cast("int")).over(before), F.lit(0)) % 2 == 1)
    adds = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    starts = starts.withColumn("level", F.coalesce(F.sum(adds).over(before), F.lit(0))).select("file", "block", "in_string", "level")
    # A millionth of the text at most, and broadcast, so that the pieces stay in order.
    marked = text.join(F.broadcast(starts), ["file", "block"]).select("file", "block", "in_string", "level", "value")
    pieces = settle(marked.mapInArrow(_elements(close, depth), PIECES), "elements")
    # The array an element is in may have been opened blocks before; a block's last row says which it left open.
    named = pieces.filter("record IS NULL").withColumn("carried", F.last("member", ignorenulls=True).over(before))
    carried = F.broadcast(named.select("file", "block", "carried"))
    pieces = pieces.filter("record IS NOT NULL").join(carried, ["file", "block"]).withColumn("member", F.coalesce("member", "carried"))
    whole = pieces.filter("NOT head AND NOT open").select("file", "first", "member", "record")
    parts = pieces.filter("head OR open")
    along = Window.partitionBy("file").orderBy("block", F.col("head").desc())
    parts = parts.withColumn("chain", F.sum(F.when(F.col("head"), 0).otherwise(1)).over(along))
    row = F.array_sort(F.collect_list(F.struct("block", (~F.col("head")).alias("tail"), "record")))
    joined = parts.groupBy("file", "chain").agg(
        F.max("first").alias("first"), F.min("member").alias("member"), F.array_join(F.transform(row, lambda p: p["record"]), "").alias("record")
    )
    return whole.unionByName(joined.drop("chain"))
