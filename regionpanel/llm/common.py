"""What several text operators share: the word pattern, readers, row identity and intermediate tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpanel.session import settle

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = b"\t\n\x0b\x0c\r "

__all__ = ["BLANKS", "WORD", "bounded", "read", "row_hash", "settle", "word_count", "words_of"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8. bytes.split() parts at exactly the six characters WORD leaves out."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def row_hash(text: Column) -> Column:
    """Stands for the text beside the id of a row; null and empty texts differ."""
    return F.when(text.isNull(), F.lit(-1).cast("long")).otherwise(F.xxhash64(text))


def bounded(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of consecutive items whose sizes add up to ``most``; a larger item makes a range alone."""
    a = total = 0
    b = -1
    for b, size in enumerate(sizes):
        if b > a and total + size > most:
            yield a, b
            a, total = b, 0
        total += size
    if b >= a:
        yield a, b + 1
