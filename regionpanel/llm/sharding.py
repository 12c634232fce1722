"""Shuffle a table into shards in two passes.

Pass one scatters records into buckets of about ``bucket_bytes`` by a seeded hash. Pass two reads one bucket at a
time, shuffles it (Fisher-Yates) and numbers its rows. Buckets one after the other make one random order of all
rows, and shards are equal cuts of that order, so their counts differ by one row at most (law ``rows``).

Defined results: a null text has no bytes and no checksum, an empty one the checksum 0; rows alike in id and text
fall into one bucket, next to which any order is the same; a very long text travels like any other record; an empty table gives no rows; further columns stay.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_hash, settle

LAW = "rows"


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def crc(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes."""
    return F.crc32(F.encode(text, "UTF-8"))


def fisher_yates(bucket: Column, size: Column, row: Column, seed: int) -> Column:
    """Where the ``row``-th record of a bucket of ``size`` records lands when the bucket is shuffled."""

    def place(buckets: pd.Series, sizes: pd.Series, rows: pd.Series) -> pd.Series:
        b, n, r = buckets.to_numpy(), sizes.to_numpy(), rows.to_numpy()
        out = np.empty(len(b), dtype=np.int64)
        for one in np.unique(b):
            here = b == one
            order = np.arange(n[here][0])
            np.random.Generator(np.random.PCG64([seed, int(one)])).shuffle(order)  # a Fisher-Yates shuffle
            out[here] = order[r[here]]
        return pd.Series(out)

    return F.pandas_udf(place, "long")(bucket, size, row)


def two_pass_shuffle(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", seed: int = 7, bucket_bytes: int = 12_000_000) -> DataFrame:
    """``docs`` with ``shard`` (0 .. shards-1) and ``slot`` (from 0, without gaps); columns of these names give way.

    A record travels once, to the bucket it is written from; there Spark sorts it (spilling if need be) and only
    its number is shuffled in Python.
    """
    docs = docs.drop("shard", "slot")
    total, rows = docs.agg(F.sum(text_bytes(F.col(text)) + 64), F.count(F.lit(1))).first()
    buckets, rows = max(1, -(-(total or 0) // bucket_bytes)), max(rows, 1)
    h = F.xxhash64(F.lit(seed), F.col(doc_id), row_hash(F.col(text)))
    scattered = docs.withColumn("_h", h).withColumn("_bucket", F.pmod("_h", F.lit(buckets)).cast("long"))
    counts = scattered.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # One row per bucket.
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(counts.withColumn("_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0))), "buckets")
    numbered = scattered.withColumn("_row", F.row_number().over(Window.partitionBy("_bucket").orderBy("_h", doc_id)) - 1)
    # The bucket's row in ``starts`` goes to the partition the bucket is in already.
    at = F.col("_first") + fisher_yates(F.col("_bucket"), F.col("_n"), F.col("_row"), seed)
    placed = numbered.join(starts, "_bucket").withColumn("_at", at)
    placed = placed.withColumn("shard", F.expr(f"_at * {shards} div {rows}").cast("int"))
    begin = F.expr(f"(shard * {rows} + {shards - 1}) div {shards}")
    return placed.withColumn("slot", (F.col("_at") - begin).cast("long")).select(*docs.columns, "shard", "slot")
