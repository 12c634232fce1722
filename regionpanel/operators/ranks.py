"""Positions in one order over a whole frame, without one task seeing it all."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle


# Layout of monotonically_increasing_id: the partition in the upper bits, the row's number in it in the lower 33.
ROW_BITS = 33


def global_position(df: DataFrame, order: Sequence[Column], amount: str | None = None, out: str = "position") -> DataFrame:
    """Running count (or running sum of ``amount``) of the frame in ``order``; end ``order`` with a unique column.

    The frame is cut into ordered slices of about equal size, each sorted for itself, and written with the rows'
    numbers. A position is the number inside the slice plus the totals of the slices before it. These totals are
    one row per slice, so their window and broadcast stay small.
    """
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    cut = settle(cut, "ranked").withColumn("_slice", F.shiftright("_id", ROW_BITS))
    if amount is None:
        inside = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
        total = F.count(F.lit(1))
    else:
        upto = Window.partitionBy("_slice").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
        inside, total = F.sum(amount).over(upto), F.sum(amount)
    totals = cut.groupBy("_slice").agg(total.alias("_total"))
    before = totals.select(
        "_slice", (F.sum("_total").over(Window.orderBy("_slice")) - F.col("_total")).alias("_before")
    )
    return (
        cut.withColumn("_inside", inside)
        .join(F.broadcast(before), "_slice")
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_id", "_slice", "_inside", "_before")
    )


#: Equal shares into which a bracket is cut in each round, the accuracy of the cuts (error in rows: bracket / accuracy),
#: and the rows of a bracket among which the value is picked.
CUTS = 200
ACCURACY = 10_000
PICK_ROWS = 100_000


def quantiles(df: DataFrame, value: str, probs: dict[str, float], median: str | None = None, cuts: int = CUTS, pick: int = PICK_ROWS) -> DataFrame:
    """Exact quantiles as one row: the smallest value with at least that share of rows at or below it.

    ``median`` names a further column with the mean of the two middle rows. Nothing is sorted or stored. Every rank
    has a bracket: an open interval, the rows below it and in it. One job a round serves all ranks: it counts the rows
    at and between some pivots and cuts each stretch between pivots into ``cuts`` shares by approximate percentiles.
    A rank that falls on the rows of a pivot is found, however many they are; else it goes on strictly between two
    pivots, with the shares next to it as the next pivots. Pivots are values of rows inside the bracket, so every
    round leaves fewer rows; a bracket shrinks to about 4 / ``cuts``, so a trillion rows take some five rounds. From
    brackets of at most ``pick`` rows one last job takes the values.

    Null values are left out; without rows all results are NULL.
    """
    rows = df.select(F.col(value).alias("v")).filter("v IS NOT NULL")
    shares = F.expr(f"percentile_approx(v, array({', '.join(f'{i / cuts}D' for i in range(cuts + 1))}), {ACCURACY})")
    n, grid = rows.agg(F.count(F.lit(1)), shares).first()
    ranks = {name: max(math.ceil(q * n), 1) for name, q in probs.items()}
    if median:
        ranks |= {"_low": (n + 1) // 2, "_high": (n + 2) // 2}
    found: dict[int, Any] = {}
    open_at = {r: Bracket(None, None, 0, n, grid) for r in ranks.values()} if n else {}
    while any(b.rows > pick for b in open_at.values()):
        open_at = _round(rows, open_at, found, shares)
    if open_at:
        found |= _pick(rows, open_at)
    schema = T.StructType([T.StructField(name, rows.schema["v"].dataType) for name in ranks])
    row = df.sparkSession.createDataFrame([tuple(found.get(r) for r in ranks.values())], schema)
    if not median:
        return row
    return row.withColumn(median, (F.col("_low") + F.col("_high")) / 2).drop("_low", "_high")


class Bracket(NamedTuple):
    """Rows strictly between ``low`` and ``high`` (None: no bound): how many lie before them, how many they are, and
    the values that cut them into equal shares."""

    low: Any
    high: Any
    before: int
    rows: int
    grid: Sequence[Any]

    def holds(self) -> Column:
        inside = F.lit(True)
        if self.low is not None:
            inside &= F.col("v") > F.lit(self.low)
        if self.high is not None:
            inside &= F.col("v") < F.lit(self.high)
        return inside

    def pivots(self, rank: int) -> list[Any]:
        """The values of the shares around a rank."""
        cuts = len(self.grid) - 1
        at = (rank - self.before) / self.rows * cuts
        near = range(max(math.floor(at) - 1, 0), min(math.ceil(at) + 1, cuts) + 1)
        return [self.grid[i] for i in near]


def _round(rows: DataFrame, open_at: dict[int, Bracket], found: dict[int, Any], shares: Column) -> dict[int, Bracket]:
    """One job for all open ranks; those that fall on a pivot go to ``found``, the others into a smaller bracket.

    A row's region is twice the number of pivots below it, and one more if it is equal to the next.
    """
    wanted: dict[tuple, list[int]] = {}
    for rank, b in open_at.items():
        wanted.setdefault((b.before, b.rows), []).append(rank)
    brackets = {(b.before, b.rows): b for b in open_at.values()}
    pivots = {}
    for place, ranks in wanted.items():
        values: list[Any] = []
        for v in sorted(v for r in ranks for v in brackets[place].pivots(r)):
            if not values or v != values[-1]:
                values.append(v)
        pivots[place] = values
    where, region, start = F.lit(False), F.lit(None).cast("int"), {}
    for i, place in enumerate(sorted(pivots)):
        start[place] = sum(2 * len(pivots[p]) + 1 for p in sorted(pivots)[:i])
        inside = brackets[place].holds()
        passed = [(F.col("v") >= F.lit(p)).cast("int") + (F.col("v") > F.lit(p)).cast("int") for p in pivots[place]]
        where |= inside
        region = F.when(inside, sum(passed, F.lit(start[place]))).otherwise(region)
    cut = rows.filter(where).groupBy(region.alias("region"))
    # As many rows as regions: at most nine per rank.
    counted = {r["region"]: r for r in cut.agg(F.count(F.lit(1)).alias("n"), shares.alias("grid")).collect()}
    left = {}
    for place, ranks in wanted.items():
        b, values = brackets[place], pivots[place]
        for rank in ranks:
            before = b.before
            for i in range(2 * len(values) + 1):
                got = counted.get(start[place] + i)
                if got is None:
                    continue
                if rank <= before + got["n"]:
                    if i % 2:
                        found[rank] = values[i // 2]
                    else:
                        low = values[i // 2 - 1] if i else b.low
                        high = values[i // 2] if i < 2 * len(values) else b.high
                        left[rank] = Bracket(low, high, before, got["n"], got["grid"])
                    break
                before += got["n"]
    return left


def _pick(rows: DataFrame, open_at: dict[int, Bracket]) -> dict[int, Any]:
    """The values of all open ranks out of the few rows of their brackets, in one job."""
    brackets = sorted({(b.before, b.rows): b for b in open_at.values()}.items())
    number = {place: i for i, (place, _) in enumerate(brackets)}
    of = F.lit(None).cast("int")
    for i, (_, b) in enumerate(brackets):
        of = F.when(b.holds(), i).otherwise(of)
    counts = rows.select("v", of.alias("b")).filter("b IS NOT NULL").groupBy("b", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("b").orderBy("v")))
    wanted = []
    for rank, b in open_at.items():
        here = (F.col("b") == number[b.before, b.rows]) & (F.col("upto") >= rank - b.before)
        wanted.append(F.min(F.when(here, F.col("v"))).alias(f"r{rank}"))
    row = upto.agg(*wanted).first()
    return {rank: row[f"r{rank}"] for rank in open_at}


def rank_panels(df: DataFrame, key: str, date: str, value: str, size: int = 10) -> DataFrame:
    """Series grouped into panels of ``size`` entities by their value on the latest day, largest first.

    Entities without a row on the latest day belong to no panel and are dropped.
    """
    latest = df.filter(F.col(date) == df.agg(F.max(date)).scalar()).select(key, F.col(value).alias("_at"))
    ranked = global_position(latest, [F.col("_at").desc_nulls_last(), F.col(key)])
    panels = ranked.select(key, F.floor((F.col("position") - 1) / size).cast("int").alias("panel"))
    return df.select(key, date, value).join(panels, key)
