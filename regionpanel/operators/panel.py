"""Operators on panels: one row per entity and day.

All windows below are partitioned by the entity. A panel holds at most one row per entity and calendar day
(`dedupe` or a grouping by entity and day sees to that, with map-side combination), so a window partition never
holds more rows than the calendar has days, however many source rows an entity has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions import change_pct, increase_since


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def by_day(key: str | Sequence[str], date: str) -> WindowSpec:
    """Window per entity in day order, for frames counted in rows."""
    return Window.partitionBy(*_names(key)).orderBy(date)


def _edge(offset: int) -> str:
    if offset == 0:
        return "CURRENT ROW"
    return f"{abs(offset)} {'PRECEDING' if offset < 0 else 'FOLLOWING'}"


def over_days(aggregate: str, key: str | Sequence[str], date: str, first: int, last: int) -> Column:
    """SQL aggregate over the entity's rows from ``first`` to ``last`` calendar days off, by date and not by row.

    Written in SQL since only there a frame on a DATE column is counted in days; ordering by the date itself
    lets all windows of a panel share one sort.
    """
    keys = ", ".join(f"`{k}`" for k in _names(key))
    return F.expr(
        f"{aggregate} OVER (PARTITION BY {keys} ORDER BY `{date}` RANGE BETWEEN {_edge(first)} AND {_edge(last)})"
    )


def earlier(value: str, key: str | Sequence[str], date: str, days: int) -> Column:
    """The value ``days`` calendar days earlier; NULL when that day is missing."""
    return over_days(f"max(`{value}`)", key, date, -days, -days)


def has_earlier(key: str | Sequence[str], date: str, days: int) -> Column:
    """Whether the entity has a row ``days`` calendar days earlier, be its values known or not."""
    return over_days("count(1)", key, date, -days, -days) > 0


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``; end ``order`` with a tie-breaker.

    The row-number filter is applied before the shuffle as well, so each task sends one row per key at most.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rn = 1").drop("_rn")


def require_unique(df: DataFrame, keys: Sequence[str], name: str = "frame") -> DataFrame:
    """The frame itself; raises when two rows share a key or a key is missing. Counts, so it runs a job."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) | missing).first()
    if repeated is not None:
        raise ValueError(f"{name}: {', '.join(keys)} is no key, for instance {tuple(repeated)[:-1]}")
    return df


def latest_per(df: DataFrame, key: str | Sequence[str], date: str, *tie_break: Column) -> DataFrame:
    """The latest row of each entity."""
    return dedupe(df, _names(key), [F.col(date).desc_nulls_last(), *tie_break])


def first_rows_after(later: DataFrame, key: str, date: str, rows: int) -> DataFrame:
    """Entity and date of the first ``rows`` rows of each entity."""
    ranked = later.select(key, date).withColumn("_rn", F.row_number().over(by_day(key, date)))
    return ranked.filter(F.col("_rn") <= rows).drop("_rn")


def with_rows_before(here: DataFrame, before: DataFrame, older: DataFrame, key: str, date: str, rows: int) -> DataFrame:
    """``here`` with the last ``rows`` rows of its entities in front: all rows ``before``, and what is missing from ``older``.

    ``older`` is only read if some entity has fewer rows ``before``; it may be the whole history.
    """
    some = here.select(key).distinct()
    counts = before.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    short = some.join(counts, key, "left").filter(F.coalesce("_n", F.lit(0)) < rows).select(key)
    panel = here.unionByName(before)
    if older.isEmpty() or short.isEmpty():
        return panel
    ranked = older.join(short, key, "left_semi").withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(F.col(date).desc())))
    return panel.unionByName(ranked.filter(F.col("_rn") <= rows).drop("_rn"))


def entities_with_data(df: DataFrame, key: str, measures: Iterable[str]) -> DataFrame:
    """Entities for which the total of at least one measure is above zero."""
    totals = df.groupBy(key).agg(*[F.sum(m).alias(m) for m in measures])
    any_positive = F.lit(False)
    for m in measures:
        any_positive = any_positive | F.coalesce(F.col(m) > 0, F.lit(False))
    return totals.filter(any_positive).select(key)


def keep_entities(df: DataFrame, entities: DataFrame, key: str) -> DataFrame:
    return df.join(entities, key, "left_semi")


def daily_increment(df: DataFrame, key: str | Sequence[str], date: str, measures: Mapping[str, str]) -> DataFrame:
    """Growth of running totals since the day before; ``measures`` maps total -> increment."""
    return df.withColumns(
        {new: increase_since(F.col(total), earlier(total, key, date, 1)) for total, new in measures.items()}
    )


def rolling_rows(
    df: DataFrame, key: str | Sequence[str], date: str, measures: Mapping[str, str], rows: int = 7
) -> DataFrame:
    """Mean of the last ``rows`` rows present: short at the start, and reaching over missing days."""
    frame = by_day(key, date).rowsBetween(-(rows - 1), 0)
    return df.withColumns({new: F.avg(m).over(frame) for m, new in measures.items()})


def rolling_calendar(
    df: DataFrame, key: str | Sequence[str], date: str, measures: Mapping[str, str], days: int = 7
) -> DataFrame:
    """Sum over the last ``days`` calendar days divided by ``days``, missing days counting as zero."""
    return df.withColumns(
        {
            new: over_days(f"sum(`{m}`)", key, date, -(days - 1), 0) / F.lit(float(days))
            for m, new in measures.items()
        }
    )


def base_panel(
    df: DataFrame,
    key: str | Sequence[str],
    date: str,
    increments: Mapping[str, str],
    averages: Mapping[str, str],
) -> DataFrame:
    """Running totals with their daily increments and the row-based 7-day means of those."""
    return rolling_rows(daily_increment(df, key, date, increments), key, date, averages)


def calendar_change(
    df: DataFrame,
    key: str | Sequence[str],
    date: str,
    value: str,
    days: int,
    change: str = "change",
    pct: str = "change_pct",
    null_as_zero: bool = True,
) -> DataFrame:
    """Change and relative change since the row ``days`` calendar days earlier.

    Entity-days without such a row are dropped. ``null_as_zero`` lets an earlier row with an unknown value
    count as zero.
    """
    was = F.col("_earlier")
    start = F.coalesce(was, F.lit(0)) if null_as_zero else was
    return (
        df.withColumns({"_earlier": earlier(value, key, date, days), "_has": has_earlier(key, date, days)})
        .filter("_has")
        .withColumns({change: F.col(value) - start, pct: change_pct(F.col(value), was)})
        .drop("_earlier", "_has")
    )


def lagged_pair(
    df: DataFrame, key: str | Sequence[str], date: str, lead: str, follow: str, days: int
) -> DataFrame:
    """Each day's ``lead`` with the ``follow`` of ``days`` days later (earlier when negative); unpaired days go."""
    there = {
        "_follow": over_days(f"max(`{follow}`)", key, date, days, days),
        "_n": over_days("count(1)", key, date, days, days),
    }
    return (
        df.withColumns(there)
        .filter("_n > 0")
        .select(*_names(key), date, lead, F.col("_follow").alias(follow))
    )


def series_windows(
    df: DataFrame,
    date: str,
    rolling: Mapping[str, str],
    lagged: Mapping[str, str],
    days: int = 7,
    lag: int = 14,
) -> DataFrame:
    """Rolling calendar sums and lagged values of a single series with one row per day.

    A series has no entity to partition a window by. Every row counts on its day, is taken off again ``days`` later, and
    shows itself ``lag`` days later: three rows out of one, however wide the window. The running total of what comes and
    goes is the rolling sum; it runs within months, on top of the totals of the months before. Floating-point amounts are
    summed as decimals of twelve places, so that what comes and goes cancels out.
    """
    own, gone, late = (F.col("_kind") == k for k in (0, 1, 2))
    shifts = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("n")) for k, n in enumerate((0, days, lag))])
    spread = df.withColumn("_shift", F.explode(shifts)).withColumn("_kind", F.col("_shift.kind"))
    amounts = {new: exact(df, c) for c, new in rolling.items()}

    def moved(of: Callable[[Column], Column], c: Column) -> Column:
        return F.coalesce(of(F.when(own, c)), F.lit(0)) - F.coalesce(of(F.when(gone, c)), F.lit(0))

    aggs = [F.max(F.when(own, F.col(c))).alias(c) for c in df.columns if c != date]
    aggs += [F.max(F.when(late, F.col(c))).alias(new) for c, new in lagged.items()]
    aggs += [moved(F.sum, c).alias(f"_sum_{new}") for new, c in amounts.items()]
    aggs += [moved(F.count, c).alias(f"_count_{new}") for new, c in amounts.items()]
    by_date = spread.withColumn(date, F.date_add(F.col(date), F.col("_shift.n"))).groupBy(date).agg(*aggs, F.count(F.when(own, 1)).alias("_present"))
    running = [f"_{kind}_{new}" for kind in ("sum", "count") for new in amounts]
    totals = running_totals(by_date, date, running).filter("_present > 0")
    kind = {new: "double" if is_floating(df, c) else None for c, new in rolling.items()}
    for new in amounts:
        value = F.when(F.col(f"_count_{new}") > 0, F.col(f"_sum_{new}"))
        totals = totals.withColumn(new, value.cast(kind[new]) if kind[new] else value)
    return totals.select(*[c for c in df.columns if c == date], *[c for c in df.columns if c != date], *rolling.values(), *lagged.values())


def is_floating(df: DataFrame, column: str) -> bool:
    return dict(df.dtypes)[column] in ("float", "double")


def exact(df: DataFrame, column: str) -> Column:
    """A column whose sums do not depend on the order: floating point as decimal."""
    return F.col(column).cast("decimal(38,12)") if is_floating(df, column) else F.col(column)


def running_totals(df: DataFrame, date: str, columns: Sequence[str]) -> DataFrame:
    """The columns as totals of all days up to the row's, for a frame of one row per day.

    Totals run within the months, each in a task of its own choosing, and start from the sums of earlier months, of which
    there are as many rows as months.
    """
    rows = df.withColumn("_chunk", F.trunc(date, "month"))
    sums = rows.groupBy("_chunk").agg(*[F.sum(c).alias(f"_base_{c}") for c in columns])
    earlier_chunks = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("_chunk", *[F.coalesce(F.sum(f"_base_{c}").over(earlier_chunks), F.lit(0)).alias(f"_base_{c}") for c in columns])
    inside = Window.partitionBy("_chunk").orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({c: F.sum(c).over(inside) for c in columns}).join(bases, "_chunk")
    return rows.withColumns({c: F.col(c) + F.col(f"_base_{c}") for c in columns}).drop("_chunk", *[f"_base_{c}" for c in columns])


def _doubling_days(value: Column, earlier_value: Column, days: Column) -> Column:
    """Days to double at the mean growth since the earlier point, two decimals."""
    per_day = (value - earlier_value) / F.nullif(days.cast("double"), F.lit(0.0))
    exact = value / F.nullif(per_day, F.lit(0.0)) / 2
    return F.round(exact.cast("decimal(38,9)"), 2).cast("double")


def doubling_time(
    df: DataFrame, key: str, date: str, value: str, out: str = "DoublingTimeDays", non_decreasing: bool = False
) -> DataFrame:
    """Doubling time from the latest earlier day whose value was at most half of today's.

    Days without such an earlier day are dropped. For totals known never to fall, the search is one window in
    value order. Totals that can fall are searched by numpy over all entities of a batch; neither forms pairs of days.
    A day that occurs twice for an entity raises.
    """
    points = df.select(key, date, value).filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    found = _half_by_value(points, key, date, value) if non_decreasing else _half_by_scan(points, key, date, value)
    elapsed = F.datediff(F.col(date), F.col("_half_date"))
    return found.select(key, date, _doubling_days(F.col(value), F.col("_half_value"), elapsed).alias(out))


def _half_by_value(points: DataFrame, key: str, date: str, value: str) -> DataFrame:
    # Every day appears twice on a value axis: as a candidate at twice its value, and as a question at its value.
    sides = F.array(
        F.struct(F.lit(0).alias("kind"), (F.col(value) * 2).alias("at")),
        F.struct(F.lit(1).alias("kind"), F.col(value).alias("at")),
    )
    axis = points.withColumn("_first", F.min(date).over(Window.partitionBy(key))).withColumn(
        "_side", F.explode(sides)
    )
    order = Window.partitionBy(key).orderBy("_side.at", "_side.kind", date)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    candidate = F.when(F.col("_side.kind") == 0, F.struct(F.col(date), F.col(value)))
    return (
        axis.withColumn("_half", F.last(candidate, ignorenulls=True).over(upto))
        .filter("_side.kind = 1 and _half is not null")
        # A total of zero is half of itself; it needs an earlier day like any other.
        .filter((F.col(value) > 0) | (F.col(date) > F.col("_first")))
        .select(
            key, date, value, F.col(f"_half.{date}").alias("_half_date"), F.col(f"_half.{value}").alias("_half_value")
        )
    )


def _latest_half(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each place the latest one before it, not before ``starts``, with at most half its value; -1 if there is none.

    ``least[k]`` holds minima over the 2**k places up to each place. From the widest on, a stretch whose minimum is
    above the half is skipped, so a search takes as many steps as the logarithm of the days, for all rows at once.
    """
    n = len(values)
    at, half = np.arange(n) - 1, values / 2
    least = [values]
    while 1 << len(least) < n:
        step = 1 << (len(least) - 1)
        wide = least[-1].copy()
        wide[step:] = np.minimum(wide[step:], least[-1][:-step])
        least.append(wide)
    for k in range(len(least) - 1, -1, -1):
        fits = at - (1 << k) + 1 >= starts
        skip = fits & (least[k][np.where(fits, at, 0)] > half)
        at = np.where(skip, at - (1 << k), at)
    return np.where(at >= starts, at, -1)


def _half_by_scan(points: DataFrame, key: str, date: str, value: str) -> DataFrame:
    kinds = dict(points.dtypes)
    schema = f"`{key}` {kinds[key]}, `{date}` date, `{value}` double, _half_date date, _half_value double"

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        names = rows[key].to_numpy()
        new = np.r_[True, names[1:] != names[:-1]]
        days = rows[date].to_numpy()
        if (~new[1:] & (days[1:] == days[:-1])).any():
            raise ValueError("a day occurs twice for an entity")
        starts = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
        values = rows[value].to_numpy(dtype="float64")
        half = _latest_half(values, starts)
        hit = half >= 0
        out = rows.loc[hit, [key, date, value]].reset_index(drop=True)
        out["_half_date"] = days[half[hit]]
        out["_half_value"] = values[half[hit]]
        return out

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # An entity may go on in the next batch, so the last one of each waits for it.
        waiting: list[pd.DataFrame] = []
        for batch in batches:
            rows = pd.concat([*waiting, batch], ignore_index=True)
            last = rows[key] == rows[key].iloc[-1] if len(rows) else []
            waiting = [rows[last]] if len(rows) else []
            if len(rows) and not last.all():
                yield search(rows[~last].reset_index(drop=True))
        if waiting:
            yield search(waiting[0].reset_index(drop=True))

    return points.repartition(key).sortWithinPartitions(key, date).mapInPandas(scan, schema)
