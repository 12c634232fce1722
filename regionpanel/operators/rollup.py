"""Groupings: pivots, shares, totals, weekly buckets and year comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import guarded_ratio
from .panel import is_floating, exact


def pivot_rate(
    df: DataFrame,
    keys: Sequence[str],
    outcome: str,
    value: str,
    outcomes: Mapping[str, str],
    numerator: str,
    total: str = "total",
    rate: str = "rate",
) -> DataFrame:
    """One column per listed outcome, their total, and the numerator's share of it.

    ``outcomes`` maps the outcome text to its column. Other outcomes only keep their group alive. The rate is 0
    without any total, and unknown when the numerator itself is missing.
    """
    wide = df.groupBy(*keys).agg(
        *[F.sum(F.when(F.col(outcome) == text, F.col(value))).alias(name) for text, name in outcomes.items()]
    )
    parts = [F.coalesce(F.col(name), F.lit(0)) for name in outcomes.values()]
    wide = wide.withColumn(total, sum(parts[1:], parts[0]))
    share = F.when(F.col(total) > 0, guarded_ratio(F.col(numerator), F.col(total))).otherwise(0.0)
    return wide.withColumn(rate, share)


def share_of_total(
    df: DataFrame, period: str, category: str, flags: Mapping[str, str], shares: Sequence[str], count: str = "cases"
) -> DataFrame:
    """Counts per period and category, the period's total count, and shares of the period's totals.

    ``flags`` maps 0/1 column -> its sum; ``shares`` lists the sums (or the count) to divide by the period's
    total. The window runs over the grouped rows, one per category.
    """
    grouped = df.groupBy(period, category).agg(
        F.count(F.lit(1)).alias(count), *[F.sum(f).alias(name) for f, name in flags.items()]
    )
    in_period = Window.partitionBy(period)

    def total(name: str):
        # A missing period matches no total.
        return F.when(F.col(period).isNotNull(), F.sum(name).over(in_period))

    with_totals = grouped.withColumns({f"_{name}": total(name) for name in {count, *shares}})
    return (
        with_totals.withColumn(f"{count}_total", F.col(f"_{count}"))
        .withColumns({f"{name}_pct": guarded_ratio(F.col(name), F.col(f"_{name}")) for name in shares})
        .drop(*[f"_{name}" for name in {count, *shares}])
    )


#: Windows of more days are summed by what comes and goes.
SPREAD_DAYS = 14


def bucket_sum(
    df: DataFrame, ends: DataFrame, key: str, date: str, value: str, end: str, out: str, days: int = 7
) -> DataFrame:
    """Sum per entity over the ``days`` days up to each end date; entities without a row in these days are left out.

    Up to ``SPREAD_DAYS`` days the ends are spread over their days, which turns the interval test into an equality. In wider
    windows a day's sum is put in at the first end at or after it and taken out at the first end ``days`` later, so a row is sent
    out twice at most, however many windows it is in; the running total per entity, in the order of the ends, is the
    result. Floating-point amounts are summed as decimals of twelve places, so that what comes and goes cancels out.
    """
    if days <= SPREAD_DAYS:
        spread = ends.select(end).distinct().select(end, F.explode(F.sequence(F.date_sub(F.col(end), days - 1), F.col(end))).alias(date))
        summed = df.groupBy(key, date).agg(F.sum(value).alias("_daily"))
        return summed.join(spread, date).groupBy(key, end).agg(F.sum("_daily").alias(out))
    daily = df.groupBy(key, date).agg(F.sum(exact(df, value)).alias("_sum"))
    # Ends and the days they close: as many rows as the calendar has days.
    numbered = ends.select(end).filter(F.col(end).isNotNull()).distinct()
    numbered = numbered.withColumn("_no", F.row_number().over(Window.orderBy(end))).withColumn("_before", F.lag(end).over(Window.orderBy(end)))
    since = F.coalesce(F.date_add("_before", 1), F.date_sub(end, days - 1))
    closed = numbered.select("_no", F.explode(F.sequence(since, F.col(end))).alias(date))
    leaves = closed.select(F.col("_no").alias("_out"), F.date_sub(date, days).alias(date))
    moves = daily.join(closed, date).join(leaves, date, "left").filter("_out IS NULL OR _no <> _out")
    sides = F.array(F.struct(F.col("_no").alias("no"), F.lit(1).alias("sign")), F.struct(F.col("_out").alias("no"), F.lit(-1).alias("sign")))
    moves = moves.select(key, "_sum", F.explode(sides).alias("_m")).filter("_m.no IS NOT NULL")
    sign = F.col("_m.sign")
    steps = moves.groupBy(key, F.col("_m.no").alias("_no")).agg(
        # Turned, not multiplied, which would cost a decimal some of its places.
        F.sum(F.coalesce(F.when(sign > 0, F.col("_sum")).otherwise(-F.col("_sum")), F.lit(0))).alias("_sum"),
        F.sum(sign).alias("_rows"),
        F.sum(F.when(F.col("_sum").isNotNull(), sign).otherwise(0)).alias("_known"),
    )
    along = Window.partitionBy(key).orderBy("_no")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    last = F.coalesce(F.lead("_no").over(along) - 1, numbered.agg(F.max("_no")).scalar())
    runs = steps.withColumns({"_last": last, **{c: F.sum(c).over(upto) for c in ("_sum", "_rows", "_known")}}).filter("_rows > 0")
    total = F.when(F.col("_known") > 0, F.col("_sum"))
    kind = dict(daily.dtypes)["_sum"] if not is_floating(df, value) else "double"
    shown = runs.select(key, total.cast(kind).alias(out), F.explode(F.sequence("_no", "_last")).alias("_no"))
    return shown.join(numbered.select("_no", end), "_no").select(key, end, out)


def yoy_weeks(
    df: DataFrame, key: str, year: str, week: str, value: str, base_year: int, follow: int = 2
) -> DataFrame:
    """The value of the same entity and week in the base year and the years after it, side by side.

    The base year and the next must be present; later ones may be missing. Expects one row per entity, year
    and week.
    """
    years = range(base_year, base_year + follow + 1)
    wide = df.groupBy(key, week).agg(
        *[F.max(F.when(F.col(year) == y, F.col(value))).alias(f"{value}{y}") for y in years],
        *[F.count(F.when(F.col(year) == y, 1)).alias(f"_n{y}") for y in (base_year, base_year + 1)],
    )
    both = (F.col(f"_n{base_year}") > 0) & (F.col(f"_n{base_year + 1}") > 0)
    return wide.filter(both).drop(f"_n{base_year}", f"_n{base_year + 1}")


def excess_over_baseline(
    df: DataFrame,
    key: str,
    year: str,
    week: str,
    week_end: str,
    value: str,
    base_year: int,
    names: Mapping[str, str],
) -> DataFrame:
    """Weekly values of two years against the mean of the same week up to the base year.

    ``names`` gives the stems of the output columns: ``baseline``, ``value``, ``end``, ``excess`` and ``pct``.
    All years of an entity and week meet in one grouping instead of a chain of self-joins.
    """
    years = (base_year, base_year + 1, base_year + 2)

    def of(y: int, col: str):
        return F.max(F.when(F.col(year) == y, F.col(col)))

    wide = (
        df.groupBy(key, week)
        .agg(
            F.avg(F.when(F.col(year) <= base_year, F.col(value))).alias(names["baseline"]),
            *[of(y, value).alias(f"{names['value']}{y}") for y in years],
            *[of(y, week_end).alias(f"{names['end']}{y}") for y in years[1:]],
            *[F.count(F.when(F.col(year) == y, 1)).alias(f"_n{y}") for y in years[:2]],
        )
        .filter((F.col(f"_n{years[0]}") > 0) & (F.col(f"_n{years[1]}") > 0))
        .drop(f"_n{years[0]}", f"_n{years[1]}")
    )
    usual = F.col(names["baseline"])
    for y in years[1:]:
        excess = F.coalesce(F.col(f"{names['value']}{y}"), F.lit(0)) - F.coalesce(usual, F.lit(0.0))
        wide = wide.withColumns(
            {
                f"{names['excess']}{y}": excess,
                f"{names['pct']}{y}": guarded_ratio(excess, usual) * 100.0,
            }
        )
    return wide


def mean_gap(df: DataFrame, key: str, reported: str, excess: str) -> DataFrame:
    """Mean of two weekly measures per entity, and how far the second lies above the first."""
    means = df.groupBy(key).agg(F.avg(reported).alias("avg_reported"), F.avg(excess).alias("avg_excess"))
    gap = F.col("avg_excess") - F.col("avg_reported")
    return means.withColumns({"diff": gap, "diff_pct": guarded_ratio(gap, F.col("avg_reported")) * 100})


def yearly_total(df: DataFrame, year: str, value: str, out: str, per: int = 1000) -> DataFrame:
    return df.groupBy(year).agg((F.sum(value) / F.lit(float(per))).alias(out))


def prior_year_delta(df: DataFrame, year: str, value: str) -> DataFrame:
    """Yearly rows next to the year before and the relative change in per cent; years without one are dropped."""
    prior = df.select((F.col(year) + 1).alias(year), F.col(value).alias(f"{value}PriorYear"))
    joined = df.select(year, value).join(prior, year)
    was = F.col(f"{value}PriorYear")
    return joined.withColumn("Delta", guarded_ratio(F.col(value) - was, was) * 100.0)


def with_total(
    df: DataFrame, key: str, date: str, measures: Sequence[str], label: str, keep_if: str, leave_out: Sequence[str] = ()
) -> DataFrame:
    """The rows with a known, non-negative ``keep_if``, plus rows summing each day under ``label``."""
    rows = df.filter(F.col(keep_if) >= 0)
    if leave_out:
        rows = rows.filter(~F.col(key).isin(*leave_out))
    total = rows.groupBy(date).agg(*[F.sum(m).alias(m) for m in measures]).withColumn(key, F.lit(label))
    return rows.unionByName(total, allowMissingColumns=True)


def union_eras(*frames: DataFrame) -> DataFrame:
    """Frames of several periods, already brought to the same columns, one below the other."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def patch_group(df: DataFrame, key: str, value: str, target: str, members: Sequence[str]) -> DataFrame:
    """Give ``target`` the summed value of all ``members``; other rows stay as they are."""
    patch = df.filter(F.col(key).isin(*members)).agg(F.sum(value)).scalar()
    patched = F.when(F.col(key) == target, F.coalesce(patch, F.col(value))).otherwise(F.col(value))
    return df.withColumn(value, patched)
