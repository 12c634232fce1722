"""Correlations, regression lines and histograms as aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pair_corr(a: str, b: str) -> Column:
    """Pearson correlation over rows where both are known; NULL when either does not vary.

    ``corr`` itself raises on a constant column, so it is put together from its moments.
    """
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


def corr_by(df: DataFrame, by: str, a: str, b: str, out: str = "corr") -> DataFrame:
    """Correlation of two columns within each value of ``by``."""
    return df.groupBy(by).agg(_pair_corr(a, b).alias(out))


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every pair of columns in long form, from a single pass."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*[_pair_corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def log1p_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.log1p(F.col(c).cast("double")) for c in columns})


def fit_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x``, and the number of points it rests on."""
    known = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    moments = known.agg(
        F.count(F.lit(1)).alias("points"),
        (F.covar_pop(fy, fx) / F.nullif(F.var_pop(fx), F.lit(0.0))).alias("slope"),
        F.avg(fx).alias("_mx"),
        F.avg(fy).alias("_my"),
    )
    return moments.select("points", "slope", (F.col("_my") - F.col("slope") * F.col("_mx")).alias("intercept"))


def histogram(df: DataFrame, col: str, edges: Sequence[float]) -> DataFrame:
    """Rows per bin; bins are closed at the lower edge, the last at both, and values outside count nowhere."""
    last = len(edges) - 2
    bin_no = F
    for number in range(last + 1):
        upper = F.col(col) <= edges[number + 1] if number == last else F.col(col) < edges[number + 1]
        bin_no = bin_no.when(upper, F.lit(number))
    counts = (
        df.filter(F.col(col).between(edges[0], edges[-1]))
        .groupBy(bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    bounds = [(i, float(edges[i]), float(edges[i + 1])) for i in range(last + 1)]
    bins = df.sparkSession.createDataFrame(bounds, "bin int, bin_from double, bin_to double")
    return bins.join(counts, "bin", "left").select(
        "bin", "bin_from", "bin_to", F.coalesce(F.col("_n"), F.lit(0)).alias("n")
    )


def equal_width_edges(df: DataFrame, col: str, bins: int = 5) -> DataFrame:
    """Edges of equal-width bins over the column's range, the lowest moved down by 0.1 % of the range.

    A column of a single value gets its range widened by 0.1 % of that value (by 0.001 around zero) instead.
    """
    ends = df.agg(F.min(F.col(col).cast("double")).alias("lo"), F.max(F.col(col).cast("double")).alias("hi"))
    pad = F.when(F.col("lo") == F.col("hi"), F.when(F.col("lo") == 0, 0.001).otherwise(F.abs("lo") * 0.001)).otherwise(0.0)
    spread = ends.withColumn("pad", pad).select(
        (F.col("lo") - F.col("pad")).alias("lo"),
        (F.col("hi") + F.col("pad")).alias("hi"),
        (F.col("pad") == 0).alias("lower_first"),
        F.explode(F.sequence(F.lit(0), F.lit(bins))).alias("edge_no"),
    )
    width = F.col("hi") - F.col("lo")
    at = F.col("lo") + width / bins * F.col("edge_no")
    moved = F.when((F.col("edge_no") == 0) & F.col("lower_first"), at - width * 0.001).otherwise(at)
    return spread.filter(F.col("lo").isNotNull()).select("edge_no", moved.alias("edge"))
