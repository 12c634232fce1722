"""Snapshots, rankings, short series and record highs for reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import guarded_ratio, signed_label, trend_label


def latest_day(df: DataFrame, date: str) -> DataFrame:
    """The rows of the latest day in the frame."""
    return df.filter(F.col(date) == df.agg(F.max(date)).scalar())


def last_date(df: DataFrame, date: str, month: str | None = None) -> Column:
    """The latest day; with a partition column ``month`` only its newest partition is read for it."""
    if month is None or month not in df.columns:
        return df.agg(F.max(date)).scalar()
    return df.filter(F.col(month) == df.agg(F.max(month)).scalar()).agg(F.max(date)).scalar()


def trailing_days(df: DataFrame, date: str, days: int, of: DataFrame | None = None, month: str | None = None) -> DataFrame:
    """Rows from ``days`` days before the latest day on, that day found in ``of`` if given.

    ``month`` names a partition column holding the first of the date's month: older partitions are not read.
    """
    first = F.date_sub(last_date(df if of is None else of, date, month), days)
    rows = df.filter(F.col(date) >= first)
    return rows.filter(F.col(month) >= F.trunc(first, "month")) if month in df.columns else rows


def top_k(df: DataFrame, metric: str, tie: Sequence[str], k: int = 100) -> DataFrame:
    """The ``k`` rows with the highest metric, unknown counting as zero."""
    known = F.coalesce(F.col(metric), F.lit(0))
    return df.orderBy(known.desc(), *tie).limit(k)


def recent_points(df: DataFrame, key: str, date: str, values: Sequence[str], n: int, out: str = "points") -> DataFrame:
    """The last ``n`` rows of each entity as an array of (date, values), oldest first."""
    newest = Window.partitionBy(key).orderBy(F.col(date).desc())
    last = df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n)
    return last.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(date, *values))).alias(out))


def latest_nonnull(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """The latest known, non-zero value per entity with its date; an entity's very first row does not count."""
    seen = df.groupBy(key).agg(F.min(date).alias("_first"), F.max(F.when(_truthy(value), F.struct(date, value))).alias("_at"))
    # The newest hit being the first row means there is no later one.
    return seen.filter(F.col(f"_at.{date}") > F.col("_first")).select(
        key, F.col(f"_at.{date}").alias(date), F.col(f"_at.{value}").alias(value)
    )


def _truthy(value: str) -> Column:
    return F.col(value).isNotNull() & (F.col(value) != 0)


def first_last_change(points: Column) -> Column:
    """Last minus first element; NULL for an empty array."""
    return F.try_element_at(points, F.lit(-1)) - F.try_element_at(points, F.lit(1))


def first_last_pct(points: Column) -> Column:
    """Change from the first to the last element relative to the first, if that is above zero."""
    first = F.try_element_at(points, F.lit(1))
    return F.when(first > 0, first_last_change(points) / first.cast("double"))


def record_high(df: DataFrame, key: str, date: str, value: str, days: int = 14) -> DataFrame:
    """Each entity's latest value against its record, with the change over ``days`` days.

    Record, latest value and earlier value come out of one grouping. Entities lacking a row on the latest day or
    ``days`` days before it are dropped. The newest of equal records counts.
    """
    now = F.col(date) == F.col("_last")
    then = F.col(date) == F.date_sub("_last", days)
    seen = (
        df.withColumn("_last", df.agg(F.max(date)).scalar())
        .groupBy(key)
        .agg(
            F.max(F.struct(F.col(value), F.col(date))).alias("_record"),
            F.max(F.when(now, F.col(date))).alias(date),
            F.max(F.when(now, F.col(value))).alias(value),
            F.max(F.when(then, F.col(value))).alias("_then"),
            F.count(F.when(then, 1)).alias("_n_then"),
        )
        .filter(F.col(date).isNotNull() & (F.col("_n_then") > 0))
    )
    change = F.col(value) - F.col("_then")
    return seen.select(
        date,
        key,
        value,
        F.col(f"_record.{date}").alias("RecordHighDate"),
        F.col(f"_record.{value}").alias("RecordHigh"),
        (F.col(value) - F.col(f"_record.{value}")).alias("FromHigh"),
        signed_label(change).alias("ChangeLast2Weeks"),
        trend_label(change).alias("TrendLast2Weeks"),
    )


def share_under(df: DataFrame, group: str, metric: str, threshold: float) -> DataFrame:
    """Per group: rows whose metric is below the threshold, all rows, and the share."""
    grouped = df.groupBy(group).agg(
        F.sum(F.when(F.col(metric) < threshold, 1).otherwise(0)).alias("under"), F.count(F.lit(1)).alias("total")
    )
    return grouped.withColumn("share", guarded_ratio(F.col("under"), F.col("total")))


FEATURE_TYPE = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "properties",
                            T.StructType(
                                [T.StructField("STATE", T.StringType()), T.StructField("COUNTY", T.StringType())]
                            ),
                        ),
                        T.StructField("geometry", T.StringType()),
                    ]
                )
            ),
        )
    ]
)


def features(documents: DataFrame, text: str = "value", key: str = "FIPS") -> DataFrame:
    """GeoJSON feature collections as one row per feature: key and geometry text.

    A collection is one JSON text and parsed by one task; its features spread from there.
    """
    parsed = documents.select(F.explode(F.from_json(F.col(text), FEATURE_TYPE)["features"]).alias("f"))
    return parsed.select(
        F.concat(F.col("f.properties.STATE"), F.col("f.properties.COUNTY")).alias(key), F.col("f.geometry").alias("geometry")
    )


def join_features(shapes: DataFrame, metrics: DataFrame, key: str) -> DataFrame:
    """Every feature with its metrics; ``has_info`` is false where there are none."""
    marked = metrics.withColumn("_seen", F.lit(True))
    joined = shapes.join(marked, key, "left")
    return joined.withColumn("has_info", F.coalesce(F.col("_seen"), F.lit(False))).drop("_seen")
