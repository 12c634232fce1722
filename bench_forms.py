"""Time panel operators against the self-join form of the same result, on supplier-days of the line items."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionpanel.operators.panel import doubling_time, earlier, rolling_calendar, series_windows
from regionpanel.session import local_session, settle
from regionpanel.starschema.tables import table

LAGS = (7, 14, 30)


def changes_by_window(panel: DataFrame) -> DataFrame:
    return panel.withColumns({f"c{k}": F.col("n") - earlier("n", "entity", "day", k) for k in LAGS})


def changes_by_join(panel: DataFrame) -> DataFrame:
    out = panel
    for k in LAGS:
        before = panel.select("entity", F.date_add("day", k).alias("day"), F.col("n").alias(f"n{k}"))
        out = out.join(before, ["entity", "day"], "left").withColumn(f"c{k}", F.col("n") - F.col(f"n{k}")).drop(f"n{k}")
    return out


def rolling_by_window(panel: DataFrame) -> DataFrame:
    return rolling_calendar(panel, "entity", "day", {"n": "n7"})


def rolling_by_join(panel: DataFrame) -> DataFrame:
    a, b = panel.alias("a"), panel.select("entity", "day", "n").alias("b")
    near = (F.col("b.day") > F.date_sub(F.col("a.day"), 7)) & (F.col("b.day") <= F.col("a.day"))
    joined = a.join(b, (F.col("a.entity") == F.col("b.entity")) & near)
    return joined.groupBy("a.entity", "a.day").agg((F.sum("b.n") / 7.0).alias("n7"))


def national_by_group(panel: DataFrame) -> DataFrame:
    days = panel.groupBy("day").agg(F.sum("n").alias("n"))
    return series_windows(days, "day", {"n": "n7"}, {"n": "n14"})


def national_by_join(panel: DataFrame) -> DataFrame:
    days = panel.groupBy("day").agg(F.sum("n").alias("n"))
    a, b = days.alias("a"), days.alias("b")
    near = F.col("b.day").between(F.date_sub(F.col("a.day"), 6), F.col("a.day"))
    return a.join(b, near).groupBy("a.day").agg(F.sum("b.n").alias("n7"))


def totals(panel: DataFrame) -> DataFrame:
    return panel.select(
        "entity", "day", F.expr("sum(n) over (partition by entity order by day)").alias("v")
    )


def doubling_by_window(panel: DataFrame) -> DataFrame:
    return doubling_time(totals(panel), "entity", "day", "v", non_decreasing=True)


def doubling_by_scan(panel: DataFrame) -> DataFrame:
    return doubling_time(totals(panel), "entity", "day", "v")


def doubling_by_join(panel: DataFrame) -> DataFrame:
    a, b = totals(panel).alias("a"), totals(panel).alias("b")
    half = (F.col("a.entity") == F.col("b.entity")) & (F.col("b.day") < F.col("a.day")) & (F.col("b.v") <= F.col("a.v") / 2)
    return a.join(b, half).groupBy("a.entity", "a.day").agg(F.max(F.struct("b.day", "b.v")).alias("half"))


FORMS = (
    changes_by_window,
    changes_by_join,
    rolling_by_window,
    rolling_by_join,
    national_by_group,
    national_by_join,
    doubling_by_window,
    doubling_by_scan,
    doubling_by_join,
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    # As at scale, where no side of these joins is small.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    lines = table(spark, sf_dir, "lineitem")
    panel = settle(
        lines.groupBy(F.col("l_suppkey").alias("entity"), F.to_date("l_shipdate").alias("day")).agg(
            F.count(F.lit(1)).alias("n")
        )
    )
    seconds = {"panel_rows": panel.count()}
    for form in FORMS:
        best = None
        for _ in range(3):
            began = time.perf_counter()
            form(panel).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            best = took if best is None else min(best, took)
        seconds[form.__name__] = round(best, 3)
    spark.stop()
    print(json.dumps(seconds))


if __name__ == "__main__":
    main()
