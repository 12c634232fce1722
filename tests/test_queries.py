"""Every registered query against its SQL in DuckDB, and the shape of the plans."""

import os
import re

import pytest

from regionpanel.starschema import QUERIES, SQL

from .oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# Too sparse at the smallest scale: hardly a nation has a row a week or a month before another.
SPARSE = {"trailing_rates", "rising_fast_counts", "outbreak_circles"}
LARGER_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    sf_dir = LARGER_DIR if name in SPARSE else SF_DIR
    problem = compare(spark, connect(sf_dir), name, QUERIES[name], SQL[name], sf_dir)
    assert not problem, problem


def test_entry(spark):
    import __spark_entry__ as contract

    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert contract.entry(spark).count() > 0


def plan_of(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["panel_progress", "national_series", "excess_over_baseline", "interval_bucket_sum", "doubling_time", "share_of_total"])
def test_no_nested_loops_or_single_task_windows(spark, name):
    plan = plan_of(spark, name)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "SinglePartition" not in re.sub(r"(?s)Subquery.*", "", plan)


def test_progress_sorts_and_shuffles_the_panel_once(spark):
    plan = plan_of(spark, "panel_progress")
    # Five windows share one shuffle and sort of the panel by code; joining the dimension may add one of each.
    assert plan.count("Window [") == 5
    assert len(re.findall(r"Exchange hashpartitioning\(FIPS", plan)) <= 2
    assert len(re.findall(r"Sort \[FIPS[^,]*, Date", plan)) <= 2


def test_all_views_are_ranked_in_one_pass(spark):
    plan = plan_of(spark, "outbreak_views")
    assert plan.count("FileScan parquet") == 1 and plan.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" not in plan


def test_repeats_go_before_the_shuffle(spark):
    plan = plan_of(spark, "dedupe_keep_max")
    assert plan.count("WindowGroupLimit") == 2


def test_only_needed_columns_are_read(spark):
    plan = plan_of(spark, "share_of_total")
    assert re.search(r"ReadSchema: struct<l_returnflag:string,l_linestatus:string,l_shipdate:timestamp_ntz>", plan)


def test_customer_with_a_third_of_all_orders_is_split(spark, tmp_path):
    from pyspark.sql import functions as F

    from regionpanel.starschema.tables import nation_day, table

    # Thresholds lowered to the size of the test, broadcast off as for a customer table too large for it.
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    orders = table(spark, LARGER_DIR, "orders").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(30))))
    hot = F.when(F.col("copy") <= 11, F.lit(7).cast("long")).otherwise(F.col("o_custkey"))
    orders.withColumn("o_custkey", hot).drop("copy").repartition(16).write.parquet(f"{tmp_path}/orders.parquet")
    for name in ("customer", "nation"):
        table(spark, LARGER_DIR, name).write.parquet(f"{tmp_path}/{name}.parquet")
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        days = nation_day(spark, str(tmp_path))
        total = sum(r.n for r in days.collect())
        plan = days._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert total == 15000 * 30
    assert "SortMergeJoin(skew=true)" in plan


def test_dirty_orders_are_written_side_by_side(spark, tmp_path, monkeypatch):
    from regionpanel.starschema import source_queries

    monkeypatch.setattr(source_queries, "new_folder", lambda spark, label: f"{tmp_path}/{label}")
    got = QUERIES["reject_counts"](spark, SF_DIR).first()
    files = [f.read_text().split("\n") for f in (tmp_path / "dirty").rglob("*.txt")]
    assert len(files) > 1 and all(f[0].startswith("order key\t") for f in files)
    assert sum(len(f) - 2 for f in files) == got.delivered
