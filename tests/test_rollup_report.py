"""Groupings, reports, ranks and statistics on small fixtures."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from regionpanel.operators import ranks, report, rollup, stats

D0 = dt.date(2020, 3, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_pivot_rate(spark):
    rows = [("a", 1, "Negative", 6), ("a", 1, "Positive", 2), ("a", 1, "Positive", 2), ("a", 1, "Other", 99)]
    rows += [("b", 1, "Negative", 3), ("c", 1, "Positive", 0), ("c", 1, "Negative", 0), ("d", 1, "Other", 1)]
    df = spark.createDataFrame(rows, "s string, d int, o string, v long")
    names = {"Negative": "neg", "Positive": "pos", "Inconclusive": "inc"}
    got = rows_of(rollup.pivot_rate(df, ["s", "d"], "o", "v", names, "pos"), "s")
    assert got == [
        ("a", 1, 6, 4, None, 10, 0.4),
        ("b", 1, 3, None, None, 3, None),
        ("c", 1, 0, 0, None, 0, 0.0),
        ("d", 1, None, None, None, 0, 0.0),
    ]


def test_share_of_total(spark):
    rows = [(1, "x", 1), (1, "x", 0), (1, None, 1), (1, "y", 0), (2, "x", 0), (None, "x", 1)]
    df = spark.createDataFrame(rows, "w int, c string, f int")
    got = {(r.w, r.c): r for r in rollup.share_of_total(df, "w", "c", {"f": "dead"}, ["cases", "dead"]).collect()}
    assert (got[1, "x"].cases, got[1, "x"].cases_total, got[1, "x"].cases_pct, got[1, "x"].dead_pct) == (2, 4, 0.5, 0.5)
    assert got[1, None].dead_pct == 0.5
    assert got[2, "x"].dead_pct is None
    assert (got[None, "x"].cases_total, got[None, "x"].cases_pct) == (None, None)
    assert sum(r.cases_pct for k, r in got.items() if k[0] == 1) == pytest.approx(1)


def test_bucket_sum_with_overlapping_ends(spark):
    df = spark.createDataFrame([("a", day(n), 1) for n in range(20)] + [("a", day(3), 5)], "k string, d date, v long")
    ends = spark.createDataFrame([(day(6),), (day(6),), (day(9),), (day(40),)], "e date")
    got = rows_of(rollup.bucket_sum(df, ends, "k", "d", "v", "e", "t"), "e")
    assert got == [("a", day(6), 12), ("a", day(9), 12)]


def test_yoy_and_excess(spark):
    weeks = [("a", 1, {2017: 10, 2018: 20, 2019: 30, 2020: 60, 2021: 40}), ("b", 1, {2019: 5}), ("c", 1, {2019: 5, 2020: 6}), ("d", 1, {2020: 7, 2021: 8})]
    rows = [(s, y, w, dt.date(y, 1, 7), v) for s, w, years in weeks for y, v in years.items()]
    df = spark.createDataFrame(rows, "s string, y int, w int, e date, v long")
    assert rows_of(rollup.yoy_weeks(df, "s", "y", "w", "v", 2019), "s") == [("a", 1, 30, 60, 40), ("c", 1, 5, 6, None)]
    names = {"baseline": "avg", "value": "v", "end": "e", "excess": "x", "pct": "p"}
    got = {r.s: r for r in rollup.excess_over_baseline(df, "s", "y", "w", "e", "v", 2019, names).collect()}
    assert set(got) == {"a", "c"}
    assert (got["a"].avg, got["a"].x2020, got["a"].p2020, got["a"].x2021, got["a"].p2021) == (20.0, 40.0, 200.0, 20.0, 100.0)
    assert (got["c"].x2021, got["c"].e2021, got["c"].e2020) == (-5.0, None, dt.date(2020, 1, 7))


def test_prior_year_delta_skips_gaps(spark):
    df = spark.createDataFrame([(2014, 10.0), (2015, 15.0), (2017, 30.0)], "y int, v double")
    assert rows_of(rollup.prior_year_delta(df, "y", "v"), "y") == [(2015, 15.0, 10.0, 50.0)]


def test_with_total(spark):
    rows = [("AS", 1, 5), ("OH", 1, 2), ("TX", 1, 3), ("TX", 2, -1), ("OH", 2, None), ("OH", 3, 0)]
    df = spark.createDataFrame(rows, "s string, d int, v long")
    got = rows_of(rollup.with_total(df, "s", "d", ["v"], "US", "v", ["AS"]), "d", "s")
    assert got == [("OH", 1, 2), ("TX", 1, 3), ("US", 1, 5), ("OH", 3, 0), ("US", 3, 0)]


def test_patch_group(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "k string, v long")
    assert rows_of(rollup.patch_group(df, "k", "v", "a", ["a", "b", "c"]), "k") == [("a", 6), ("b", 2), ("c", 3), ("d", 4)]
    assert rows_of(rollup.patch_group(df, "k", "v", "a", ["z"]), "k")[0] == ("a", 1)


def test_top_k_ranks_unknown_as_zero(spark):
    rows = [(i, float(i % 50)) for i in range(1, 150)] + [(200, None), (201, -3.0), (202, 0.0)]
    df = spark.createDataFrame(rows, "i int, m double")
    got = [r.i for r in report.top_k(df, "m", ["i"], 151).collect()]
    assert got[:3] == [49, 99, 149]
    assert got[-4:] == [50, 100, 200, 202]
    assert len(report.top_k(df, "m", ["i"]).collect()) == 100


def test_trailing_days_and_latest(spark):
    df = spark.createDataFrame([("a", day(n)) for n in range(40)] + [("b", day(5))], "k string, d date")
    assert report.trailing_days(df, "d", 28).count() == 29
    assert rows_of(report.latest_day(df, "d"), "k") == [("a", day(39))]
    other = spark.createDataFrame([(day(45),)], "d date")
    assert report.trailing_days(df, "d", 10, of=other).count() == 5


def test_recent_points(spark):
    df = spark.createDataFrame([("a", day(n), n) for n in range(20)] + [("b", day(1), 7)], "k string, d date, v long")
    got = {r.k: [p.v for p in r.points] for r in report.recent_points(df.repartition(5), "k", "d", ["v"], 15).collect()}
    assert got == {"a": list(range(5, 20)), "b": [7]}


def test_latest_nonnull(spark):
    rows = [("a", day(0), 0.5), ("a", day(1), 0.2), ("a", day(2), 0.0), ("a", day(3), None)]
    rows += [("first", day(0), 0.9), ("first", day(1), 0.0), ("none", day(0), None)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    assert rows_of(report.latest_nonnull(df, "k", "d", "v"), "k") == [("a", day(1), 0.2)]


def test_first_last(spark):
    df = spark.createDataFrame([([2.0, 9.0, 3.0],), ([0.0, 4.0],), ([],), ([5.0],)], "a array<double>")
    got = [tuple(r) for r in df.select(report.first_last_change(F.col("a")), report.first_last_pct(F.col("a"))).collect()]
    assert got == [(1.0, 0.5), (4.0, None), (None, None), (0.0, 0.0)]


def test_record_high(spark):
    rows = [("a", day(0), 9), ("a", day(3), 9), ("a", day(6), 2), ("a", day(20), 5)]
    rows += [("b", day(6), 1), ("b", day(20), 4), ("c", day(20), 4), ("d", day(6), 4), ("e", day(6), None), ("e", day(20), 4)]
    df = spark.createDataFrame(rows, "k string, d date, v long")
    got = {r.k: tuple(r)[3:] for r in report.record_high(df, "k", "d", "v").collect()}
    assert got == {
        "a": (day(3), 9, -4, "+3", "Trending Up"),
        "b": (day(20), 4, 0, "+3", "Trending Up"),
        "e": (day(20), 4, 0, None, "Trending Down"),
    }


def test_share_under(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 25.0), ("a", None), ("b", 30.0)], "g string, m double")
    assert rows_of(report.share_under(df, "g", "m", 25), "g") == [("a", 1, 3, 1 / 3), ("b", 0, 1, 0.0)]


def test_join_features(spark):
    text = '{"type":"FeatureCollection","features":[{"properties":{"STATE":"39","COUNTY":"001","NAME":"Adams"},"geometry":{"type":"Point"}},{"properties":{"STATE":"39","COUNTY":"003"},"geometry":null}]}'
    shapes = report.features(spark.createDataFrame([(text,)], "value string"))
    metrics = spark.createDataFrame([("39001", 4)], "FIPS string, n int")
    got = rows_of(report.join_features(shapes, metrics, "FIPS"), "FIPS")
    assert got == [("39001", '{"type":"Point"}', 4, True), ("39003", None, None, False)]


def test_global_position(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([1, 1, 1, 1, 2, 3])) for i in range(2000)]
    df = spark.createDataFrame(rows, "i int, v int").repartition(9)
    got = {r.i: r.position for r in ranks.global_position(df, [F.col("v").desc(), F.col("i")]).collect()}
    want = {i: n for n, (i, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), start=1)}
    assert got == want


@pytest.mark.parametrize("values", [[5], [1, 2], [3, 3, 3, 9], list(range(11)), [7] * 400 + list(range(101))])
def test_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    got = ranks.quantiles(df, "v", {"q0": 0.0, "q20": 0.2, "q90": 0.9, "q100": 1.0}, "mid").first()
    ordered = sorted(values)
    for name, q in (("q0", 0.0), ("q20", 0.2), ("q90", 0.9), ("q100", 1.0)):
        assert got[name] == ordered[max(math.ceil(round(q * len(ordered), 9)), 1) - 1]
    assert got["mid"] == pytest.approx(np.median(values))


def test_rank_panels(spark):
    rows = [(f"e{i:02d}", day(n), (i * 7) % 25 if n else 3) for i in range(25) for n in range(2)] + [("gone", day(0), 99)]
    df = spark.createDataFrame(rows, "k string, d date, v int")
    got = {(r.k, r.panel) for r in ranks.rank_panels(df, "k", "d", "v").collect()}
    order = sorted((f"e{i:02d}" for i in range(25)), key=lambda k: (-((int(k[1:]) * 7) % 25), k))
    assert got == {(k, n // 10) for n, k in enumerate(order)}


def test_corr_by(spark):
    rows = [(1, 1.0, 2.0), (1, 2.0, 4.0), (1, 3.0, 6.5), (1, None, 9.0), (2, 1.0, 5.0), (2, 1.0, 7.0), (3, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "d int, a double, b double")
    got = dict(rows_of(stats.corr_by(df, "d", "a", "b"), "d"))
    assert got[1] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1])
    assert got[2] is None and got[3] is None


def test_corr_matrix_and_line(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"a": rng.random(50), "b": rng.random(50)})
    pdf["c"] = pdf.a * 3 + 1
    df = spark.createDataFrame(pdf)
    got = {(r.x, r.y): r["corr"] for r in stats.corr_matrix(df, ["a", "b", "c"]).collect()}
    for (x, y), v in got.items():
        assert v == pytest.approx(pdf[x].corr(pdf[y]))
    line = stats.fit_line(df, "a", "c").first()
    assert (line.points, line.slope, line.intercept) == (50, pytest.approx(3), pytest.approx(1))
    logs = stats.log1p_columns(df, ["a"]).first()
    assert logs.a == pytest.approx(math.log1p(pdf.a[0]))


def test_histogram_follows_numpy(spark):
    values = [0.0, 99.9, 100.0, 150.0, 999.0, 1000.0, 1000.1, -1.0, 500.0]
    edges = list(range(0, 1001, 100))
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = [r.n for r in stats.histogram(df, "v", edges).orderBy("bin").collect()]
    assert got == list(np.histogram(values, edges)[0])


@pytest.mark.parametrize("values", [[1.0, 11.0, 4.0], [5.0, 5.0], [0.0], [-3.0, -3.0]])
def test_equal_width_edges_follow_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.edge for r in stats.equal_width_edges(df, "v", 5).orderBy("edge_no").collect()]
    assert got == pytest.approx(list(pd.cut(pd.Series(values), 5, retbins=True)[1]))


def test_case_histogram_agrees_with_edges(spark):
    from regionpanel.functions import upper_limit

    rng = random.Random(3)
    df = spark.createDataFrame([(rng.randrange(1, 1000),) for _ in range(500)], "v long")
    by_label = dict(rows_of(df.groupBy(upper_limit(F.col("v")).alias("u")).count(), "u"))
    # The labels include their upper limit, the bins their lower one.
    by_bin = {int(r.bin_to): r.n for r in stats.histogram(df.select((F.col("v") - 1).alias("v")), "v", range(0, 1001, 100)).collect()}
    assert by_label == {k: n for k, n in by_bin.items() if n}

TIED = {
    "two": [0] * 5000 + [1] * 5000,
    "two, odd": [0] * 5000 + [1] * 5001,
    "three": [1] * 3000 + [2] * 4000 + [7] * 3000,
    "nearly one": [5] * 1900 + list(range(20)),
        "distinct": [(i * 7919) % 100_003 for i in range(2_000)],
    "few": [4, 1, 4],
}


@pytest.mark.parametrize("kind", sorted(TIED))
@pytest.mark.parametrize(("cuts", "pick"), [(20, 1), (100, 150)])
def test_quantiles_end_on_ties(spark, kind, cuts, pick):
    values = TIED[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(4)
    probs = {"q0": 0.0, "q1": 0.01, "q30": 0.3, "q49": 0.4999, "q50": 0.5, "q51": 0.5001, "q99": 0.99, "q100": 1.0}
    got = ranks.quantiles(df, "v", probs, "mid", cuts=cuts, pick=pick).first()
    order = np.sort(values)
    assert [got[k] for k in probs] == [order[max(math.ceil(q * len(order)), 1) - 1] for q in probs.values()]
    assert got.mid == np.median(values)


def test_quantiles_of_all_ranks_take_one_job_a_round(spark):
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("v"))
    group = "quantile-rounds"
    spark.sparkContext.setJobGroup(group, group)
    try:
        ranks.quantiles(df, "v", {f"q{i}": i / 10 for i in range(11)}, "mid").first()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Three passes and the collecting of the row; adaptive execution makes every shuffle a job of its own.
    assert jobs <= 9


@pytest.mark.parametrize("days", [1, 7, 90])
def test_bucket_sums_of_any_width(spark, days):
    rng = random.Random(days)
    rows = [(rng.choice(["a", "b", None]), day(rng.randrange(300)), rng.choice([None, 1, 5, -2])) for _ in range(400)]
    rows += [("c", day(2), None), ("d", None, 3)]
    df = spark.createDataFrame(rows, "k string, d date, v long").repartition(5)
    last = [day(n) for n in {rng.randrange(320) for _ in range(40)}]
    ends = spark.createDataFrame([(x,) for x in [*last, last[0], None]], "e date")
    for column, same in ((df, lambda a, b: a == b), (df.withColumn("v", F.col("v") / 3), lambda a, b: a == pytest.approx(b / 3, abs=1e-9))):
        got = {(r.k, r.e): r.t for r in rollup.bucket_sum(column, ends, "k", "d", "v", "e", "t", days).collect()}
        want = {}
        for k, d, v in rows:
            for e in last:
                if d is not None and e - dt.timedelta(days=days) < d <= e:
                    want.setdefault((k, e), []).append(v)
        assert got.keys() == want.keys()
        for at, values in want.items():
            known = [v for v in values if v is not None]
            assert (got[at] is None) if not known else same(got[at], sum(known)), at
