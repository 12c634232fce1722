"""Panel operators against brute force over the rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from regionpanel.operators import panel as P

D0 = dt.date(2020, 3, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def gaps(spark):
    """Entities with a missing day, a short history, a falling total, an unknown total and a zero base."""
    rows = [("gap", day(n), 10 * n) for n in range(12) if n != 4]
    rows += [("short", day(n), n) for n in range(3)]
    rows += [("fall", day(0), 9), ("fall", day(1), 4), ("fall", day(7), 20), ("fall", day(8), 2)]
    rows += [("null", day(0), None), ("null", day(1), 5), ("null", day(2), None), ("null", day(7), 8), ("null", day(9), 3)]
    rows += [("zero", day(0), 0), ("zero", day(7), 6), ("zero", day(14), 9)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "e string, d date, v long")


def test_daily_increment(spark, gaps):
    got = rows_of(P.daily_increment(frame(spark, gaps), "e", "d", {"v": "inc"}), "e", "d")
    at = {(e, d): v for e, d, v in gaps}
    for e, d, v, inc in got:
        before = at.get((e, d - dt.timedelta(days=1))) or 0
        assert inc == (None if v is None else max(v - before, 0))


def test_rolling_rows_and_calendar_differ_over_gaps(spark, gaps):
    df = frame(spark, gaps)
    both = P.rolling_calendar(P.rolling_rows(df, "e", "d", {"v": "by_rows"}), "e", "d", {"v": "by_days"})
    for e, d, _, by_rows, by_days in rows_of(both, "e", "d"):
        mine = sorted((x for x in gaps if x[0] == e and x[1] <= d), key=lambda x: x[1])
        last = [x[2] for x in mine[-7:] if x[2] is not None]
        assert by_rows == (pytest.approx(sum(last) / len(last)) if last else None)
        near = [x[2] for x in mine if (d - x[1]).days < 7 and x[2] is not None]
        assert by_days == (pytest.approx(sum(near) / 7) if near else None)


@pytest.mark.parametrize("null_as_zero", [True, False])
@pytest.mark.parametrize("days", [7, 14])
def test_calendar_change(spark, gaps, days, null_as_zero):
    got = rows_of(P.calendar_change(frame(spark, gaps), "e", "d", "v", days, null_as_zero=null_as_zero), "e", "d")
    at = {(e, d): v for e, d, v in gaps}
    want = []
    for (e, d), v in sorted(at.items()):
        if (e, d - dt.timedelta(days=days)) not in at:
            continue
        was = at[e, d - dt.timedelta(days=days)]
        start = 0 if was is None and null_as_zero else was
        change = None if v is None or start is None else v - start
        pct = (v - was) / was if v is not None and was else None
        want.append((e, d, v, change, pct))
    assert got == want
    # An unknown earlier value is not the same as a missing row.
    if days == 7 and null_as_zero:
        assert ("null", day(7), 8, 8, None) in got


def test_window_form_equals_self_join(spark):
    rng = random.Random(5)
    rows = [(f"e{e}", day(n), rng.randrange(50)) for e in range(6) for n in range(120) if rng.random() < 0.7]
    df = frame(spark, rows).repartition(7)
    a = df.alias("a").join(
        df.alias("b"), (F.col("a.e") == F.col("b.e")) & (F.date_sub(F.col("a.d"), 30) == F.col("b.d"))
    )
    joined = sorted((r.e, r.d, r.v, r.c) for r in a.select("a.e", "a.d", "a.v", (F.col("a.v") - F.col("b.v")).alias("c")).collect())
    got = sorted(tuple(r)[:4] for r in P.calendar_change(df, "e", "d", "v", 30).collect())
    assert got == joined


def test_dedupe(spark):
    rows = [("a", 1, 5, 1, "x"), ("a", 1, 7, 0, "y"), ("a", 2, 5, 1, "x"), ("a", 2, 5, 3, "y"), ("b", 1, 1, 1, "x"), ("b", 1, 1, 1, "y")]
    df = spark.createDataFrame(rows, "k string, d int, c long, x long, t string")
    order = [F.col("c").desc(), F.col("x").desc(), F.col("t")]
    got = rows_of(P.dedupe(df, ["k", "d"], order), "k", "d")
    assert got == [("a", 1, 7, 0, "y"), ("a", 2, 5, 3, "y"), ("b", 1, 1, 1, "x")]
    assert rows_of(P.dedupe(df.orderBy(F.rand(3)), ["k", "d"], order), "k", "d") == got


def test_entities_with_data(spark):
    rows = [("zero", 0, 0), ("null", None, None), ("deaths", 0, 2), ("both", 1, 1), ("cancel", 1, 0), ("cancel", -1, 0)]
    df = spark.createDataFrame(rows, "k string, a long, b long")
    kept = P.entities_with_data(df, "k", ["a", "b"])
    assert rows_of(kept, "k") == [("both",), ("deaths",)]
    assert {r.k for r in P.keep_entities(df, kept, "k").collect()} == {"both", "deaths"}


def test_lagged_pair_both_ways(spark):
    df = spark.createDataFrame([("a", day(n), n, 100 + n) for n in range(4)], "e string, d date, x long, y long")
    assert rows_of(P.lagged_pair(df, "e", "d", "x", "y", 2), "d") == [("a", day(0), 0, 102), ("a", day(1), 1, 103)]
    assert rows_of(P.lagged_pair(df, "e", "d", "x", "y", -2), "d") == [("a", day(2), 2, 100), ("a", day(3), 3, 101)]


def test_series_windows(spark):
    rng = random.Random(2)
    rows = [(day(n), rng.randrange(100), rng.choice([None, 3, 4])) for n in range(40) if n not in (5, 6, 7, 8, 20)]
    df = spark.createDataFrame(rows, "d date, v long, w long")
    got = rows_of(P.series_windows(df, "d", {"v": "v7", "w": "w7"}, {"v": "v14"}), "d")
    at = {r[0]: r for r in rows}
    for d, v, w, v7, w7, v14 in got:
        assert (v, w) == at[d][1:]
        near = [at[x] for x in (d - dt.timedelta(days=k) for k in range(7)) if x in at]
        assert v7 == sum(r[1] for r in near)
        known = [r[2] for r in near if r[2] is not None]
        assert w7 == (sum(known) if known else None)
        was = at.get(d - dt.timedelta(days=14))
        assert v14 == (was[1] if was else None)
    assert len(got) == len(rows)


def doubling_by_pairs(rows):
    out = []
    for e, d, c in rows:
        if c is None:
            continue
        past = [(d1, c1) for e1, d1, c1 in rows if e1 == e and d1 < d and c1 is not None and c1 <= c / 2]
        if past:
            d1, c1 = max(past)
            per_day = (c - c1) / (d - d1).days
            out.append((e, d, round(c / per_day / 2, 2) if per_day else None))
    return sorted(out)


def assert_doubling(got, want):
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert (g[2] is None) == (w[2] is None)
        assert g[2] is None or g[2] == pytest.approx(w[2], abs=0.0101)


@pytest.mark.parametrize("non_decreasing", [True, False])
def test_doubling_time_of_totals(spark, non_decreasing):
    rng = random.Random(9)
    rows = []
    for e in range(5):
        total = 0
        for n in range(80):
            total += rng.choice([0, 0, 0, 1, 5, 30])
            if rng.random() < 0.9:
                rows.append((f"e{e}", day(n), total))
    rows += [("flat", day(n), 7) for n in range(5)] + [("zeros", day(n), 0) for n in range(4)]
    got = P.doubling_time(frame(spark, rows), "e", "d", "v", "t", non_decreasing=non_decreasing)
    assert_doubling(sorted(tuple(r) for r in got.collect()), doubling_by_pairs(rows))


def test_doubling_time_of_falling_series(spark):
    rng = random.Random(4)
    rows = [(f"e{e}", day(n), rng.choice([None, 0, 1, 2, 5, 9, 20, 41])) for e in range(6) for n in range(60)]
    got = P.doubling_time(frame(spark, rows), "e", "d", "v", "t")
    assert_doubling(sorted(tuple(r) for r in got.collect()), doubling_by_pairs(rows))


@pytest.mark.parametrize("days", [1, 7, 90])
def test_wide_series_windows_send_three_rows_out_of_one(spark, days):
    rng = random.Random(days)
    rows = [(day(n), rng.choice([None, 0.1, 2.7, 1e9 / 3])) for n in range(200) if rng.random() < 0.6]
    df = spark.createDataFrame(rows, "d date, v double").repartition(5)
    out = P.series_windows(df, "d", {"v": "s"}, {"v": "late"}, days, 10)
    at = dict(rows)
    for d, v, s, late in rows_of(out, "d"):
        known = [at[x] for x in (d - dt.timedelta(days=k) for k in range(days)) if at.get(x) is not None]
        assert (s is None) == (not known) and (not known or s == pytest.approx(sum(known)))
        assert (v, late) == (at[d], at.get(d - dt.timedelta(days=10)))
    assert out.count() == len(rows)
    plan = out._jdf.queryExecution().analyzed().toString()
    # Three rows out of one, in each of the two branches of the running totals.
    assert plan.count("explode(array(struct") == plan.count("explode") == 2
