"""Column helpers on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from regionpanel import functions as fn


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_clean_name():
    assert [fn.clean_name(n) for n in (" All Cause", "All  Cause", "﻿state", "a-b.c")] == [
        "All_Cause",
        "All__Cause",
        "state",
        "a_b_c",
    ]


@pytest.mark.parametrize(
    "country, county, province, flag",
    [
        ("US", None, "Ohio", 1),
        ("US", "Unassigned", "Ohio", 0),
        ("US", "Unknown", "Ohio", 0),
        ("US", "Out of AL", "Alabama", 0),
        ("US", "Out-of-AL", "Alabama", 0),
        ("US", "Adams", "Recovered", 0),
        ("US", "Adams", None, 0),
        ("Canada", "Adams", "Ohio", 0),
        (None, "Adams", "Ohio", 0),
    ],
)
def test_placeable(spark, country, county, province, flag):
    got = one(spark, [(country, county, province)], "a string, b string, c string", fn.is_placeable(F.col("a"), F.col("b"), F.col("c")))
    assert got == [(flag,)]


def test_repair_code(spark):
    rows = [("1001", 1), ("1001.0", 1), ("01001", 1), ("", 1), (None, 1), ("123456", 1), ("1001", 0)]
    got = one(spark, rows, "c string, f int", fn.repair_code(F.col("c"), F.col("f")))
    assert [g[0] for g in got] == ["01001", "01001", "01001", "", None, None, "1001"]


def test_numeric_text_rounds_half_away(spark):
    rows = [("12",), ("12.0",), ("2.5",), ("-2.5",), ("2.7",), (None,), ("x",), ("",)]
    got = one(spark, rows, "c string", fn.numeric_text(F.col("c")))
    assert [g[0] for g in got] == [12, 12, 3, -3, 3, None, None, None]


def test_parse_date(spark):
    rows = [("20200322",), ("03/05/2020",), ("2020/03/05",), ("1/4/2015",), ("01/10/2015",), ("01/04/2020",), ("no",), (None,)]
    got = one(spark, rows, "c string", fn.parse_date(F.col("c"), ("yyyyMMdd", "M/d/yyyy", "yyyy/MM/dd")))
    d = dt.date
    want = [d(2020, 3, 22), d(2020, 3, 5), d(2020, 3, 5), d(2015, 1, 4), d(2015, 1, 10), d(2020, 1, 4), None, None]
    assert [g[0] for g in got] == want


def test_week_parts_at_year_edges(spark):
    days = ["2020-12-31", "2021-01-01", "2021-01-02", "2021-01-03", "2022-12-31", "2023-01-01"]
    d = F.col("d").cast("date")
    got = one(spark, [(x,) for x in days], "d string", fn.week_number(d), fn.week_ending(d).cast("string"))
    assert [g[0] for g in got] == [52, 0, 0, 1, 52, 1]
    assert [g[1] for g in got] == ["2021-01-02", "2021-01-02", "2021-01-02", "2021-01-09", "2022-12-31", "2023-01-07"]
    assert [int(dt.date.fromisoformat(x).strftime("%U")) for x in days] == [g[0] for g in got]


def test_ratios(spark):
    rows = [(10, 4), (4, 10), (None, 4), (10, None), (10, 0)]
    a, b = F.col("a"), F.col("b")
    got = one(
        spark, rows, "a long, b long", fn.increase_since(a, b), fn.guarded_ratio(a, b), fn.change_pct(a, b),
        fn.rate_per(a - b, b), fn.rate_per(a - b, b, clamp=True), fn.clamp_zero(a - b),
    )
    assert [g[0] for g in got] == [6, 0, None, 10, 10]
    assert [g[1] for g in got] == [2.5, 0.4, None, None, None]
    assert [g[2] for g in got] == [1.5, -0.6, None, None, None]
    assert [g[3] for g in got] == [150000.0, -60000.0, None, None, None]
    assert [g[4] for g in got] == [150000.0, 0.0, 0.0, 0.0, 0.0]
    assert [g[5] for g in got] == [6, 0, None, None, 10]


def test_rate_change(spark):
    rows = [(30.0, 20.0), (30.0, 0.0), (30.0, None), (None, 20.0)]
    a, b = F.col("a"), F.col("b")
    got = one(spark, rows, "a double, b double", fn.rate_change(a, b), fn.rate_change_pct(a, b))
    assert got == [(10.0, 0.5), (30.0, None), (30.0, None), (-20.0, -1.0)]


def test_yes_flag_and_labels(spark):
    rows = [("Yes", 0.12345), ("No", -0.5), ("Missing", 0.0), (None, None)]
    v = F.col("v")
    got = one(
        spark, rows, "c string, v double", fn.yes_flag(F.col("c")), fn.percent_label(v), fn.percent_label(v, signed=True),
        fn.trend_label(v), fn.signed_label(F.floor(v * 100)),
    )
    assert [g[0] for g in got] == [1, 0, 0, 0]
    assert [g[1] for g in got] == ["12.35%", "-50.00%", "0.00%", None]
    assert [g[2] for g in got] == ["+12.35%", "-50.00%", "0.00%", None]
    assert [g[3] for g in got] == ["Trending Up", "Trending Down", "Trending Down", "Trending Down"]
    assert [g[4] for g in got] == ["+12", "-50", "0", None]


def test_buckets(spark):
    rates = [24.99, 25.0, 50.0, 50.01, 75.0, 100.0, 200.0, 500.0, 1000.0, 1000.01, None]
    r = F.col("r")
    got = one(spark, [(x,) for x in rates], "r double", fn.reaches(r), fn.shade_bucket(r))
    assert [g[0] for g in got] == [False] + [True] * 9 + [False]
    assert [g[1] for g in got] == [None, 50, 50, 75, 75, 100, 200, 500, 1000, 10000000, None]


def test_trend_bucket(spark):
    rows = [(-1.0, -1.0), (-1.0, -1.01), (-1.0, -0.25), (0.0, 0.0), (1.0, 0.25), (1.0, 1.0), (1.0, 1.01), (1.0, None), (-1.0, None), (None, None)]
    got = one(spark, rows, "d double, p double", fn.trend_bucket(F.col("d"), F.col("p")))
    assert [g[0] for g in got] == ["down4", "none", "down1", "none", "up1", "up4", "up5", "up1", "down1", "none"]


def test_size_band_and_radius(spark):
    got = one(spark, [(29999,), (30000,), (90000,), (90001,), (None,)], "p long", fn.size_band(F.col("p")))
    assert [g[0] for g in got] == ["small", "medium", "medium", "large", "small"]
    metric = [100.0, 0.0, None, -5.0, 0.00000001]
    got = one(spark, [(m,) for m in metric], "m double", fn.bubble_radius(F.col("m"), 0.05))
    assert [g[0] for g in got] == [int((100 * 0.05 * 2589988 / 3.14) ** 0.5), None, None, None, None]


def test_upper_limit(spark):
    values = [None, 0, 1, 100, 101, 1000, 1001, 10001]
    got = one(spark, [(v,) for v in values], "v long", fn.upper_limit(F.col("v")))
    assert [g[0] for g in got] == [0, 0, 100, 100, 200, 1000, 5000, 100000]


def test_outbreak_direction(spark):
    rows = [(True, 1.0), (True, 0.0), (True, None), (False, 1.0)]
    got = one(spark, rows, "f boolean, c double", fn.outbreak_direction(F.col("f"), F.col("c")))
    assert [g[0] for g in got] == ["up", "down", "down", "none"]


def test_intermediate_tables_go_at_the_end_of_a_run(spark):
    from pathlib import Path

    from regionpanel.session import new_folder, scratch, settle

    with scratch(spark) as run:
        df = settle(spark.range(5))
        assert df.count() == 5
        with scratch(spark) as inner:
            assert settle(spark.range(3)).count() == 3 and inner.startswith(run)
        local = Path(run.removeprefix("file:"))
        assert len(list(local.iterdir())) == 1
    assert not local.exists() and not new_folder(spark, "x").startswith(run)
    try:
        with scratch(spark) as failed:
            settle(spark.range(5))
            raise RuntimeError
    except RuntimeError:
        pass
    assert not Path(failed.removeprefix("file:")).exists()
