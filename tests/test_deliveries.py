"""Only what has changed is read and written, bad records are set aside, and a build that dies leaves tables whole."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from regionpanel import sinks, sources
from regionpanel.plans import build as plan
from regionpanel.plans.build import build
from regionpanel.sinks import pointer, publish, read_table, versions
from regionpanel.sources import Contract

FIRST = dt.date(2020, 3, 22)
HEAD = "FIPS,Admin2,Province_State,Country_Region,Last_Update,Lat,Long_,Confirmed,Deaths,Recovered,Active,Combined_Key"
COUNTY = ("county_clean", "county_totals", "county_daily", "county_base", "county_progress")


def write_day(folder, n, extra=()):
    day = FIRST + dt.timedelta(days=n)
    rows = [("01001", "Autauga", "Alabama", 10 * n + n % 3, n), ("36061", "New York City", "New York", 100 * n, 2 * n), *extra]
    # One reports seldom, so that a mean of seven rows reaches over months, one never has anything.
    if n % 23 == 4:
        rows.append(("35013", "Seldom", "New Mexico", 5 * n, 1))
    rows.append(("01003", "Baldwin", "Alabama", 0, 0))
    lines = [f'{c},{a},{s},US,,1.5,-2.5,{x},{d},0,,"{a}, {s}, US"' for c, a, s, x, d in rows]
    path = folder / day.strftime("%m-%d-%Y.csv")
    path.write_text("\n".join([HEAD, *lines]) + "\n")
    return path


def places(root):
    (root / "county_pop.csv").write_text("STNAME,CTYNAME,STATE,COUNTY,POPESTIMATE2019\nAlabama,Autauga,01,001,1000\nAlabama,Baldwin,01,003,90\nNew York,New York,36,061,500\nNew Mexico,Seldom,35,013,70\n")
    (root / "state_pop.csv").write_text("NAME,STATE,POPESTIMATE2019\nUnited States,0,9999\nAlabama,1,2000\nNew York,36,5000\nNew Mexico,35,300\n")
    (root / "survey.json").write_text(json.dumps([["CP03_2014_2018_062E", "CP05_2014_2018_018E", "state", "county"], ["50000", "38.5", "01", "001"]]))
    return {"county_population": str(root / "county_pop.csv"), "state_population": str(root / "state_pop.csv"), "county_survey": str(root / "survey.json")}


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def same_as_a_full_build(spark, paths, tables, folder):
    full = build(spark, paths, str(folder))
    assert set(full) == set(tables)
    for name in full:
        assert rows_of(tables[name]) == rows_of(full[name]), name


def spoil(path):
    """Other content of the same size and time: whoever reads the file again sees it."""
    at = path.stat()
    path.write_bytes(b"x" * at.st_size)
    os.utime(path, ns=(at.st_atime_ns, at.st_mtime_ns))


def parts(out, name):
    return {m: v for m, v in pointer_of(out, name).parts.items()}


def pointer_of(out, name):
    from pyspark.sql import SparkSession

    return pointer(SparkSession.active(), f"{out}/tables/{name}")


@pytest.fixture
def delivered(tmp_path):
    daily = tmp_path / "daily"
    daily.mkdir()
    for n in range(100):
        write_day(daily, n)
    return daily, {"county_daily": f"{daily}/*.csv", **places(tmp_path)}


def test_one_more_day_is_all_that_is_read(spark, delivered, tmp_path):
    daily, paths = delivered
    out = tmp_path / "out"
    build(spark, paths, str(out))
    before = {name: parts(out, name) for name in COUNTY}
    kept = {p: p.read_bytes() for p in daily.iterdir()}
    for p in kept:
        spoil(p)
    write_day(daily, 100)
    tables = build(spark, paths, str(out))
    for p, text in kept.items():
        at = p.stat()
        p.write_bytes(text)
        os.utime(p, ns=(at.st_atime_ns, at.st_mtime_ns))
    same_as_a_full_build(spark, paths, tables, tmp_path / "full")
    for name in COUNTY:
        after = parts(out, name)
        changed = {m for m in after if after[m] != before[name].get(m)}
        assert changed == {"2020-06-01"} and len(after) == 4, name

    # Nothing new: nothing is read or written.
    now = {name: parts(out, name) for name in COUNTY}
    for p in daily.iterdir():
        spoil(p)
    build(spark, paths, str(out))
    assert {name: parts(out, name) for name in COUNTY} == now


def test_corrections_reach_the_months_they_can(spark, delivered, tmp_path):
    daily, paths = delivered
    out = tmp_path / "out"
    build(spark, paths, str(out))
    before = {name: parts(out, name) for name in COUNTY}
    # A corrected day in April, one that goes, and a code that first has data then.
    write_day(daily, 27, [("36061", "New York City", "New York", 99_999, 5)])
    write_day(daily, 12).unlink()
    tables = build(spark, paths, str(out))
    same_as_a_full_build(spark, paths, tables, tmp_path / "full")
    clean = parts(out, "county_clean")
    assert {m for m in clean if clean[m] != before["county_clean"][m]} == {"2020-04-01"}
    base = parts(out, "county_base")
    # The code that reports seldom has its next six rows in all months up to the end.
    assert base["2020-03-01"] == before["county_base"]["2020-03-01"] and base["2020-06-01"] != before["county_base"]["2020-06-01"]

    write_day(daily, 60, [("01003", "Baldwin", "Alabama", 8, 0)])
    tables = build(spark, paths, str(out))
    assert "01003" in {r.FIPS for r in tables["county_base"].filter("Date < '2020-04-01'").select("FIPS").collect()}
    same_as_a_full_build(spark, paths, tables, tmp_path / "full again")


def test_same_content_under_a_new_time_changes_no_table(spark, tmp_path):
    paths = {"state_population": places(tmp_path)["state_population"]}
    out = tmp_path / "out"
    build(spark, paths, str(out))
    before = parts(out, "state_dim")
    os.utime(paths["state_population"], (1, 1))
    build(spark, paths, str(out))
    assert parts(out, "state_dim") == before
    assert [r.modified for r in read_table(spark, f"{out}/manifest/state_population").collect()] == [1_000_000]


def test_a_build_that_dies_leaves_all_tables_readable(spark, delivered, tmp_path, monkeypatch):
    daily, paths = delivered
    out = tmp_path / "out"
    tables = build(spark, paths, str(out))
    before = {name: rows_of(df) for name, df in tables.items()}
    write_day(daily, 100)
    real, written = plan.publish, []

    def dying(df, path, *args, **kwargs):
        written.append(path)
        if path.endswith("county_base"):
            # Some tasks write their rows, then one fails.
            last = df.agg(F.max("Date")).first()[0]
            df = df.repartition(4).withColumn("Deaths", F.when((F.col("Date") == F.lit(last)) & (F.col("FIPS") == "36061"), F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("Deaths")))
        return real(df, path, *args, **kwargs)

    monkeypatch.setattr(plan, "publish", dying)
    with pytest.raises(Exception, match="killed"):
        build(spark, paths, str(out))
    assert any(p.endswith("county_daily") for p in written)
    for name in ("county_base", "county_progress", "county_dim", "state_dim"):
        assert rows_of(read_table(spark, f"{out}/tables/{name}").drop("month")) == before[name], name
    monkeypatch.undo()
    same_as_a_full_build(spark, paths, build(spark, paths, str(out)), tmp_path / "full")


def test_a_delivery_that_dies_is_read_again(spark, tmp_path, monkeypatch):
    from regionpanel.plans import deliveries

    paths = {"state_population": places(tmp_path)["state_population"]}
    out = str(tmp_path / "out")
    build(spark, paths, out)
    with open(paths["state_population"], "a") as f:
        f.write("Ohio,39,7\n")
    real = deliveries.publish

    def dying(df, path, *args, **kwargs):
        if "/manifest/" in path:
            raise RuntimeError("killed")
        return real(df, path, *args, **kwargs)

    monkeypatch.setattr(deliveries, "publish", dying)
    with pytest.raises(RuntimeError, match="killed"):
        build(spark, paths, out)
    monkeypatch.undo()
    got = build(spark, paths, out)["state_dim"]
    assert sorted(r.State for r in got.collect()) == ["Alabama", "New Mexico", "New York", "Ohio"]


# Records that cannot be used


def test_a_bad_date_rejects_its_record_only(spark, tmp_path):
    feed = tmp_path / "states.tsv"
    feed.write_text("submission_date\tstate\ttot_cases\tnew_case\ttot_death\tnew_death\n01/02/2021\tOH\t5\t5\t0\t0\n13/45/2021\tOH\t6\t1\t0\t0\n01/03/2021\tOH\tmany\t1\t0\t0\n01/04/2021\t\t1\t1\t0\t0\n")
    (tmp_path / "tests.tsv").write_text("state\tdate\toverall_outcome\tnew_results_reported\nOH\t2021/01/02\tPositive\t4\n")
    paths = {"state_daily": str(feed), "tests": str(tmp_path / "tests.tsv"), "state_population": places(tmp_path)["state_population"]}
    out = str(tmp_path / "out")
    tables = build(spark, paths, out)
    assert [r.Date.day for r in tables["state_facts"].orderBy("Date").collect()] == [2, 3]
    counts = {r.source: r for r in read_table(spark, f"{out}/tables/reject_counts").collect()}["state_daily"]
    assert (counts.delivered, counts.good, counts.rejected, counts.unread_numbers) == (4, 2, 2, 1)
    bad = {r.reason: json.loads(r.record) for r in read_table(spark, f"{out}/rejects/state_daily").collect()}
    assert set(bad) == {"submission_date cannot be read", "state is missing"} and bad["submission_date cannot be read"]["tot_cases"] == "6"


def test_codes_that_are_none_are_counted(spark, tmp_path):
    daily = tmp_path / "daily"
    daily.mkdir()
    write_day(daily, 0, [("123456", "Long", "Alabama", 3, 0), ("", "Blank", "Alabama", 3, 0), ("99", "Out of AL", "Alabama", 1, 0), ("1003.0", "Baldwin", "Alabama", 2, 0)])
    out = str(tmp_path / "out")
    build(spark, {"county_daily": f"{daily}/*.csv"}, out)
    counts = read_table(spark, f"{out}/tables/reject_counts").first()
    assert (counts.source, counts.delivered, counts.good, counts.rejected) == ("county_daily", 7, 6, 1)
    assert [r.reason for r in read_table(spark, f"{out}/rejects/county_daily").collect()] == ["FIPS cannot be read"]


def test_nothing_usable_raises(spark, tmp_path):
    feed = tmp_path / "states.tsv"
    feed.write_text("submission_date\tstate\ttot_cases\tnew_case\ttot_death\tnew_death\n2021\tOH\t5\t5\t0\t0\n")
    with pytest.raises(ValueError, match="none of the delivered"):
        build(spark, {"state_daily": str(feed)}, str(tmp_path / "out"))


def test_a_header_cell_may_hold_the_separator(spark, tmp_path):
    (tmp_path / "a.csv").write_text('State,"County, name",n\nOH,"Adams, west",1\nOH,Allen,2\n')
    c = Contract("c", "c", ("State", "n"))
    got = sources.ingest_delimited(spark, str(tmp_path / "a.csv"), c)
    assert sorted(tuple(r) for r in got.collect()) == [("OH", "Adams, west", "1"), ("OH", "Allen", "2")]
    assert got.columns == ["State", "County__name", "n"]
    (tmp_path / "b.csv").write_text('State,"County\nname",n\nOH,x,1\n')
    with pytest.raises(ValueError, match="line break"):
        sources.ingest_delimited(spark, str(tmp_path / "b.csv"), c)


# Versioned tables


def test_parts_are_replaced_by_pointer(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = [(dt.date(2020, 1 + i % 3, 1), i) for i in range(30)]
    publish(spark.createDataFrame(rows, "month date, v int"), path, "month", mark="a", basis={"x": "1"})
    one = pointer(spark, path)
    assert (one.number, one.mark, one.basis, sorted(one.parts)) == (1, "a", {"x": "1"}, ["2020-01-01", "2020-02-01", "2020-03-01"])
    old_reader = read_table(spark, path)
    publish(spark.createDataFrame([(dt.date(2020, 2, 1), 99)], "month date, v int"), path, "month", ["2020-02-01", "2020-03-01"])
    got = {(r.month.month, r.v) for r in read_table(spark, path).collect()}
    assert got == {(m.month, v) for m, v in rows if m.month == 1} | {(2, 99)}
    # Who read the table before can finish; what two writes ago was replaced is gone.
    assert old_reader.count() == 30
    publish(spark.createDataFrame([], "month date, v int"), path, "month", ["2020-02-01"])
    assert {r.month.month for r in read_table(spark, path).collect()} == {1}
    assert not list((tmp_path / "t/data/month=2020-03-01").glob("version=*"))
    plan_text = read_table(spark, path).filter("month = DATE'2020-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan_text


def test_a_table_that_fails_its_check_or_its_write_is_not_used(spark, tmp_path):
    path = f"{tmp_path}/t"
    publish(spark.range(5), path)

    def no(df):
        raise ValueError(f"{df.count()} rows")

    with pytest.raises(ValueError, match="7 rows"):
        publish(spark.range(7), path, check=no)
    with pytest.raises(Exception, match="dead"):
        publish(spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("dead")).cast("long")).otherwise(F.col("id"))), path)
    assert read_table(spark, path).count() == 5
    # The next write clears the folders away that no pointer names.
    publish(spark.range(3), path)
    assert read_table(spark, path).count() == 3 and len(list((tmp_path / "t/data").iterdir())) == 2


def test_pointers_can_be_listed_and_a_missing_table_raises(spark, tmp_path):
    with pytest.raises(ValueError, match="no table"):
        read_table(spark, f"{tmp_path}/none")
    publish(spark.range(0), f"{tmp_path}/t")
    assert sinks.read_table(spark, f"{tmp_path}/t").columns == ["id"]
    assert [p.number for p in versions._pointers(spark, f"{tmp_path}/t")] == [1]


def test_differences_of_listings(spark, tmp_path):
    for name in ("a", "b", "c d"):
        (tmp_path / f"{name}.csv").write_text(name)
    then = spark.createDataFrame(sources.list_files(spark, f"{tmp_path}/*.csv").collect())
    (tmp_path / "a.csv").unlink()
    os.utime(tmp_path / "b.csv", (5, 5))
    (tmp_path / "e.csv").write_text("new")
    got = {os.path.basename(r.path): r.change for r in sources.differences(sources.list_files(spark, f"{tmp_path}/*.csv"), then).collect()}
    assert got == {"a.csv": "gone", "b.csv": "changed", "e.csv": "new"}
