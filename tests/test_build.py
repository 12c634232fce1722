"""The whole build from small delivered files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from regionpanel.plans import counties, reports, states
from regionpanel.operators.panel import require_unique
from regionpanel.plans.build import KEYS, NEEDS, build
from regionpanel.sinks import publish, read_table

DAYS = [dt.date(2020, 3, 22) + dt.timedelta(days=n) for n in range(45)]
HEAD = "FIPS,Admin2,Province_State,Country_Region,Last_Update,Lat,Long_,Confirmed,Deaths,Recovered,Active,Combined_Key"


def daily_line(code, county, province, confirmed, deaths, country="US"):
    return f'{code},{county},{province},{country},,1.5,-2.5,{confirmed},{deaths},0,,"{county}, {province}, US"'


@pytest.fixture(scope="module")
def delivered(tmp_path_factory):
    root = tmp_path_factory.mktemp("delivered")
    daily = root / "daily"
    daily.mkdir()
    for n, day in enumerate(DAYS):
        lines = [
            daily_line("1001.0" if n % 2 else "1001", "Autauga", "Alabama", 10 * n, n),
            daily_line("36061", "New York City", "New York", 100 * n + 0.0, 2 * n),
            daily_line("36061", "New York City", "New York", 0, 0),
            daily_line("72", "", "Puerto Rico", n, 0),
            daily_line("00078", "", "Virgin Islands", 5, 0),
            daily_line("90001", "Unassigned", "Alabama", 7, 7),
            daily_line("01003", "Baldwin", "Alabama", 0, 0),
            daily_line("", "Out of AL", "Alabama", 3, 0),
            daily_line("123", "", "Ontario", 3, 0, "Canada"),
        ]
        (daily / day.strftime("%m-%d-%Y.csv")).write_text("\n".join([HEAD, *lines]) + "\n")

    def tsv(name, header, rows):
        text = "﻿" + "\n".join("\t".join(map(str, r)) for r in [header, *rows]) + "\n"
        (root / name).write_bytes(text.encode())
        return str(root / name)

    paths = {"county_daily": f"{daily}/*.csv"}
    paths["state_daily"] = tsv(
        "states.tsv",
        ["submission_date", "state", "tot_cases", "new_case", "tot_death", "new_death"],
        [(d.strftime("%m/%d/%Y"), s, k * n, -3 if n == 5 else k, n, 1) for n, d in enumerate(DAYS) for s, k in (("AL", 10), ("NY", 100), ("AS", 1))],
    )
    paths["tests"] = tsv(
        "tests.tsv",
        ["state", "date", "overall_outcome", "new_results_reported"],
        [(s, d.strftime("%Y/%m/%d"), o, c) for d in DAYS for s in ("AL", "NY") for o, c in (("Negative", 6), ("Positive", 4))],
    )
    weeks = [(2014 + y, w) for y in range(8) for w in (13, 14)]
    new = [(s, y, w, f"{y}-03-28" if w == 13 else f"{y}-04-04", 50 + y - 2014) for y, w in weeks if y >= 2020 for s in ("Alabama", "United States")]
    old = [(s, y, w, f"3/28/{y}" if w == 13 else f"4/4/{y}", 50) for y, w in weeks if y < 2020 for s in ("Alabama", "United States")]
    head = ["Jurisdiction of Occurrence", "MMWR Year", "MMWR Week", "Week Ending Date"]
    paths["weekly_deaths_new"] = tsv("new.tsv", [*head, "All Cause"], new)
    paths["weekly_deaths_old"] = tsv("old.tsv", [*head, "All  Cause"], old)
    case_head = "cdc_case_earliest_dt cdc_report_dt pos_spec_dt onset_dt current_status sex age_group race_ethnicity_combined hosp_yn icu_yn death_yn medcond_yn".split()
    paths["cases"] = tsv(
        "cases.tsv",
        case_head,
        [("2020/03/24", "2020/03/25", "", "2020/03/23", "x", "Male", "10", race, "Yes", "No", "Yes" if n == 0 else "No", "") for n, race in enumerate(("A", "A", "B"))],
    )
    (root / "county_pop.csv").write_bytes(
        "STNAME,CTYNAME,STATE,COUNTY,POPESTIMATE2019\nAlabama,Autauga,01,001,1000\nNew York,New York,36,061,500\nNew York,Bronx,36,005,250\nNew York,Kings,36,047,250\nNew México,Doña Ana,35,013,9\n".encode("latin1")
    )
    paths["county_population"] = str(root / "county_pop.csv")
    (root / "state_pop.csv").write_text("NAME,STATE,POPESTIMATE2019\nUnited States,0,9999\nAlabama,1,2000\nNew York,36,5000\nPuerto Rico,72,300\n")
    paths["state_population"] = str(root / "state_pop.csv")
    (root / "survey.json").write_text(json.dumps([["CP03_2014_2018_062E", "CP05_2014_2018_018E", "state", "county"], ["50000", "38.5", "01", "001"]]))
    paths["county_survey"] = str(root / "survey.json")
    return paths


@pytest.fixture(scope="module")
def built(spark, delivered, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    return build(spark, delivered, str(out)), out


def test_keys_are_unique(built):
    tables, _ = built
    more = {"county_base": ["FIPS", "Date"], "county_progress": ["FIPS", "Date"], "nation_facts": ["date"], "state_deaths": ["State", "Week_Of_Year"]}
    for name, key in {**KEYS, **more}.items():
        df = tables[name]
        assert df.count() == df.select(key).distinct().count() > 0, name


def test_repeated_and_missing_keys_raise(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    require_unique(df, ["k", "v"][1:])
    with pytest.raises(ValueError, match="'a'"):
        require_unique(df.filter("k is not null"), ["k"])
    with pytest.raises(ValueError, match="None"):
        require_unique(df.filter("v > 1"), ["k"])


def test_counties(built):
    tables, _ = built
    assert {r.FIPS for r in tables["county_base"].select("FIPS").distinct().collect()} == {"01001", "36061", "00072"}
    dim = {r.FIPS: r for r in tables["county_dim"].collect()}
    assert (dim["36061"].Population, dim["00072"].Population) == (1000, 300)
    assert (dim["01001"].MedianIncome, dim["01001"].MedianAge) == (50000, 38.5)
    assert tables["county_population"].filter("CTYNAME = 'Doña Ana'").first().Population == 9
    last = tables["county_base"].filter("FIPS = '01001'").orderBy("Date").tail(1)[0]
    assert (last.Confirmed, last.ConfirmedIncrease, last.Avg7DayConfirmedIncrease) == (440, 10, 10.0)


def test_progress(built):
    tables, _ = built
    rows = {(r.FIPS, r.Date): r for r in tables["county_progress"].collect()}
    assert min(d for _, d in rows) == DAYS[7]
    r = rows["01001", DAYS[44]]
    assert (r.OneWeekConfirmedIncrease, r.TwoWeekConfirmedIncrease, r.MonthConfirmedIncrease) == (70, 140, 300)
    assert r.CasesPer100k == 140 * 100000 / 1000
    assert r.OneWeekCasesPer100kChange == 0
    early = rows["01001", DAYS[8]]
    assert (early.OneWeekConfirmedIncrease, early.TwoWeekConfirmedIncrease, early.TwoWeekConfirmedIncreasePct) == (70, 0, 0.0)
    assert early.TwoWeekAvg7DayConfirmedIncreasePct is None and early.MonthAvg7DayDeathsIncreasePct is None
    assert len(tables["county_progress"].columns) == 27


def test_latest_progress_equals_full_history(spark, built):
    tables, _ = built
    latest = counties.latest_progress(tables["county_base"], tables["county_dim"]).collect()
    full = [r for r in tables["county_progress"].collect() if r.Date == DAYS[-1]]
    assert sorted(map(tuple, latest)) == sorted(map(tuple, full)) and len(full) == 3


def test_states_and_nation(built):
    tables, _ = built
    facts = {(r.state, r.Date): r for r in tables["state_facts"].collect()}
    r = facts["AL", DAYS[44]]
    assert (r.positiveIncrease, r.Avg7DayPositiveIncrease, r.positivityRate) == (10, 10.0, 0.4)
    assert r.CasesPer100k == 140 * 100000 / 2000
    assert r.Avg7DayPositivityRate == pytest.approx(0.4)
    assert facts["AL", DAYS[5]].positiveIncrease == 0
    assert facts["AS", DAYS[44]].CasesPer100k is None and facts["AL", DAYS[13]].CasesPer100k is None
    nation = {r.date: r for r in tables["nation_facts"].collect()}
    n = nation[DAYS[44]]
    assert (n.positive, n.positiveIncrease, n.totalTestResultsIncrease) == (111 * 44, 111, None)
    assert n.Avg7DayPositiveIncrease == 111.0
    assert n.CasesPer100k == 111 * 14 * 100000 / 7000
    for day, row in nation.items():
        assert row.positive == sum(facts[s, day].positive for s in ("AL", "NY", "AS"))


def test_deaths(built):
    tables, _ = built
    got = {r.Week_Of_Year: r for r in tables["state_deaths"].collect()}
    assert set(got) == {13, 14} and {r.State for r in got.values()} == {"Alabama"}
    r = got[13]
    assert (r.AvgDeaths_2014_2019, r.Deaths2019, r.Deaths2020, r.Deaths2021, r.Excess2020) == (50.0, 50, 56, 57, 6.0)
    assert r.ExcessPct2020 == pytest.approx(12.0)
    assert r.Covid19DeathsForWeek == 7 and r.Week_Ending_Date2020 == dt.date(2020, 3, 28)
    old = tables["weekly_deaths"].filter("Year = 2015 and Week_Of_Year = 13 and State = 'Alabama'").first()
    assert old.Week_Ending_Date == dt.date(2015, 3, 28)


def test_cases(built):
    tables, _ = built
    got = {r.race_ethnicity_combined: r for r in tables["cases_by_week"].collect()}
    assert (got["A"].cases, got["A"].death, got["A"].cases_total, got["A"].death_pct) == (2, 1, 3, 1.0)
    assert sum(r.cases_pct for r in got.values()) == pytest.approx(1)
    assert got["B"].week_ending_date == dt.date(2020, 3, 28)
    level = tables["case_level"].first()
    assert (level.week_of_year, level.hosp_flag, level.icu_flag, level.pos_spec_dt) == (12, 1, 0, None)


def test_exports(spark, built):
    _, out = built
    rows = [json.loads(x) for p in sorted((out / "exports/counties_rate_of_change").glob("*.json")) for x in p.read_text().splitlines()]
    assert [r["FIPS"] for r in rows] == ["00072", "01001", "36061"] and len(rows[0]) == 31
    assert rows[1]["State"] == "AL" and rows[1]["Date"] == DAYS[-1].isoformat()
    rates = spark.read.option("sep", "\t").option("header", True).csv(f"{out}/exports/counties_casesper100k")
    assert rates.count() == 3 * 31


def test_state_progress(spark, built):
    tables, _ = built
    recent = states.state_averages_export(tables["state_facts"])
    got = {r.State: r for r in states.state_progress(recent).collect()}
    assert set(got) == {"AL", "NY", "US"}
    al, us = got["AL"], got["US"]
    assert len(al.positiveSeries) == 14 and len(us.positiveSeries) == 15
    assert (al.positive, al.positiveIncreasePct, al.positiveChangePct, al.positivityRate) == (440, 10 / 430, 0.0, 0.4)
    assert (us.positive, us.positiveIncrease, us.positivityRate, us.positivityChange) == (110 * 44, 110, None, None)


def test_pages(spark, built):
    tables, _ = built
    latest = counties.latest_progress(tables["county_base"], tables["county_dim"])
    snapshot = counties.county_snapshot(latest, tables["county_dim"], tables["state_dim"])
    averages = counties.county_averages_export(tables["county_base"])
    rows = {r.FIPS: r for r in reports.county_table(snapshot, averages).collect()}
    assert len(rows["01001"].ConfirmedSeries) == 15 and rows["01001"].SizeBand == "small"
    circles = {r.FIPS: r for r in reports.outbreak_circles(snapshot).collect()}
    assert circles["01001"].Direction == "down" and circles["01001"].Radius > 0
    assert [r.FIPS for r in reports.outbreak_circles(snapshot, "month", k=1).collect()] == ["36061"]
    together = reports.all_outbreak_circles(snapshot, k=1)
    for view in reports.VIEWS:
        one = reports.outbreak_circles(snapshot, view, k=1).collect()
        assert sorted(map(tuple, one)) == sorted(tuple(r)[1:] for r in together.filter(F.col("View") == view).collect()), view
    rates = counties.county_rate_export(tables["county_progress"], tables["county_base"])
    shapes = spark.createDataFrame([("01001", "g1"), ("99999", "g2")], "FIPS string, geometry string")
    drawn = {r.FIPS: r for r in reports.county_shapes(shapes, snapshot, averages, rates).collect()}
    assert drawn["01001"].Shade == 10000000 and len(drawn["01001"].RateSeries) == 31
    assert (drawn["99999"].has_info, drawn["99999"].Shade) == (False, None)


def test_old_state_feed(spark):
    raw = spark.createDataFrame(
        [("20200401", "AL", "10", "-2", "1", "0", None, None, "20"), ("20200402", "AL", "14", "4", "1", "0", "3", "1", "0")],
        "Date string, state string, positive string, positiveIncrease string, death string, deathIncrease string, hospitalized string, hospitalizedIncrease string, totalTestResultsIncrease string",
    )
    a, b = states.clean_state_daily_old(raw).orderBy("Date").collect()
    assert (a.positiveIncrease, a.PositivityRate, b.PositivityRate, b.hospitalized) == (0, -0.1, None, 3)


def test_reject_counts(spark, built):
    _, out = built
    counts = {r.source: r for r in read_table(spark, f"{out}/tables/reject_counts").collect()}
    assert all(r.delivered == r.good + r.rejected for r in counts.values())
    assert counts["county_daily"].delivered == 9 * len(DAYS) and counts["county_daily"].rejected == 0
    assert counts["state_daily"].unread_numbers == 0


def test_weekly_report_is_exported_in_order(spark, built):
    _, out = built
    files = sorted((out / "exports/cases_by_week").glob("*.csv"))
    lines = [x.split("\t") for p in files for x in p.read_text().splitlines()]
    head = lines[0]
    rows = [dict(zip(head, x)) for x in lines if x != head]
    order = [(r["week_ending_date"], r["race_ethnicity_combined"]) for r in rows]
    assert order == sorted(order) and len(order) == 2


def test_default_orders(spark, built):
    tables, _ = built
    latest = counties.latest_progress(tables["county_base"], tables["county_dim"])
    snapshot = counties.county_snapshot(latest, tables["county_dim"], tables["state_dim"])
    shown = [r[reports.COUNTY_ORDER] for r in reports.sorted_county_table(snapshot, counties.county_averages_export(tables["county_base"])).collect()]
    known = [v for v in shown if v is not None]
    assert known == sorted(known, reverse=True) and shown[: len(known)] == known
    progress = states.state_progress(states.state_averages_export(tables["state_facts"]))
    shown = [r[reports.STATE_ORDER] for r in reports.sorted_state_table(progress).collect()]
    known = [v for v in shown if v is not None]
    assert known == sorted(known, reverse=True) and len(shown) == 3


def test_trailing_exports_read_the_last_months_only(spark, built):
    _, out = built
    base = read_table(spark, f"{out}/tables/county_base")
    plan = counties.county_averages_export(base)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and plan.count("month") > 2
    progress = read_table(spark, f"{out}/tables/county_progress")
    full = counties.county_rate_export(progress, base).collect()
    dim = read_table(spark, f"{out}/tables/county_dim")
    assert sorted(map(str, counties.recent_rate_export(base, dim).collect())) == sorted(map(str, full)) and len(full) == 3 * 31


def test_partial_build_and_later_days(spark, tmp_path):
    late = [dt.date(2026, 1, 1) + dt.timedelta(days=n) for n in range(20)]
    states_file = tmp_path / "states.tsv"
    lines = ["submission_date\tstate\ttot_cases\tnew_case\ttot_death\tnew_death"]
    lines += [f"{d:%m/%d/%Y}\tAL\t{10 * n}\t10\t{n}\t1" for n, d in enumerate(late)]
    states_file.write_text("\n".join(lines) + "\n")
    tests_file = tmp_path / "tests.tsv"
    tests_file.write_text("state\tdate\toverall_outcome\tnew_results_reported\n" + "".join(f"AL\t{d:%Y/%m/%d}\tPositive\t4\n" for d in late))
    people = tmp_path / "people.csv"
    people.write_text("NAME,STATE,POPESTIMATE2019\nAlabama,1,2000\n")
    paths = {"state_daily": str(states_file), "tests": str(tests_file), "state_population": str(people)}
    tables = build(spark, paths, f"{tmp_path}/out")
    assert set(tables) == {"state_dim", "state_tests", "state_facts", "nation_facts"}
    last = tables["state_facts"].filter(f"Date = '{late[-1]}'").first()
    assert (last.CasesPer100k, last.Avg7DayPositiveIncrease, last.Avg7DayPositivityRate) == (140 * 100000 / 2000, 10.0, 1.0)


def test_bad_delivery_leaves_the_good_table(spark, tmp_path):
    people = tmp_path / "people.csv"
    people.write_text("NAME,STATE,POPESTIMATE2019\nAlabama,1,2000\n")
    build(spark, {"state_population": str(people)}, f"{tmp_path}/out")
    people.write_text("NAME,STATE,POPESTIMATE2019\nAlabama,1,2000\nAlabama,1,3000\n")
    with pytest.raises(ValueError, match="Alabama"):
        build(spark, {"state_population": str(people)}, f"{tmp_path}/out")
    assert [r.Population for r in read_table(spark, f"{tmp_path}/out/tables/state_dim").collect()] == [2000]
    people.write_text("NAME,STATE,POPESTIMATE2019\nAlabama,1,4000\n")
    assert build(spark, {"state_population": str(people)}, f"{tmp_path}/out")["state_dim"].first().Population == 4000


# Rewrites tables the tests above read, so it comes last.
def test_second_build_makes_only_what_changed(spark, delivered, built, tmp_path):
    tables, out = built
    before = sorted(map(str, tables["county_progress"].collect()))

    def files():
        return {name: {p.name for p in (out / "tables" / name).rglob("*.parquet")} for name in NEEDS}

    first = files()
    again = build(spark, delivered, str(out))
    assert files() == first
    assert sorted(map(str, again["county_progress"].collect())) == before

    more = tmp_path / "cases.tsv"
    with open(delivered["cases"], "rb") as f:
        text = f.read()
    more.write_bytes(text + text.splitlines(keepends=True)[-1])
    third = build(spark, {**delivered, "cases": str(more)}, str(out))
    second = files()
    assert {name for name in NEEDS if second[name] - first[name]} == {"case_level", "cases_by_week"}
    assert third["case_level"].count() == 4

    # A table whose last write came from something else is made again.
    publish(read_table(spark, f"{out}/tables/state_dim").limit(1), f"{out}/tables/state_dim", mark="something else")
    build(spark, {**delivered, "cases": str(more)}, str(out))
    assert {name for name in NEEDS if files()[name] - second[name]} == {"state_dim"}
    assert read_table(spark, f"{out}/tables/state_dim").count() == 3
