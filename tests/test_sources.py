"""Readers, writers, fingerprints and incremental ingest on written files."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from regionpanel import sinks, sources
from regionpanel.sources import Contract
from regionpanel.streaming import ingest_new_files, read_ingested


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


TSV = Contract("t", "t", ("state", "All__Cause"), sep="\t")


def test_delimited_bom_blanks_and_extra_columns(spark, tmp_path):
    path = tmp_path / "a.tsv"
    path.write_bytes("﻿state\tAll  Cause\tother-col\nOhio\t12\t\nTexas\t\t\"x\"\"y\"\n".encode())
    df = sources.ingest_delimited(spark, str(path), TSV)
    assert df.columns == ["state", "All__Cause", "other_col"]
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    assert rows_of(df, "state") == [("Ohio", "12", None), ("Texas", None, 'x"y')]


def test_delimited_latin1(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("CTYNAME,n\nDoña Ana County,1\n".encode("latin1"))
    df = sources.ingest_delimited(spark, str(path), Contract("c", "c", ("CTYNAME",), encoding="ISO-8859-1"))
    assert df.first()[0] == "Doña Ana County"


def test_delimited_refuses_missing_and_clashing_columns(spark, tmp_path):
    path = tmp_path / "a.tsv"
    path.write_text("state\tn\nOhio\t1\n")
    with pytest.raises(ValueError, match="All__Cause"):
        sources.ingest_delimited(spark, str(path), TSV)
    path.write_text("a b\ta-b\n1\t2\n")
    with pytest.raises(ValueError, match="fall together"):
        sources.ingest_delimited(spark, str(path), Contract("c", "c", (), sep="\t"))


FIELDS = ("FIPS", "Admin2", "Confirmed")


def daily(tmp_path, files):
    folder = tmp_path / "daily"
    folder.mkdir()
    for name, text in files.items():
        (folder / name).write_bytes(text.encode())
    return f"{folder}/*.csv"


def test_daily_files_of_two_layouts(spark, tmp_path):
    path = daily(
        tmp_path,
        {
            "03-21-2020.csv": "Province/State,Confirmed\nOhio,1\n",
            "03-22-2020.csv": "﻿FIPS,Admin2,Confirmed\n39001,Adams,1\n39003,,2\n",
            "03-23-2020.csv": 'Confirmed,Extra,"Admin2",FIPS\r\n3,x,"Adams, Ohio",39001\r\n',
            "04-01-2020.csv": 'FIPS,Admin2,Confirmed\n39001,"line one\nline two",4\n',
        },
    )
    got = rows_of(sources.ingest_daily_files(spark, path, FIELDS), "Date", "FIPS")
    assert got == [
        ("20200322", "39001", "Adams", "1"),
        ("20200322", "39003", None, "2"),
        ("20200323", "39001", "Adams, Ohio", "3"),
        ("20200401", "39001", "line one\nline two", "4"),
    ]


def test_daily_files_need_every_field(spark, tmp_path):
    path = daily(tmp_path, {"03-22-2020.csv": "FIPS,Admin2\n39001,Adams\n"})
    with pytest.raises(ValueError, match="Confirmed"):
        sources.ingest_daily_files(spark, path, FIELDS)


def test_daily_files_need_a_header(spark, tmp_path):
    path = daily(tmp_path, {"03-22-2020.csv": "39001,Adams,2\n"})
    with pytest.raises(ValueError, match="no header"):
        sources.ingest_daily_files(spark, path, FIELDS)


def test_json_rows(spark, tmp_path):
    (tmp_path / "a.json").write_bytes('[["NAME","median age","state"],\n["Doña Ana",32.5,"35"],\n["A, B",null,"01"]]'.encode("latin1"))
    (tmp_path / "b.json").write_text('[["state","NAME","median age"],["02","C","40"]]')
    df = sources.ingest_json_rows(spark, f"{tmp_path}/*.json", ["state"], "ISO-8859-1")
    got = {tuple(r) for r in df.select("NAME", "median_age", "state").collect()}
    assert got == {("Doña Ana", "32.5", "35"), ("A, B", None, "01"), ("C", "40", "02")}
    with pytest.raises(ValueError, match="county"):
        sources.ingest_json_rows(spark, f"{tmp_path}/*.json", ["county"], "ISO-8859-1")


def test_calendar(spark):
    got = rows_of(sources.calendar(spark), "Date")
    d = dt.date
    assert len(got) == 2191
    assert got[0] == (d(2020, 1, 1), d(2019, 12, 31), d(2019, 12, 25), d(2019, 12, 18), d(2019, 12, 2))
    assert got[-1][0] == d(2025, 12, 30)


def test_state_abbreviations(spark):
    got = dict(rows_of(sources.state_abbreviations(spark), "state"))
    assert len(got) == 51 and got["District of Columbia"] == "DC" and len(set(got.values())) == 51


def test_fingerprint(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "i int, s string")
    assert sources.same_content(df, df.orderBy(F.desc("i")).select("s", "i"))
    assert not sources.same_content(df, df.distinct())
    assert not sources.same_content(df, df.withColumn("i", F.col("i") + 1))


def test_reload_only_when_changed(spark, tmp_path):
    df = spark.createDataFrame([("1", "a")], "i string, s string")
    path = str(tmp_path / "t")
    assert sources.reload_table(df, path)
    assert not sources.reload_table(df, path)
    assert sources.reload_table(df.withColumn("s", F.lit("b")), path)
    assert spark.read.parquet(path).first().s == "b"


def test_tsv_and_json(spark, tmp_path):
    df = spark.createDataFrame([("b", None, dt.date(2020, 3, 1)), ("a", 1.5, None)], "k string, v double, d date")
    sinks.write_tsv(df, f"{tmp_path}/tsv", ["k"])
    lines = [p.read_text() for p in sorted((tmp_path / "tsv").glob("*.csv"))]
    body = [x for text in lines for x in text.splitlines() if x != "k\tv\td"]
    assert body == ['a\t1.5\t', 'b\t\t2020-03-01'] or body == ['a\t1.5\t""', 'b\t""\t2020-03-01']
    sinks.write_tsv(df, f"{tmp_path}/none", ["k"], null="None")
    body = [x for p in sorted((tmp_path / "none").glob("*.csv")) for x in p.read_text().splitlines() if x != "k\tv\td"]
    assert body == ["a\t1.5\tNone", "b\tNone\t2020-03-01"]
    sinks.write_json(df, f"{tmp_path}/json", ["k"])
    objects = [json.loads(x) for p in sorted((tmp_path / "json").glob("*.json")) for x in p.read_text().splitlines()]
    assert objects == [{"k": "a", "v": 1.5, "d": None}, {"k": "b", "v": None, "d": "2020-03-01"}]


@pytest.mark.parametrize("n", [1, 2, 500])
def test_json_array_over_files(spark, tmp_path, n):
    df = spark.range(n).withColumn("v", F.when(F.col("id") % 2 == 0, F.col("id"))).repartition(6)
    sinks.write_json_array(df, f"{tmp_path}/a", ["id"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "a").glob("part-*.txt")))
    assert json.loads(text) == [{"id": i, "v": i if i % 2 == 0 else None} for i in range(n)]


def test_partitioned_table(spark, tmp_path):
    df = spark.range(1000).withColumn("y", F.when(F.col("id") < 900, 2020).otherwise(2021))
    sinks.write_table(df, f"{tmp_path}/t", ["y"])
    back = spark.read.parquet(f"{tmp_path}/t")
    assert {p.name for p in (tmp_path / "t").glob("y=*")} == {"y=2020", "y=2021"}
    assert rows_of(back.groupBy("y").count(), "y") == [(2020, 900), (2021, 100)]


def test_ingest_new_files_once_each(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    c = Contract("c", "c", ("a", "b"))
    args = (spark, str(drop), c, f"{tmp_path}/table", f"{tmp_path}/state")
    (drop / "1.csv").write_text("a,b\n1,x\n2,\n")
    ingest_new_files(*args)
    ingest_new_files(*args)
    assert rows_of(spark.read.parquet(f"{tmp_path}/table").select("a", "b"), "a") == [("1", "x"), ("2", None)]
    (drop / "2.csv").write_text("a,b\n3,y\n")
    ingest_new_files(*args)
    assert rows_of(spark.read.parquet(f"{tmp_path}/table").select("a", "source_file"), "a") == [
        ("1", "1.csv"),
        ("2", "1.csv"),
        ("3", "2.csv"),
    ]


def test_columns_of_later_batches_are_seen(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    args = (spark, str(drop), Contract("c", "c", ("a", "b")), f"{tmp_path}/table", f"{tmp_path}/state")
    (drop / "1.csv").write_text("a,b\n1,x\n")
    ingest_new_files(*args)
    (drop / "2.csv").write_text("a,extra,b\n2,more,y\n")
    ingest_new_files(*args)
    assert rows_of(read_ingested(spark, f"{tmp_path}/table").select("a", "b", "extra"), "a") == [("1", "x", None), ("2", "y", "more")]


def test_json_array_of_nothing(spark, tmp_path):
    sinks.write_json_array(spark.range(0), f"{tmp_path}/empty", ["id"])
    assert "".join(p.read_text() for p in sorted((tmp_path / "empty").glob("*.txt"))).strip() == "[]"


def test_contracts_are_complete():
    assert len(sources.CONTRACTS) == 13
    assert all(set(c.key) - {"Date"} <= set(c.columns) for c in sources.CONTRACTS.values())


# Binding by header name, malformed records, changes of content.

NEEDED = Contract("f", "f", ("state", "tot_cases", "new_case"), sep="\t")


def two_layouts(tmp_path):
    (tmp_path / "1.tsv").write_text('date\tconf_cases\tstate\tnew_case\tnote\ttot_cases\n1\t90\tOH\t7\t"two\nlines"\t10\n')
    (tmp_path / "2.tsv").write_text("tot_cases\tstate\tnew_case\n5\tTX\t\n6\tNY\t2\n")
    return f"{tmp_path}/*.tsv"


def test_columns_are_bound_by_each_files_header(spark, tmp_path):
    df = sources.ingest_delimited(spark, two_layouts(tmp_path), NEEDED)
    assert rows_of(df.select("state", "tot_cases", "new_case", "note"), "state") == [
        ("NY", "6", "2", None),
        ("OH", "10", "7", "two\nlines"),
        ("TX", "5", None, None),
    ]


def test_new_files_are_bound_by_their_header(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    two_layouts(drop)
    sources_args = (spark, str(drop), NEEDED, f"{tmp_path}/table", f"{tmp_path}/state")
    ingest_new_files(*sources_args, rejected=f"{tmp_path}/rejected")
    (drop / "3.tsv").write_text("state\tnew_case\ttot_cases\nAL\t1\t2\nAK\t1\n")
    ingest_new_files(*sources_args, rejected=f"{tmp_path}/rejected")
    got = rows_of(spark.read.parquet(f"{tmp_path}/table").select("state", "tot_cases", "new_case"), "state")
    assert got == [("AL", "2", "1"), ("NY", "6", "2"), ("OH", "10", "7"), ("TX", "5", None)]
    assert [r.record for r in spark.read.parquet(f"{tmp_path}/rejected").collect()] == ["AK\t1"]


def test_records_that_do_not_fit_are_told(spark, tmp_path):
    path = tmp_path / "a.tsv"
    path.write_text("state\ttot_cases\tnew_case\nOH\t1\tx\nTX\t1\nNY\t1\t2\t3\nAL\t4\t\n")
    raw = sources.read_by_name(spark, str(path), NEEDED)
    assert rows_of(sources.good_rows(raw).select("state"), "state") == [("AL",), ("OH",)]
    assert {r.record for r in sources.rejects(raw, "f").collect()} == {"TX\t1", "NY\t1\t2\t3"}
    n = F.col("new_case").try_cast("long")
    r = sources.reject_summary(raw, "f", {"new_case": n}).first()
    assert (r.delivered, r.good, r.rejected, r.lost.new_case) == (4, 2, 2, 1)


def test_undated_daily_file_raises(spark, tmp_path):
    path = daily(tmp_path, {"03-22-2020.csv": "FIPS,Admin2,Confirmed\n39001,Adams,1\n", "2020-03-24.csv": "FIPS,Admin2,Confirmed\n39001,Adams,2\n"})
    with pytest.raises(ValueError, match="holds no day"):
        sources.ingest_daily_files(spark, path, FIELDS)


def test_day_of_a_folder_does_not_count(spark, tmp_path):
    folder = tmp_path / "04-05-2021.csv"
    folder.mkdir()
    (folder / "03-22-2020.csv").write_text("FIPS,Admin2,Confirmed\n39001,Adams,1\n")
    assert sources.ingest_daily_files(spark, f"{folder}/*.csv", FIELDS).first().Date == "20200322"


def test_ragged_json_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text('[["a","b","c"],["1"],["2","3","4","5"],[]]')
    df = sources.ingest_json_rows(spark, f"{tmp_path}/a.json")
    assert sorted(map(tuple, df.collect()), key=str) == [("1", None, None), ("2", "3", "4"), (None, None, None)]


def test_fingerprint_sees_blanks_and_names(spark):
    one = spark.createDataFrame([(None, 5)], "a int, b int")
    other = spark.createDataFrame([(5, None)], "a int, b int")
    assert not sources.same_content(one, other)
    assert not sources.same_content(one, one.withColumnRenamed("a", "c"))
    assert not sources.same_content(one.limit(0), one.limit(0).withColumnRenamed("a", "c"))
    assert sources.same_content(one, one.select("b", "a"))


def test_long_codes_are_not_cut(spark):
    from regionpanel.functions import repair_code

    df = spark.createDataFrame([("123456",), ("123457.0",), ("1001.0",), ("12345",), ("x",)], "c string")
    assert [r[0] for r in df.select(repair_code(F.col("c"), F.lit(1))).collect()] == [None, None, "01001", "12345", None]


# Quoted line breaks over blocks.


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def quoted_files(folder, seed, files=3):
    """Files with breaks, quotes and separators in cells, with what their cells are."""
    rng = random.Random(seed)
    want = []
    for f in range(files):
        lines = ["k,note,n"]
        for i in range(rng.randint(40, 90)):
            note = "".join(rng.choice(["a", "é", ",", '"', "\n", "\n\n", "\r\n", "long words ", ""]) for _ in range(rng.choice([0, 1, 3, 60])))
            bad = rng.random() < 0.05
            cells = [f"{f}-{i}", '"' + note.replace('"', '""') + '"', str(i)]
            lines.append(",".join(cells + (["more"] if bad else [])))
            if rng.random() < 0.1:
                lines.append("")
            want.append((f"{f}-{i}", None if bad else note or None, bad))
        (folder / f"part {f}.csv").write_bytes(("﻿" * (f == 0) + "\n".join(lines) + "\n").encode())
    return want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_files_with_breaks_in_cells_are_read_by_block(spark, tmp_path, small_blocks, seed):
    want = quoted_files(tmp_path, seed)
    c = Contract("c", "c", ("k", "n"))
    raw = sources.read_by_name(spark, f"{tmp_path}/*.csv", c, "source_file")
    good = {(r.k, r.note) for r in sources.good_rows(raw).collect()}
    assert good == {(k, note) for k, note, bad in want if not bad}
    assert sources.rejects(raw, "c").count() == sum(bad for *_, bad in want)
    assert {r.source_file for r in raw.select("source_file").distinct().collect()} == {f"part {i}.csv" for i in range(3)}
    assert raw.rdd.getNumPartitions() > 3


def test_blocks_say_how_the_next_begins(spark, tmp_path, small_blocks):
    from regionpanel.sources import quoted

    (tmp_path / "a.csv").write_text("a,b\n" + "".join(f'{i},"{"x" * 40}\n{"y" * 700}"\n' for i in range(6)))
    lines = quoted._lines(spark, f"{tmp_path}/a.csv", "UTF-8")
    inside = {r.block for r in quoted.block_states(lines).collect()}
    with open(tmp_path / "a.csv", "rb") as f:
        data = f.read()
    # A block's first line begins after the first line feed in it.
    for block in {r.block for r in lines.select("block").distinct().collect()}:
        begin = data.find(b"\n", block - 1 if block else 0) + 1 if block else 0
        assert (data[:begin].count(b'"') % 2 == 1) == (block in inside), block
    got = quoted.quoted_records(spark, f"{tmp_path}/a.csv", "UTF-8").collect()
    assert sorted(r.record for r in got) == [f'{i},"{"x" * 40}\n{"y" * 700}"' for i in range(6)]


# JSON over blocks.


def json_text(rng, n=12):
    return "".join(rng.choice(["a", "é", ",", '"', "\\", "]", "[", "}", "{", "\n", ":", " "]) for _ in range(rng.randint(0, n)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_json_rows_by_block(spark, tmp_path, small_blocks, seed):
    rng = random.Random(seed)
    for f in range(3):
        rows = [["k", "text", "n"] if f else ["n", "k", "text"]]
        for i in range(rng.randint(30, 80)):
            rows.append([f"{f}-{i}", json_text(rng, 5 if rng.random() < 0.9 else 900), i][: rng.choice([2, 3, 3, 3])])
        rows += [[], None]
        (tmp_path / f"{f} é.json").write_text(json.dumps(rows, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])), encoding="utf-8")
    ways = [sources.ingest_json_rows(spark, f"{tmp_path}/*.json", ["k", "n"], path_column="file", long_file=size) for size in (1 << 40, 1)]
    whole, blocks = (sorted(map(str, df.select("k", "text", "n", "file").collect())) for df in ways)
    assert whole == blocks and len(whole) > 90
    assert spark.read.option("lineSep", "]").text(f"{tmp_path}/*.json").rdd.getNumPartitions() > 3


@pytest.mark.parametrize("seed", [1, 2])
def test_features_by_block(spark, tmp_path, small_blocks, seed):
    from regionpanel.operators.report import features

    rng = random.Random(seed)
    for f in range(2):
        made = [
            {"type": "Feature", "properties": {"STATE": f"{f:02d}", "COUNTY": f"{i:03d}", "NAME": json_text(rng)}, "geometry": {"type": "Polygon", "coordinates": [[[i, j] for j in range(rng.choice([2, 200]))]]}}
            for i in range(40)
        ]
        other = [{"properties": {"STATE": "no", "COUNTY": "no"}, "geometry": {}} for _ in range(30)]
        doc = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x}"}}, "before": other, "features": made, "after": other, "bbox": [1, 2]}
        (tmp_path / f"{f}.json").write_text(json.dumps(doc))
    got = sorted(map(tuple, sources.read_features(spark, f"{tmp_path}/*.json").collect()))
    want = sorted(map(tuple, features(spark.read.option("wholetext", True).text(f"{tmp_path}/*.json")).collect()))
    assert got == want and len(got) == 80
