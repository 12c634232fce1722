"""Readers and writers on files that Spark writes from the tables into the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric_text, parse_date, repair_code
from ..operators.report import features, join_features
from ..session import new_folder, settle
from ..sinks import publish, read_table, write_json, write_json_array, write_table, write_tsv
from ..sources import (
    Contract,
    differences,
    ingest_daily_files,
    ingest_delimited,
    ingest_json_rows,
    list_files,
    read_by_name,
    read_features,
    reject_reason,
    reject_summary,
    same_content,
)
from ..sources.calendar import expand_days
from ..sources.delimited import MALFORMED, read_layout
from ..streaming import ingest_new_files
from .registry import query
from .tables import ND, nation_day, table


@query(
    "calendar_dim",
    """WITH span AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
days AS (SELECT lo + CAST(i AS INTEGER) AS d FROM span, range(0, 100000) t(i) WHERE lo + CAST(i AS INTEGER) < hi)
SELECT d AS "Date", d - 1 AS "Minus1Day", d - 7 AS "Minus7Days", d - 14 AS "Minus14Days", d - 30 AS "Minus30Days", coalesce(n, 0) AS orders
FROM days LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS o, count(*) AS n FROM orders GROUP BY 1) ON o = d""",
    dates=['"Date"', "Minus1Day", "Minus7Days", "Minus14Days", "Minus30Days"],
)
def calendar_dim(spark, sf):
    days = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("Date")).agg(F.count(F.lit(1)).alias("n"))
    span = days.agg(F.min("Date").alias("first"), F.max("Date").alias("end"))
    dated = expand_days(span, "first", "end").join(days, "Date", "left")
    return dated.withColumn("orders", F.coalesce(F.col("n"), F.lit(0))).drop("n")


ORDER_FILE = Contract("order_file", "orders", ("order_key", "order_day", "order_status", "total"), sep="\t")


def _order_text(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order key"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("order-day"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("order.status"),
        F.round(F.col("o_totalprice") * 100).cast("long").cast("string").alias("total"),
    )


_ORDERS_BACK = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, nullif(o_orderstatus, 'P') AS status,
  CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders"""


def _orders_back(raw):
    return raw.select(
        numeric_text(F.col("order_key")).alias("o_orderkey"),
        parse_date(F.col("order_day"), "MM/dd/yyyy").alias("day"),
        F.col("order_status").alias("status"),
        numeric_text(F.col("total")).alias("cents"),
    )


def _two_layouts(text):
    """The rows as files of two layouts: other column orders, and columns nobody asked for between the wanted ones."""
    urgent = F.col("`order.status`").isNull()
    note = F.concat(F.lit('a "quoted"\nline for '), F.col("`order key`"))
    first = text.filter(urgent).select("order key", note.alias("note"), "order-day", "`order.status`", "total")
    second = text.filter(~urgent).select("total", "`order.status`", F.lit("0").alias("other total"), "order-day", "order key")
    return first, second


def _write_tsv(part, path):
    part.write.mode("append").option("sep", "\t").option("header", True).option("escape", '"').csv(path)


@query("ingest_delimited", _ORDERS_BACK, dates=["day"])
def ingest_delimited_query(spark, sf):
    path = new_folder(spark, "orders-tsv")
    for part in _two_layouts(_order_text(spark, sf)):
        _write_tsv(part, path)
    return _orders_back(ingest_delimited(spark, path, ORDER_FILE))


@query("ingest_new_files", _ORDERS_BACK, dates=["day"])
def ingest_new_files_query(spark, sf):
    drop, kept, state = (new_folder(spark, n) for n in ("drop", "kept", "state"))
    for part in _two_layouts(_order_text(spark, sf)):
        _write_tsv(part, drop)
        ingest_new_files(spark, drop, ORDER_FILE, kept, state)
    return _orders_back(spark.read.parquet(kept))


@query(
    "reject_counts",
    """SELECT 'order_file' AS source, count(*) FILTER (o_orderkey % 10 <> 0) AS good, count(*) FILTER (o_orderkey % 10 = 0) AS rejected,
  count(*) AS delivered, count(*) FILTER (o_orderkey % 10 = 5) AS bad_total FROM orders""",
)
def reject_counts(spark, sf):
    # Every tenth order has a cell too many; the total of every tenth other one is no number.
    path = new_folder(spark, "dirty")
    key = F.col("`order key`").cast("long")
    total = F.when(key % 10 == 5, F.lit("n/a")).otherwise(F.col("total"))
    cells = [F.coalesce(c, F.lit("")) for c in (F.col("`order key`"), F.col("`order-day`"), F.col("`order.status`"), total)]
    line = F.concat_ws("\t", *cells, F.when(key % 10 == 0, F.lit("extra")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = _order_text(spark, sf).select(F.pmod(F.xxhash64("order key"), F.lit(parts)).alias("part"), line.alias("line"))
    # The header is a file's first line: one goes into each part, whose rows are all in one task, as its smallest.
    header = spark.range(parts).select(F.col("id").alias("part"), F.lit("\t".join(["order key", "order-day", "order.status", "total"])).alias("line"))
    rows = text.unionByName(header).repartition(parts, "part").sortWithinPartitions("part", F.col("line").rlike("^[0-9]"))
    rows.write.partitionBy("part").text(path)
    raw = read_by_name(spark, f"{path}/*/*.txt", ORDER_FILE)
    counts = reject_summary(raw, "order_file", {"total": numeric_text(F.col("total"))})
    return counts.select("source", "good", "rejected", "delivered", F.col("lost.total").alias("bad_total"))


@query(
    "reject_reasons",
    """SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'cells do not fit the header' WHEN o_orderkey % 10 = 3 THEN 'order_day cannot be read'
    WHEN o_orderkey % 10 = 7 THEN 'order_key is missing' WHEN o_custkey % 50 = 0 THEN 'customer cannot be read' ELSE 'none' END AS reason,
  count(*) AS records, CAST(sum(CASE WHEN o_orderkey % 10 = 4 THEN 1 ELSE 0 END) AS BIGINT) AS unread_totals
FROM orders GROUP BY 1""",
)
def reject_reasons(spark, sf):
    # A cell too many, a date that is none, a blank key, a customer's code of six digits, a total that is no number.
    path = new_folder(spark, "dirty-keys")
    key = F.col("`order key`").cast("long")
    names = ["order key", "order-day", "customer", "total"]
    text = _order_text(spark, sf).join(table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("order key"), "o_custkey"), "order key")
    text = text.select(
        F.when(key % 10 != 7, F.col("order key")).alias("order key"),
        F.when(key % 10 == 3, "13/45/2021").otherwise(F.col("order-day")).alias("order-day"),
        F.when(F.col("o_custkey") % 50 == 0, F.lit("123456")).otherwise(F.lpad((F.col("o_custkey") % 99_999).cast("string"), 5, "0")).alias("customer"),
        F.when(key % 10 == 4, "n/a").otherwise(F.col("total")).alias("total"),
        (key % 10 == 0).alias("long"),
    )
    line = F.concat_ws("\t", *[F.coalesce(f"`{c}`", F.lit("")) for c in names], F.when(F.col("long"), "extra"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The header is a file's first line: one goes into each part, whose rows are all in one task, as its smallest.
    rows = text.select(F.pmod(F.xxhash64(line), F.lit(parts)).alias("part"), line.alias("line"), F.lit(1).alias("place"))
    header = spark.range(parts).select(F.col("id").alias("part"), F.lit("\t".join(names)).alias("line"), F.lit(0).alias("place"))
    rows.unionByName(header).repartition(parts, "part").sortWithinPartitions("part", "place").drop("place").write.partitionBy("part").text(path)
    raw = read_by_name(spark, f"{path}/*/*.txt", Contract("dirty", "orders", ("order_key", "order_day", "customer", "total"), sep="\t"))
    needed = {"order_key": None, "order_day": parse_date(F.col("order_day"), "MM/dd/yyyy"), "customer": repair_code(F.col("customer"), F.lit(1))}
    told = raw.withColumn("reason", F.coalesce(reject_reason(needed), F.lit("none")))
    unread = F.col("total").isNotNull() & numeric_text(F.col("total")).isNull()
    return told.groupBy("reason").agg(F.count(F.lit(1)).alias("records"), F.count_if(unread).alias("unread_totals"))


@query(
    "delivery_changes",
    """SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, 'new' AS change FROM orders WHERE year(o_orderdate) = 1995 OR year(o_orderdate) > 1996
UNION ALL SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER), 'gone' FROM orders WHERE year(o_orderdate) IN (1994, 1995)""",
)
def delivery_changes(spark, sf):
    # Orders delivered by year; of the next delivery one year has other files, one is left out and some are new.
    orders = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    first, second = (new_folder(spark, n) for n in ("delivered", "delivered"))
    orders.filter("year <= 1996").repartition("year").write.partitionBy("year").csv(first)
    orders.filter("year = 1995 OR year > 1996").repartition("year").write.partitionBy("year").csv(second)
    then = settle(list_files(spark, f"{first}/*/*.csv"), "listing")
    kept = then.filter(~F.col("path").rlike("year=(1994|1995)"))
    now = list_files(spark, f"{second}/*/*.csv").unionByName(kept)
    year = F.regexp_extract("path", "year=([0-9]+)", 1).cast("int")
    return differences(now, then).select(year.alias("year"), "change").distinct()


@query(
    "table_versions",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1""",
    dates=["month"],
)
def table_versions(spark, sf):
    # First the orders up to a month in the middle, that month with other prices; then the rows of the later months.
    path = new_folder(spark, "versions")
    cents = F.round(F.col("o_totalprice") * 100).cast("long").alias("cents")
    orders = table(spark, sf, "orders").select(F.to_date(F.trunc("o_orderdate", "month")).alias("month"), cents)
    since = F.lit("1997-06-01").cast("date")
    early = orders.filter(F.col("month") <= since).withColumn("cents", F.when(F.col("month") == since, 1).otherwise(F.col("cents")))
    publish(early, path, "month")
    late = orders.filter(F.col("month") >= since)
    # One row per month.
    months = [r["month"].isoformat() for r in late.select("month").distinct().collect()]
    publish(late, path, "month", months)
    return read_table(spark, path).groupBy("month").agg(F.count(F.lit(1)).alias("orders"), F.sum("cents").alias("cents"))


@query(
    "daily_files_union",
    f"""WITH {ND}
SELECT strftime(date_trunc('month', day), '%Y%m%d') AS "Date", CAST(nation AS VARCHAR) AS "FIPS", 'County, ' || nation AS "Admin2",
  CAST(n AS VARCHAR) AS "Confirmed", CAST(n_f AS VARCHAR) AS "Deaths"
FROM nd WHERE day >= DATE '1996-01-01'""",
)
def daily_files_union(spark, sf):
    # A writer names its folders but not its files, so each report is a folder here: one per month, two layouts.
    root = new_folder(spark, "daily")
    fields = ["FIPS", "Admin2", "Confirmed", "Deaths"]
    rows = nation_day(spark, sf).select(
        "day",
        F.date_format(F.trunc("day", "month"), "MM-dd-yyyy").alias("d"),
        F.col("nation").cast("string").alias("FIPS"),
        F.concat(F.lit("County, "), F.col("nation").cast("string")).alias("Admin2"),
        F.col("n").cast("string").alias("Confirmed"),
        F.col("n_f").cast("string").alias("Deaths"),
    )
    rows = rows.withColumn("file", F.concat("d", F.lit(".csv"))).repartition("file")
    old = rows.filter(F.year("day") < 1999).select("file", "Admin2", "Deaths", "FIPS", F.lit("x").alias("Extra"), "Confirmed")
    new = rows.filter(F.year("day") >= 1999).select("file", "FIPS", "Admin2", "Confirmed", "Deaths")
    for name, part in (("old", old), ("new", new)):
        part.write.option("header", True).option("quoteAll", True).partitionBy("file").csv(f"{root}/{name}")
    return ingest_daily_files(spark, f"{root}/*/*/*.csv", fields, "19960101", part=-2)


_CUSTOMERS_BACK = """SELECT CAST(c_custkey AS VARCHAR) AS cust_key, c_name AS name,
  CASE WHEN c_nationkey <> 3 THEN CAST(c_nationkey AS VARCHAR) END AS nation FROM customer"""


def _json_rows(spark, sf):
    # One document per thousand customers, each with its own header row.
    header = F.array(F.lit("cust key"), F.lit("name"), F.lit("nation"))
    row = F.array(F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_nationkey").cast("string"))
    # Rows of one nation end before their last cell, rows of another have a cell too many.
    row = F.when(F.col("c_nationkey") == 3, F.slice(row, 1, 2)).when(F.col("c_nationkey") == 4, F.concat(row, F.array(F.lit("x")))).otherwise(row)
    docs = (
        table(spark, sf, "customer")
        .groupBy(F.floor(F.col("c_custkey") / 1000))
        .agg(F.collect_list(row).alias("rows"))
        .select(F.to_json(F.concat(F.array(header), F.col("rows"))).alias("value"))
    )
    path = new_folder(spark, "json-rows")
    docs.write.option("maxRecordsPerFile", 1).text(path)
    return f"{path}/*.txt"


@query("json_rows_ingest", _CUSTOMERS_BACK)
def json_rows_ingest(spark, sf):
    return ingest_json_rows(spark, _json_rows(spark, sf), ["cust_key", "name", "nation"], "ISO-8859-1")


@query("json_rows_by_block", _CUSTOMERS_BACK)
def json_rows_by_block(spark, sf):
    # The same files read as long ones are.
    return ingest_json_rows(spark, _json_rows(spark, sf), ["cust_key", "name", "nation"], "ISO-8859-1", long_file=0)


@query(
    "quoted_breaks_by_block",
    """SELECT o_orderkey, 1 + o_orderkey % 5 AS breaks, 'a "quoted", ' || o_orderkey AS last_line, o_orderkey % 7 = 0 AS malformed
FROM orders""",
)
def quoted_breaks_by_block(spark, sf):
    # Notes of several lines, read as those of long files are; every seventh record has a cell too many.
    key = F.col("o_orderkey")
    breaks = (key % 5 + 1).cast("int")
    note = F.concat(F.repeat(F.lit("line,\n"), breaks), F.lit('a "quoted", '), key.cast("string"))
    cell = F.concat(F.lit('"'), F.replace(note, F.lit('"'), F.lit('""')), F.lit('"'))
    lines = table(spark, sf, "orders").select(key.alias("k"), F.concat_ws(",", key.cast("string"), cell, F.when(key % 7 == 0, "more")).alias("line"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = lines.select(F.pmod(F.xxhash64("k"), F.lit(parts)).alias("part"), "line", F.lit(1).alias("place"))
    header = spark.range(parts).select(F.col("id").alias("part"), F.lit('k,"a, note"').alias("line"), F.lit(0).alias("place"))
    path = new_folder(spark, "quoted")
    rows.unionByName(header).repartition(parts, "part").sortWithinPartitions("part", "place").drop("place").write.partitionBy("part").text(path)
    raw = read_layout(spark, f"{path}/*/*.txt", ["k", "note"], ",", "UTF-8", True, "file", long=True)
    return raw.select(
        F.col("k").cast("long").alias("o_orderkey"),
        (F.length("note") - F.length(F.replace("note", F.lit("\n")))).cast("long").alias("breaks"),
        F.substring_index("note", "\n", -1).alias("last_line"),
        F.col(MALFORMED).isNotNull().alias("malformed"),
    )




_FEATURES_JOINED = """SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(k AS VARCHAR), 9, '0') AS "FIPS",
  '{"type":"Point","id":' || k || '}' AS geometry, n, n IS NOT NULL AS has_info
FROM (SELECT c_nationkey, c_custkey AS k FROM customer UNION ALL SELECT c_nationkey, 900000000 + c_custkey FROM customer WHERE c_custkey % 10 = 0)
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = k"""


def _collections(spark, sf):
    """Feature collections as texts, and the figures to join."""
    state = F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
    county = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    # Some outlines have codes that no customer has.
    unknown = customer.filter("c_custkey % 10 = 0").withColumn("c_custkey", F.col("c_custkey") + 900_000_000)
    feature = F.struct(
        F.struct(state.alias("STATE"), county.alias("COUNTY")).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.col("c_custkey").alias("id")).alias("geometry"),
    )
    # A feature collection per thousand customers.
    docs = (
        customer.unionByName(unknown)
        .groupBy(F.floor(F.col("c_custkey") / 1000))
        .agg(F.collect_list(feature).alias("features"))
        .select(F.to_json(F.struct("features")).alias("value"))
    )
    metrics = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n"))
        .join(customer, "c_custkey")
        .select(F.concat(state, county).alias("FIPS"), "n")
    )
    return docs, metrics


@query("feature_left_join", _FEATURES_JOINED)
def feature_left_join(spark, sf):
    docs, metrics = _collections(spark, sf)
    return join_features(features(docs), metrics, "FIPS")


@query("features_by_block", _FEATURES_JOINED)
def features_by_block(spark, sf):
    # The collections as files that several tasks may read each.
    docs, metrics = _collections(spark, sf)
    path = new_folder(spark, "features")
    docs.write.option("maxRecordsPerFile", 1).text(path)
    return join_features(read_features(spark, f"{path}/*.txt"), metrics, "FIPS")


@query(
    "table_fingerprint",
    """SELECT count(*) AS table_rows, true AS same_after_shuffle, false AS same_after_edit, false AS same_with_copy,
  false AS same_after_move, false AS same_after_rename FROM orders""",
)
def table_fingerprint(spark, sf):
    orders = table(spark, sf, "orders")
    shuffled = orders.repartition(3, "o_custkey").select(*reversed(orders.columns))
    edited = orders.withColumn(
        "o_orderpriority", F.when(F.col("o_orderkey") == 1, "0-NONE").otherwise(F.col("o_orderpriority"))
    )
    copied = orders.unionByName(orders.filter("o_orderkey = 1"))
    # A value that stands in the neighbouring column, which is blank, and the other way round.
    left = orders.select("o_orderkey", F.col("o_custkey").alias("a"), F.lit(None).cast("long").alias("b"))
    right = orders.select("o_orderkey", F.lit(None).cast("long").alias("a"), F.col("o_custkey").alias("b"))
    checks = {
        "same_after_move": same_content(left, right),
        "same_after_rename": same_content(orders, orders.withColumnRenamed("o_custkey", "o_by")),
        "same_after_shuffle": same_content(orders, shuffled),
        "same_after_edit": same_content(orders, edited),
        "same_with_copy": same_content(orders, copied),
    }
    return orders.agg(F.count(F.lit(1)).alias("table_rows"), *[F.lit(v).alias(k) for k, v in checks.items()])


_ND_TEXT = f"""WITH {ND} SELECT nation, day, n, nullif(n_f, 0) AS n_f FROM nd"""


def _exported(spark, sf):
    return nation_day(spark, sf).select("nation", "day", "n", F.nullif(F.col("n_f"), F.lit(0)).alias("n_f"))


SHAPE = "nation int, day date, n long, n_f long"


@query("export_tsv", _ND_TEXT, dates=["day"])
def export_tsv(spark, sf):
    path = new_folder(spark, "export-tsv")
    write_tsv(_exported(spark, sf), path, ["nation", "day"])
    return spark.read.schema(SHAPE).option("header", True).option("sep", "\t").csv(path)


@query("export_json", _ND_TEXT, dates=["day"])
def export_json(spark, sf):
    path = new_folder(spark, "export-json")
    write_json(_exported(spark, sf), path, ["nation", "day"])
    return spark.read.schema(SHAPE).json(path)


@query("export_json_array", _ND_TEXT, dates=["day"])
def export_json_array(spark, sf):
    path = new_folder(spark, "export-json-array")
    write_json_array(_exported(spark, sf), path, ["nation", "day"])
    line = F.regexp_replace("value", r"^\[|[,\]]$", "")
    return spark.read.text(path).select(F.from_json(line, SHAPE).alias("r")).select("r.*")


@query("export_table", _ND_TEXT, dates=["day"])
def export_table(spark, sf):
    path = new_folder(spark, "export-table")
    write_table(_exported(spark, sf).withColumn("year", F.year("day")), path, ["year"])
    return spark.read.parquet(path).drop("year")
