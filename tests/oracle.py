"""Run registered queries next to their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, Decimal):
        return f"decimal {v}"
    return repr(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir) -> str:
    """Empty when equal, else what differs."""
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} != {sorted(want_names)}"
    if not want:
        return "no rows to compare"
    a, b = _rows(df.columns, got), _rows(want_names, want)
    if a != b:
        only_a, only_b = list((a - b).items())[:3], list((b - a).items())[:3]
        return f"rows {len(got)} / {len(want)}\n   spark only {only_a}\n   sql only   {only_b}"
    return ""


def main(argv: list[str]) -> int:
    from regionpanel.session import local_session
    from regionpanel.starschema import QUERIES, SQL

    sf_dir, wanted = argv[0], argv[1:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        began = time.perf_counter()
        try:
            if name in SQL:
                problem = compare(spark, con, name, fn, SQL[name], sf_dir)
                n = "ok"
            else:
                problem, n = "", f"rows only: {fn(spark, sf_dir).count()}"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += bool(problem)
        print(f"{name:28s} {time.perf_counter() - began:6.2f}s  {problem or n}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
