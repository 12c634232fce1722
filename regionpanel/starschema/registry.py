"""Named queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def comparable(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to so many places and dates as ISO text, so that two engines print the same values."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, places)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(
    name: str, sql: str | None = None, dates: Sequence[str] = (), doubles: Sequence[str] = (), places: int = 6
) -> Callable[[Query], Query]:
    """Register a query; ``dates`` and ``doubles`` name the columns the SQL side has to bring to the same form.

    More ``places`` are for means that can end exactly on a half at the sixth, where the order of adding decides.
    """

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(spark, sf_dir), places)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            # Adding 0.0 turns a rounded -0.0 into 0.0.
            same = [f"CAST({d} AS VARCHAR) AS {d}" for d in dates]
            same += [f"round({d}, {places}) + 0.0 AS {d}" for d in doubles]
            SQL[name] = f"SELECT * REPLACE ({', '.join(same)}) FROM ({sql}) AS result" if same else sql
        return run

    return register
