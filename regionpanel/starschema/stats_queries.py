"""Correlations, lines, histograms and quantiles on orders, customers and nation-days."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.panel import lagged_pair
from ..operators.ranks import global_position, quantiles
from ..operators.stats import corr_by, corr_matrix, equal_width_edges, fit_line, histogram, log1p_columns
from .registry import query
from .tables import ND, nation_day, table


def _corr(x: str, y: str) -> str:
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"


@query(
    "corr_by_date",
    f"""WITH {ND} SELECT day, {_corr("n", "cents")} AS corr FROM nd GROUP BY 1""",
    dates=["day"],
    doubles=["corr"],
)
def corr_by_date(spark, sf):
    return corr_by(nation_day(spark, sf), "day", "n", "cents")


@query(
    "corr_by_date_lagged",
    f"""WITH {ND}, pairs AS (SELECT a.day, a.n, b.cents FROM nd a JOIN nd b ON a.nation = b.nation AND b.day = a.day + 14)
SELECT day, {_corr("n", "cents")} AS corr FROM pairs GROUP BY 1""",
    dates=["day"],
    doubles=["corr"],
)
def corr_by_date_lagged(spark, sf):
    # Cases of a day against deaths two weeks later.
    return corr_by(lagged_pair(nation_day(spark, sf), "nation", "day", "n", "cents", 14), "day", "n", "cents")


@query(
    "corr_by_date_lagged_back",
    f"""WITH {ND}, pairs AS (SELECT a.day, a.n, b.cents FROM nd a JOIN nd b ON a.nation = b.nation AND b.day = a.day - 14)
SELECT day, {_corr("n", "cents")} AS corr FROM pairs GROUP BY 1""",
    dates=["day"],
    doubles=["corr"],
)
def corr_by_date_lagged_back(spark, sf):
    # The same with the pairing turned round: each day against two weeks earlier.
    return corr_by(lagged_pair(nation_day(spark, sf), "nation", "day", "n", "cents", -14), "day", "n", "cents")


def customer_figures(spark, sf):
    """Orders, spending in thousands and balance per customer, one outlying customer left out."""
    totals = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.sum(F.round(F.col("o_totalprice") * 100).cast("long")) / F.lit(100000.0)).alias("spent"),
        )
    )
    customers = table(spark, sf, "customer").filter("c_custkey <> 1")
    return customers.join(totals, "c_custkey").select("c_custkey", "n", "spent", F.col("c_acctbal").alias("balance"))


_FIGURES = """figures AS (
  SELECT c_custkey, n, spent, c_acctbal AS balance FROM customer JOIN (
    SELECT o_custkey, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / 100000.0 AS spent FROM orders GROUP BY 1)
  ON o_custkey = c_custkey WHERE c_custkey <> 1)"""


def _matrix_sql(source: str) -> str:
    pairs = (("n", "spent"), ("n", "balance"), ("spent", "balance"))
    return " UNION ALL ".join(f"SELECT '{x}' AS x, '{y}' AS y, {_corr(x, y)} AS corr FROM {source}" for x, y in pairs)


@query("corr_attribute", f"""WITH {_FIGURES} {_matrix_sql("figures")}""", doubles=["corr"])
def corr_attribute(spark, sf):
    return corr_matrix(customer_figures(spark, sf), ["n", "spent", "balance"])


@query(
    "corr_log1p",
    f"""WITH {_FIGURES}, logs AS (SELECT ln(1 + n) AS n, ln(1 + spent) AS spent, ln(1 + balance) AS balance FROM figures WHERE balance > -1)
{_matrix_sql("logs")}""",
    doubles=["corr"],
)
def corr_log1p(spark, sf):
    columns = ["n", "spent", "balance"]
    # The logarithm needs a balance above -1; nothing else does.
    return corr_matrix(log1p_columns(customer_figures(spark, sf).filter("balance > -1"), columns), columns)


@query(
    "regression_line",
    f"""WITH {_FIGURES} SELECT count(*) AS points, covar_pop(n, spent) / nullif(var_pop(spent), 0) AS slope,
  avg(n) - covar_pop(n, spent) / nullif(var_pop(spent), 0) * avg(spent) AS intercept FROM figures""",
    doubles=["slope", "intercept"],
)
def regression_line(spark, sf):
    return fit_line(customer_figures(spark, sf), "spent", "n")


@query(
    "histogram_edges",
    """SELECT CAST(least(floor(p / 25), 39) AS INTEGER) AS bin, least(floor(p / 25), 39) * 25.0 AS bin_from,
  least(floor(p / 25), 39) * 25.0 + 25.0 AS bin_to, count(*) AS n
FROM (SELECT o_totalprice / 400 AS p FROM orders) WHERE p BETWEEN 0 AND 1000 GROUP BY ALL""",
    doubles=["bin_from", "bin_to"],
)
def histogram_edges(spark, sf):
    orders = table(spark, sf, "orders").select((F.col("o_totalprice") / 400).alias("p"))
    return histogram(orders, "p", range(0, 1001, 25))


@query(
    "histogram_by_limit",
    """SELECT b.i AS bin, CAST(b.i * 100 AS DOUBLE) AS bin_from, CAST(b.i * 100 + 100 AS DOUBLE) AS bin_to,
  (SELECT count(*) FROM lineitem WHERE l_extendedprice / 50 >= b.i * 100 AND (l_extendedprice / 50 < b.i * 100 + 100 OR (b.i = 9 AND l_extendedprice / 50 = 1000))) AS n
FROM (SELECT CAST(i AS INTEGER) AS i FROM range(10) t(i)) b""",
    doubles=["bin_from", "bin_to"],
)
def histogram_by_limit(spark, sf):
    lines = table(spark, sf, "lineitem").select((F.col("l_extendedprice") / 50).alias("p"))
    return histogram(lines, "p", range(0, 1001, 100))


@query(
    "equal_width_edges",
    """WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT CAST(i AS INTEGER) AS edge_no, lo + (hi - lo) / 5 * i - CASE WHEN i = 0 THEN (hi - lo) * 0.001 ELSE 0 END AS edge FROM r, range(6) t(i)""",
    doubles=["edge"],
)
def equal_width_edges_query(spark, sf):
    return equal_width_edges(table(spark, sf, "orders"), "o_totalprice", 5)


@query(
    "quantile_median",
    """SELECT quantile_disc(o_totalprice, 0.2) AS q20, quantile_disc(o_totalprice, 0.9) AS q90, median(o_totalprice) AS median FROM orders""",
    doubles=["q20", "q90", "median"],
)
def quantile_median(spark, sf):
    return quantiles(table(spark, sf, "orders"), "o_totalprice", {"q20": 0.2, "q90": 0.9}, "median")


@query(
    "quantile_narrowed",
    """SELECT quantile_disc(l_extendedprice, 0.01) AS q01, quantile_disc(l_extendedprice, 0.25) AS q25,
  quantile_disc(l_extendedprice, 0.75) AS q75, quantile_disc(l_extendedprice, 0.99) AS q99, median(l_extendedprice) AS median FROM lineitem""",
    doubles=["q01", "q25", "q75", "q99", "median"],
)
def quantile_narrowed(spark, sf):
    # Few cuts a round, so that every rank is narrowed over many rounds.
    probs = {"q01": 0.01, "q25": 0.25, "q75": 0.75, "q99": 0.99}
    return quantiles(table(spark, sf, "lineitem"), "l_extendedprice", probs, "median", cuts=20, pick=100)


@query(
    "quantile_ties",
    """WITH flags AS (SELECT CAST(o_totalprice > (SELECT quantile_disc(o_totalprice, 0.5) FROM orders) AS INTEGER) AS dear FROM orders)
SELECT quantile_disc(dear, 0.2) AS q20, quantile_disc(dear, 0.5) AS q50, quantile_disc(dear, 0.51) AS q51, quantile_disc(dear, 0.8) AS q80,
  median(dear) AS median FROM flags""",
    doubles=["median"],
)
def quantile_ties(spark, sf):
    # Two values with the median on their border.
    orders = table(spark, sf, "orders").select("o_totalprice")
    middle = quantiles(orders, "o_totalprice", {"cut": 0.5}).select("cut").scalar()
    flags = orders.select((F.col("o_totalprice") > middle).cast("int").alias("dear"))
    return quantiles(flags, "dear", {"q20": 0.2, "q50": 0.5, "q51": 0.51, "q80": 0.8}, "median", cuts=4, pick=1)


@query(
    "global_position",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderkey DESC) AS position FROM orders""",
)
def global_position_query(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return global_position(orders, [F.col("o_orderpriority"), F.col("o_orderkey").desc()]).select("o_orderkey", "position")
