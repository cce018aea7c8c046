"""Target profiles of the orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.operators import profile
from terraloom.plans.common import snap, sql_snap, table


def box_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Log order value per priority and per status."""
    orders = profile.log_target(table(spark, sf, "orders"), "o_totalprice")
    boxes = profile.box_summary(orders, "o_totalprice", ["o_orderpriority", "o_orderstatus"])
    return boxes.select("col", "value", "n", *[
        snap(F.col(c)).alias(c) for c in ("q1", "median", "q3", "low_whisker", "high_whisker")], "outliers")


BOX_SQL = f"""
WITH long AS (
  SELECT 'o_orderpriority' AS col, o_orderpriority AS value, ln(o_totalprice) AS y FROM orders
  UNION ALL SELECT 'o_orderstatus', o_orderstatus, ln(o_totalprice) FROM orders
), q AS (
  SELECT col, value, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS med, quantile_cont(y, 0.75) AS q3 FROM long GROUP BY 1, 2
)
SELECT col, value, count(*) AS n, {sql_snap('any_value(q1)')} AS q1, {sql_snap('any_value(med)')} AS median, {sql_snap('any_value(q3)')} AS q3,
       {sql_snap('min(y) FILTER (WHERE y BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS low_whisker,
       {sql_snap('max(y) FILTER (WHERE y BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS high_whisker,
       count(*) FILTER (WHERE y NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM long JOIN q USING (col, value) GROUP BY col, value
"""


def bin_scatter(spark: SparkSession, sf: str) -> DataFrame:
    lines = profile.log_target(table(spark, sf, "lineitem"), "l_extendedprice")
    return profile.bin_scatter(lines, "l_extendedprice", ["l_quantity", "l_suppkey"], bins=8)


def _bin_sql(x: str, low: str, high: str) -> str:
    return f"CAST(least(floor(({x} - {low}) * 8e0 / ({high} - {low})) + 1, 8) AS INTEGER)"


SCATTER_SQL = f"""
WITH long AS (
  SELECT 'l_quantity' AS col, l_quantity AS x, ln(l_extendedprice) AS y FROM lineitem
  UNION ALL SELECT 'l_suppkey', CAST(l_suppkey AS DOUBLE), ln(l_extendedprice) FROM lineitem
), r AS (SELECT *, min(x) OVER w AS x0, max(x) OVER w AS x1, min(y) OVER w AS y0, max(y) OVER w AS y1 FROM long WINDOW w AS (PARTITION BY col))
SELECT col, {_bin_sql('x', 'x0', 'x1')} AS x_bin, {_bin_sql('y', 'y0', 'y1')} AS y_bin, count(*) AS n FROM r GROUP BY 1, 2, 3
"""


def target_correlation(spark: SparkSession, sf: str) -> DataFrame:
    lines = profile.log_target(table(spark, sf, "lineitem"), "l_extendedprice")
    found = profile.target_correlation(lines, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return found.select("col", snap(F.col("corr"), 8).alias("corr"))


CORR_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS col, {sql_snap(f'corr({c}, ln(l_extendedprice))', 8)} AS corr FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax"))


def log_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Log of the balances shifted so that zeros and negatives occur; edges are named, not lost."""
    customer = profile.log_target(table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", 0.0).otherwise(F.col("c_acctbal")).alias("balance")), "balance")
    y = F.col("balance")
    edge = F.when(F.isnan(y), "negative").when(y == float("-inf"), "zero").otherwise("finite")
    return customer.select("c_custkey", edge.alias("edge"), F.when(edge == "finite", snap(y, 6)).alias("log"))


EDGES_SQL = f"""
SELECT c_custkey, CASE WHEN b < 0 THEN 'negative' WHEN b = 0 THEN 'zero' ELSE 'finite' END AS edge,
       CASE WHEN b > 0 THEN {sql_snap('ln(greatest(b, 1e-9))')} END AS log
FROM (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 0e0 ELSE c_acctbal END AS b FROM customer)
"""


def _profiled(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_totalprice", "o_orderpriority", "o_custkey", F.col("o_orderstatus").alias("SEX"))


def profile_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Of the profiled columns, the text one; the excluded status column is left out."""
    boxes, _ = profile.profile_target(_profiled(spark, sf), "o_totalprice")
    return boxes.select("col", "value", "n", snap(F.col("median")).alias("median"), "outliers")


PROFILE_BOX_SQL = f"""
WITH long AS (SELECT 'o_orderpriority' AS col, o_orderpriority AS value, ln(o_totalprice) AS y FROM orders),
q AS (SELECT value, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS med, quantile_cont(y, 0.75) AS q3 FROM long GROUP BY 1)
SELECT col, value, count(*) AS n, {sql_snap('any_value(med)')} AS median,
       count(*) FILTER (WHERE y NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM long JOIN q USING (value) GROUP BY col, value
"""


def profile_scatter(spark: SparkSession, sf: str) -> DataFrame:
    return profile.profile_target(_profiled(spark, sf), "o_totalprice", bins=8)[1]


PROFILE_SCATTER_SQL = f"""
WITH long AS (SELECT 'o_custkey' AS col, CAST(o_custkey AS DOUBLE) AS x, ln(o_totalprice) AS y FROM orders),
r AS (SELECT *, min(x) OVER () AS x0, max(x) OVER () AS x1, min(y) OVER () AS y0, max(y) OVER () AS y1 FROM long)
SELECT col, {_bin_sql('x', 'x0', 'x1')} AS x_bin, {_bin_sql('y', 'y0', 'y1')} AS y_bin, count(*) AS n FROM r GROUP BY 1, 2, 3
"""

def scatter_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Twenty points of every bin of the balance, and of the customer number, against the log order value."""
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    logged = profile.log_target(orders.select("o_orderkey", "o_totalprice", "c_acctbal", "o_custkey"), "o_totalprice")
    points = profile.scatter_sample(logged, "o_totalprice", ["c_acctbal", "o_custkey"], "o_orderkey", per_bin=20, bins=8)
    return points.select("col", "x_bin", "o_orderkey", "x", snap(F.col("y")).alias("y"))


SAMPLE_SQL = f"""
WITH long AS (
  SELECT 'c_acctbal' AS col, o_orderkey, c_acctbal AS x, ln(o_totalprice) AS y FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT 'o_custkey', o_orderkey, CAST(o_custkey AS DOUBLE), ln(o_totalprice) FROM orders JOIN customer ON o_custkey = c_custkey
), r AS (SELECT *, min(x) OVER w AS x0, max(x) OVER w AS x1 FROM long WINDOW w AS (PARTITION BY col)),
binned AS (SELECT col, {_bin_sql('x', 'x0', 'x1')} AS x_bin, o_orderkey, x, y FROM r)
SELECT col, x_bin, o_orderkey, x, {sql_snap('y')} AS y FROM binned
QUALIFY row_number() OVER (PARTITION BY col, x_bin ORDER BY md5(col || ':' || o_orderkey)) <= 20
"""

QUERIES = {
    "scatter_sample": (scatter_sample, SAMPLE_SQL),
    "profile_boxes": (profile_boxes, PROFILE_BOX_SQL),
    "profile_scatter": (profile_scatter, PROFILE_SCATTER_SQL),
    "box_summary": (box_summary, BOX_SQL),
    "bin_scatter": (bin_scatter, SCATTER_SQL),
    "target_correlation": (target_correlation, CORR_SQL),
    "log_edges": (log_edges, EDGES_SQL),
}
