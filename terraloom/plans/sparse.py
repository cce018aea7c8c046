"""Sparse feature rows over columns with as many values as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.operators import encode, sparse
from terraloom.plans.common import snap, sql_snap, table

NUMS, CATS = ["c_acctbal"], ["c_name", "c_mktsegment"]
STEPS = 5


def _encoded(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    customer = table(spark, sf, "customer").select("c_custkey", *NUMS, *CATS)
    scaler, vocabulary = encode.fit_scaler(customer, NUMS), encode.fit_vocabulary(customer, CATS)
    return sparse.encode(customer, "c_custkey", NUMS, CATS, scaler, vocabulary), scaler, vocabulary


def sparse_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Encoded and decoded again, with a name for every row."""
    rows, scaler, vocabulary = _encoded(spark, sf)
    back = sparse.decode(rows, ["c_custkey"], NUMS, CATS, scaler, vocabulary)
    return back.select("c_custkey", snap(F.col("c_acctbal")).alias("c_acctbal"), *CATS)


ROUNDTRIP_SQL = f"SELECT c_custkey, {sql_snap('c_acctbal')} AS c_acctbal, c_name, c_mktsegment FROM customer"


def sparse_recovered(spark: SparkSession, sf: str) -> DataFrame:
    """Noise added at every step but the last, which leaves nothing, taken away again and decoded."""
    rows, scaler, vocabulary = _encoded(spark, sf)
    noisy = sparse.add_noise(rows, "c_custkey", STEPS).where(F.col("step") < STEPS - 1)
    back = sparse.decode(sparse.recover(noisy, "c_custkey"), ["c_custkey", "step"], NUMS, CATS, scaler, vocabulary, "recovered")
    return back.select("c_custkey", "step", snap(F.col("c_acctbal"), 4).alias("c_acctbal"), *CATS)


RECOVERED_SQL = f"""
SELECT c_custkey, CAST(unnest(range(0, {STEPS - 1})) AS INTEGER) AS step, {sql_snap('c_acctbal', 4)} AS c_acctbal, c_name, c_mktsegment FROM customer
"""


def sparse_slots_used(spark: SparkSession, sf: str) -> DataFrame:
    """The triples themselves."""
    rows, _, _ = _encoded(spark, sf)
    return rows.select("c_custkey", "col", "idx", snap(F.col("value"), 9).alias("value"))


SLOTS_SQL = f"""
WITH v AS (
  SELECT 'c_name' AS col, c_name AS value, row_number() OVER (ORDER BY c_name) - 1 AS idx FROM (SELECT DISTINCT c_name FROM customer)
  UNION ALL SELECT 'c_mktsegment', c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 FROM (SELECT DISTINCT c_mktsegment FROM customer))
SELECT c_custkey, col, idx::INTEGER AS idx, 1e0 AS value FROM customer JOIN v ON (col = 'c_name' AND value = c_name) OR (col = 'c_mktsegment' AND value = c_mktsegment)
UNION ALL SELECT c_custkey, 'c_acctbal', 0::INTEGER, {sql_snap('(c_acctbal - low) / (high - low)', 9)} FROM customer, (SELECT min(c_acctbal) AS low, max(c_acctbal) AS high FROM customer)
"""


def sparse_noisy_best(spark: SparkSession, sf: str) -> DataFrame:
    """The segment that scores best at every step once noise falls on all slots, noise that both engines can build."""
    rows, _, vocabulary = _encoded(spark, sf)
    widths = vocabulary.where(F.col("col") == "c_mktsegment").groupBy("col").agg(F.count("*").alias("width"))

    def noise(key, step, col, idx):
        return F.sin(key * 37 + idx * 11 + step) * 1.4

    noisy = sparse.add_noise(rows.where(F.col("col") == "c_mktsegment"), "c_custkey", STEPS, noise)
    best = sparse.noisy_best(noisy, "c_custkey", widths, noise)
    return best.select("c_custkey", "step", "idx", snap(F.col("value"), 8).alias("value"))


NOISY_SQL = f"""
WITH v AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS idx FROM (SELECT DISTINCT c_mktsegment FROM customer)),
steps AS (SELECT step, cos((step / {STEPS - 1}e0 + 0.008e0) / 1.008e0 * pi() / 2) ** 2 AS alpha FROM (SELECT unnest(range(0, {STEPS})) AS step)),
scored AS (
  SELECT c_custkey, step, v.idx, CASE WHEN v.c_mktsegment = c.c_mktsegment THEN sqrt(alpha) ELSE 0 END + sqrt(1 - alpha) * sin(c_custkey * 37 + v.idx * 11 + step) * 1.4e0 AS x
  FROM customer c, v, steps)
SELECT c_custkey, step::INTEGER AS step, idx::INTEGER AS idx, {sql_snap('x', 8)} AS value FROM scored
QUALIFY row_number() OVER (PARTITION BY c_custkey, step ORDER BY x DESC, idx) = 1
"""

QUERIES = {
    "sparse_roundtrip": (sparse_roundtrip, ROUNDTRIP_SQL),
    "sparse_recovered": (sparse_recovered, RECOVERED_SQL),
    "sparse_slots_used": (sparse_slots_used, SLOTS_SQL),
    "sparse_noisy_best": (sparse_noisy_best, NOISY_SQL),
}
