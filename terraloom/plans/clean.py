"""Cleaning, numeric detection, hash encoding and collision audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.functions import numeric, text
from terraloom.functions.hashing import hash_bucket
from terraloom.operators import clean, collisions, columns
from terraloom.plans.common import big, snap, sql_snap, table


def _master(spark: SparkSession, sf: str) -> DataFrame:
    """A farmer-like master table: one row per order, with repeats, zeros and gaps."""
    rows = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    step = F.floor(F.col("o_totalprice") / 100000).cast("double")
    month = F.month("o_orderdate")
    return rows.select(
        F.col("o_orderkey").alias("row_id"), F.col("n_name").alias("FarmerID"), F.col("c_mktsegment").alias("Location"),
        F.col("o_orderpriority").alias("Address type"), F.col("o_orderstatus").alias("Ownership"),
        F.col("n_name").alias("VILLAGE"), F.col("r_name").alias("DISTRICT"), F.col("r_name").alias("State"),
        F.col("c_nationkey").cast("string").alias("CITY"), F.col("c_mktsegment").alias("SEX"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("MARITAL_STATUS"),
        F.when(step < 4, step).alias(clean.TARGET),
        F.nullif(month, F.lit(5)).cast("double").alias("Perc_of_house_with_6plus_room"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.quarter("o_orderdate").cast("double")).alias("Total_Land_For_Agriculture"),
        F.when(month != 12, (month % 4).cast("double")).alias(clean.LOANS),
        F.year("o_orderdate").cast("double").alias(clean.LOAN_AMOUNT),
    )


def clean_master(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_master(_master(spark, sf))


_BUCKET_256 = "CAST('0x' || substr(sha256({c}), 35, 2) AS BIGINT)"
CLEAN_SQL = f"""
WITH m AS (
  SELECT o_orderkey AS row_id, n_name AS FarmerID, c_mktsegment AS Location, o_orderpriority AS "Address type",
         o_orderstatus AS Ownership, n_name AS VILLAGE, r_name AS DISTRICT, r_name AS State,
         CAST(c_nationkey AS VARCHAR) AS CITY, c_mktsegment AS SEX,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS MARITAL_STATUS,
         CASE WHEN o_totalprice < 400000 THEN floor(o_totalprice / 100000) END AS target,
         CAST(nullif(month(o_orderdate), 5) AS DOUBLE) AS perc,
         CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(quarter(o_orderdate) AS DOUBLE) END AS land,
         CASE WHEN month(o_orderdate) <> 12 THEN CAST(month(o_orderdate) % 4 AS DOUBLE) END AS loans,
         CAST(year(o_orderdate) AS DOUBLE) AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
), d AS (
  SELECT min(row_id) AS row_id, * EXCLUDE (row_id) FROM m GROUP BY ALL
)
SELECT row_id, VILLAGE, DISTRICT, State, CAST(CITY AS BIGINT) AS CITY, target AS "{clean.TARGET}",
       perc AS "Perc_of_house_with_6plus_room", land AS "Total_Land_For_Agriculture", loans AS "{clean.LOANS}",
       CASE WHEN loans = 0 THEN 0 ELSE amount END AS "{clean.LOAN_AMOUNT}",
       {_BUCKET_256.format(c='SEX')} AS SEX, {_BUCKET_256.format(c='MARITAL_STATUS')} AS MARITAL_STATUS
FROM d WHERE (target <> 0 OR target IS NULL) AND perc IS NOT NULL AND land IS NOT NULL
"""


def numeric_detect(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        F.get_json_object("props", "$.k").alias("k"), F.col("value").cast("string").alias("value"),
        "event_type",
        F.when(F.col("event_type") != "view", F.lit("1")).alias("gaps"),
        F.when(F.col("event_type") == "click", F.lit("12d")).otherwise("12").alias("mixed"),
    )
    return columns.numeric_columns(events, ["k", "value", "event_type", "gaps", "mixed"])


NUMERIC_SQL = """
WITH e AS (
  SELECT json_extract_string(props, '$.k') AS k, CAST(value AS VARCHAR) AS value, event_type,
         CASE WHEN event_type <> 'view' THEN '1' END AS gaps,
         CASE WHEN event_type = 'click' THEN '12d' ELSE '12' END AS mixed
  FROM events
), long AS (
  SELECT unnest(['k', 'value', 'event_type', 'gaps', 'mixed']) AS "column", unnest([k, value, event_type, gaps, mixed]) AS v FROM e
)
SELECT "column", bool_and(try_cast(v AS DOUBLE) IS NOT NULL) AS numeric,
       bool_and(try_cast(v AS DOUBLE) IS NOT NULL AND NOT contains(v, '.')) AS integral
FROM long GROUP BY "column"
"""


def prefix_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose mixed texts start with a number: the tolerant parse of coordinates."""
    parts = table(spark, sf, "part").select(
        "p_partkey",
        numeric.parse_prefix_number(F.concat(F.col("p_size").cast("string"), F.lit(" "), F.col("p_type"))).alias("lat"),
        numeric.parse_prefix_number(
            F.when(F.col("p_type") == "ECONOMY", F.col("p_name")).otherwise(F.concat(F.lit("-"), F.col("p_retailprice").cast("string"), F.lit("E")))
        ).alias("lon"),
    )
    return parts.dropna(how="any", subset=["lat", "lon"])


PREFIX_SQL = """
SELECT p_partkey, CAST(p_size AS DOUBLE) AS lat, -p_retailprice AS lon FROM part WHERE p_type <> 'ECONOMY'
"""


def _hash_query(n_buckets: int, prefix_bytes: int = 18):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        parts = table(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
        return clean.hash_encode(parts, ["p_type", "p_brand"], n_buckets, prefix_bytes)
    return run


def hash_bucket_2e21(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", hash_bucket(F.col("c_name"), 2**21, 8).alias("bucket")
    )


def hash_bucket_odd(spark: SparkSession, sf: str) -> DataFrame:
    """Moduli that are no power of two, over both prefix lengths."""
    return table(spark, sf, "customer").select(
        "c_custkey", hash_bucket(F.col("c_name"), 1000, 18).alias("mod_1000"),
        hash_bucket(F.col("c_name"), 999_983, 8).alias("mod_prime"),
    )


def _halves(n: int) -> str:
    """144 bits as two 72-bit halves."""
    high = "CAST('0x' || substr(h, 1, 18) AS HUGEINT)"
    low = "CAST('0x' || substr(h, 19, 18) AS HUGEINT)"
    return f"CAST((({high} % {n}) * {2**72 % n} + {low}) % {n} AS BIGINT)"


HASH_ODD_SQL = f"""
SELECT c_custkey, {_halves(1000)} AS mod_1000, CAST(CAST('0x' || substr(h, 1, 16) AS HUGEINT) % 999983 AS BIGINT) AS mod_prime
FROM (SELECT c_custkey, sha256(c_name) AS h FROM customer)
"""


def collision_audit(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    audit = collisions.collision_audit(customers, F.col("c_name"), n_buckets=2**13)
    return audit.withColumn("surplus_percent", snap(F.col("surplus_percent")))


AUDIT_SQL = f"""
WITH b AS (
  SELECT CAST('0x' || substr(sha256(c_name), 9, 8) AS BIGINT) % 8192 AS bucket, count(*) AS n FROM customer GROUP BY 1
)
SELECT CAST(sum(n) AS BIGINT) AS "values", count(*) FILTER (WHERE n > 1) AS collision_buckets,
       CAST(sum(n - 1) AS BIGINT) AS surplus, {sql_snap('sum(n - 1) * 100.0 / sum(n)')} AS surplus_percent
FROM b
"""


def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """First copy of every text per language; a digest of the whole text is the key, so texts are not shuffled."""
    documents = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("digest"), "lang")
    return clean.dedup_keep_first(documents, "doc_id")


DEDUP_SQL = "SELECT min(doc_id) AS doc_id, sha256(text) AS digest, lang FROM documents GROUP BY text, lang"


def id_fallback(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    given = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).when(
        F.col("c_mktsegment") != "MACHINERY", F.col("c_name"))
    return rows.select("c_custkey", text.id_or_fallback(given, F.col("n_name"), F.col("c_nationkey")).alias("id"))


ID_SQL = """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN n_name || '_' || c_nationkey ELSE c_name END AS id
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def format_points(spark: SparkSession, sf: str) -> DataFrame:
    """One point literal per customer that has coordinates."""
    points = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("row_id"), F.col("c_nationkey").cast("double").alias("lon"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("lat"),
    ).dropna(how="any", subset=["lat", "lon"])
    return points.select("row_id", text.point_literal(F.col("row_id"), F.col("lon"), F.col("lat"), "Kharif_2021").alias("line"))


POINTS_SQL = """
SELECT c_custkey AS row_id,
       'ee.Feature(ee.Geometry.Point([' || CAST(c_nationkey AS DOUBLE) || ', ' || c_acctbal || ']), {id: ''' || c_custkey || '_Kharif_2021''}),' AS line
FROM customer WHERE c_acctbal >= 0
"""


def pct_encode(spark: SparkSession, sf: str) -> DataFrame:
    """Percent-encoded addresses and whole document texts."""
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.lit("part").alias("source"),
        text.percent_encode(text.compose_address(["p_name", "p_type", F.lit("a/b~c*")])).alias("encoded"),
    )
    documents = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.lit("document").alias("source"),
        F.sha2(text.percent_encode(F.col("text")), 256).alias("encoded"),
    )
    return parts.unionByName(documents)


PCT_SQL = """
SELECT p_partkey AS id, 'part' AS source, replace(url_encode(p_name || ', ' || p_type || ', a/b~c*'), '%2F', '/') AS encoded FROM part
UNION ALL
SELECT doc_id, 'document', sha256(replace(url_encode(text), '%2F', '/')) FROM documents
"""

_BUCKET_2E32 = "CAST('0x' || substr(sha256({c}), 29, 8) AS BIGINT)"


def _hash_sql(pattern: str) -> str:
    return f"SELECT p_partkey, {pattern.format(c='p_type')} AS p_type, {pattern.format(c='p_brand')} AS p_brand FROM part"


def count_values(spark: SparkSession, sf: str) -> DataFrame:
    """Values per hash bucket."""
    return collisions.bucket_counts(table(spark, sf, "lineitem"), F.concat_ws("_", "l_partkey", "l_suppkey"), 2**12).select(
        "bucket", big(F.col("n")).alias("n"))


COUNT_SQL = """
SELECT CAST('0x' || substr(sha256(l_partkey || '_' || l_suppkey), 9, 8) AS BIGINT) % 4096 AS bucket, count(*) AS n
FROM lineitem GROUP BY 1
"""

QUERIES = {
    "clean_master": (clean_master, CLEAN_SQL),
    "numeric_detect": (numeric_detect, NUMERIC_SQL),
    "prefix_numbers": (prefix_numbers, PREFIX_SQL),
    "hash_encode_256": (_hash_query(256), _hash_sql(_BUCKET_256)),
    "hash_encode_2e32": (_hash_query(2**32), _hash_sql(_BUCKET_2E32)),
    "hash_bucket_2e21": (hash_bucket_2e21, "SELECT c_custkey, CAST('0x' || substr(sha256(c_name), 9, 8) AS BIGINT) % 2097152 AS bucket FROM customer"),
    "hash_bucket_odd": (hash_bucket_odd, HASH_ODD_SQL),
    "bucket_counts": (count_values, COUNT_SQL),
    "collision_audit": (collision_audit, AUDIT_SQL),
    "dedup_keep_first": (dedup_keep_first, DEDUP_SQL),
    "id_fallback": (id_fallback, ID_SQL),
    "format_points": (format_points, POINTS_SQL),
    "pct_encode": (pct_encode, PCT_SQL),
}
