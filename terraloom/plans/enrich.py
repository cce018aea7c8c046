"""Resume, retry, upsert, checkpoints and first-match lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.functions import dates
from terraloom.operators import enrich, keys
from terraloom.operators.skew import HOT_ROWS
from terraloom.plans.common import table


def resume_anti(spark: SparkSession, sf: str) -> DataFrame:
    todo = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    done = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return enrich.skip_completed(todo, done, ["o_orderkey"])


RESUME_SQL = """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey = o.o_orderkey)
"""


def _responses(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a lookup response: an HTTP code and a list of hits."""
    k = F.get_json_object("props", "$.k").cast("int")
    http = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "signup", 429).otherwise(200)
    hits = F.when(k >= 50, F.array(F.struct(F.col("value").alias("lat"), k.cast("double").alias("lon"))))
    return table(spark, sf, "events").select("event_id", http.alias("http"), hits.alias("results"))


def response_status(spark: SparkSession, sf: str) -> DataFrame:
    first = F.get("results", F.lit(0))
    return _responses(spark, sf).withColumn(
        "status", enrich.response_status(F.col("http"), F.col("results"))
    ).select(
        "event_id", "status",
        F.when(F.col("status") == 200, first["lat"]).alias("lat"), F.when(F.col("status") == 200, first["lon"]).alias("lon"),
    )


_STATUS_SQL = """
SELECT event_id, CAST(CASE WHEN event_type = 'error' THEN 500 WHEN event_type = 'signup' THEN 429 WHEN k < 50 THEN 204 ELSE 200 END AS INTEGER) AS status,
       CASE WHEN event_type NOT IN ('error', 'signup') AND k >= 50 THEN value END AS lat,
       CASE WHEN event_type NOT IN ('error', 'signup') AND k >= 50 THEN CAST(k AS DOUBLE) END AS lon
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
"""


def retry_by_status(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.retry_rows(response_status(spark, sf)).select("event_id", "status")


RETRY_SQL = f"SELECT event_id, status FROM ({_STATUS_SQL}) WHERE status = 204"


def retry_by_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Without a status column, a missing latitude selects the rows."""
    return enrich.retry_rows(response_status(spark, sf).drop("status")).select("event_id")


RETRY_MISSING_SQL = f"SELECT event_id FROM ({_STATUS_SQL}) WHERE lat IS NULL"


def _old_new(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    old = customer.where(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("lat"),
        F.col("c_mktsegment").alias("tag"),
    )
    new = orders.where(F.col("o_orderpriority") == "1-URGENT").groupBy(F.col("o_custkey").alias("id")).agg(
        F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("lat"), F.max("o_orderstatus").alias("tag"),
    )
    return old, new


_OLD_NEW_SQL = """
old AS (SELECT c_custkey AS id, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS lat, c_mktsegment AS tag
        FROM customer WHERE c_mktsegment <> 'BUILDING'),
new AS (SELECT o_custkey AS id, max(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS lat, max(o_orderstatus) AS tag
        FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
"""


def _upsert(wins: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return enrich.upsert(*_old_new(spark, sf), ["id"], wins=wins)
    return run


UPSERT_SQL = {
    "new": f"WITH {_OLD_NEW_SQL} SELECT id, lat, tag FROM new UNION ALL SELECT id, lat, tag FROM old WHERE id NOT IN (SELECT id FROM new)",
    "existing": f"WITH {_OLD_NEW_SQL} SELECT id, lat, tag FROM old UNION ALL SELECT id, lat, tag FROM new WHERE id NOT IN (SELECT id FROM old)",
    "non_null": f"""WITH {_OLD_NEW_SQL} SELECT id, coalesce(new.lat, old.lat) AS lat, coalesce(new.tag, old.tag) AS tag
        FROM old FULL JOIN new USING (id)""",
}


def completed_keys(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _old_new(spark, sf)
    return enrich.completed_keys(old, new, keys=["id"])


COMPLETED_SQL = f"WITH {_OLD_NEW_SQL} SELECT id FROM old UNION SELECT id FROM new"


def latest_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    latest = enrich.latest_per_key(events, ["user_id"], ["ts", "event_id"])
    return latest.withColumn("ts", dates.epoch_micros(latest, "ts"))


LATEST_SQL = """
SELECT user_id, event_id, event_type, value, epoch_us(ts) AS ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id DESC) = 1
"""


def checkpoint_summary(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_type", "user_id", F.col("ts").alias("saved_at"))
    summary = enrich.checkpoint_summary(events, ["event_type"], "user_id")
    return summary.withColumn("saved_at", dates.epoch_micros(summary, "saved_at"))


SUMMARY_SQL = """
SELECT event_type, count(DISTINCT user_id) AS completed, epoch_us(max(ts)) AS saved_at FROM events GROUP BY 1
"""


def completion(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.completion(response_status(spark, sf))


COMPLETION_SQL = f"SELECT count(lat) AS filled, count(*) AS total FROM ({_STATUS_SQL})"


def recovery_summary(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    failed = orders.where(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("id"))
    recovered = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "A").select(F.col("l_orderkey").alias("id"))
    return enrich.recovery_summary(failed, recovered, ["id"])


RECOVERY_SQL = """
SELECT count(*) FILTER (WHERE ok) AS recovered, count(*) FILTER (WHERE NOT ok) AS still_failed
FROM (SELECT o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A') AS ok FROM orders WHERE o_orderstatus = 'P')
"""


def reindex_left(spark: SparkSession, sf: str) -> DataFrame:
    """Customers against the nations that have a rich supplier; the others find nothing."""
    rich = table(spark, sf, "supplier").where(F.col("s_acctbal") > 5000).select(F.col("s_nationkey").alias("c_nationkey"))
    lookup = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey").join(rich, "c_nationkey", "left_semi")
    return keys.reindex_left(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), lookup, "c_nationkey", hot_rows=HOT_ROWS)


REINDEX_SQL = """
SELECT c_custkey, c_nationkey, n_name, n_regionkey
FROM customer LEFT JOIN (
  SELECT * FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
) ON c_nationkey = n_nationkey
"""


def _places(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers to locate by nation and region, and a gazetteer made of the suppliers.

    Customers of one segment live in places the gazetteer does not know.
    """
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    master = table(spark, sf, "customer").join(named, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("row_id"),
        F.concat(F.upper("n_name"), F.when(F.col("c_mktsegment") == "BUILDING", " NEW TOWN").otherwise("")).alias("VILLAGE"),
        F.col("r_name").alias("DISTRICT"),
    )
    gazetteer = table(spark, sf, "supplier").join(named, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit(" "), F.lower("n_name"), F.lit(",  "), F.col("r_name")).alias("address"),
        F.col("s_acctbal").alias("lat"), F.col("s_suppkey").cast("double").alias("lon"), F.col("s_suppkey").alias("rank"),
    )
    return master, gazetteer


_FIRST_HIT_SQL = """
hit AS (SELECT s_nationkey, s_acctbal AS lat, CAST(s_suppkey AS DOUBLE) AS lon FROM supplier
        QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) = 1)
"""


def first_match_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.lookup_first(*_places(spark, sf), ["VILLAGE", "DISTRICT"])


LOOKUP_SQL = f"""
WITH {_FIRST_HIT_SQL}
SELECT c_custkey AS row_id, lat, lon, CAST(CASE WHEN s_nationkey IS NULL THEN 204 ELSE 200 END AS INTEGER) AS status
FROM customer LEFT JOIN hit ON c_nationkey = s_nationkey AND c_mktsegment <> 'BUILDING'
"""


def enrich_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a positive balance are done already; the others are looked up."""
    master, gazetteer = _places(spark, sf)
    done = table(spark, sf, "customer").where(F.col("c_mktsegment") != "FURNITURE").select(
        F.col("c_custkey").alias("row_id"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("lat"),
        F.when(F.col("c_acctbal") > 0, F.lit(1.0)).alias("lon"),
        F.when(F.col("c_acctbal") > 0, 200).otherwise(429).alias("status"),
    )
    return enrich.enrich_incremental(master, done, gazetteer, ["VILLAGE", "DISTRICT"])


ENRICH_SQL = f"""
WITH {_FIRST_HIT_SQL}
SELECT c_custkey AS row_id, CASE WHEN ready THEN c_acctbal ELSE lat END AS lat, CASE WHEN ready THEN 1e0 ELSE lon END AS lon,
       CAST(CASE WHEN ready THEN 200 WHEN s_nationkey IS NULL THEN 204 ELSE 200 END AS INTEGER) AS status
FROM (SELECT *, c_mktsegment <> 'FURNITURE' AND c_acctbal > 0 AS ready FROM customer)
LEFT JOIN hit ON c_nationkey = s_nationkey AND c_mktsegment <> 'BUILDING'
"""


def retry_missing(spark: SparkSession, sf: str) -> DataFrame:
    """A second pass over rows recorded as 204, against a gazetteer that has grown."""
    master, gazetteer = _places(spark, sf)
    first = enrich.lookup_first(master, gazetteer.where(F.col("lat") > 6000), ["VILLAGE", "DISTRICT"])
    return enrich.retry_missing(master, first, gazetteer, ["VILLAGE", "DISTRICT"])


RETRY_PASS_SQL = """
WITH a AS (SELECT s_nationkey, s_acctbal AS lat, CAST(s_suppkey AS DOUBLE) AS lon FROM supplier WHERE s_acctbal > 6000
        QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) = 1),
b AS (SELECT s_nationkey, s_acctbal AS lat, CAST(s_suppkey AS DOUBLE) AS lon FROM supplier
        QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) = 1)
SELECT c_custkey AS row_id, coalesce(a.lat, b.lat) AS lat, coalesce(a.lon, b.lon) AS lon,
       CAST(CASE WHEN coalesce(a.lat, b.lat) IS NULL THEN 204 ELSE 200 END AS INTEGER) AS status
FROM customer LEFT JOIN a ON c_nationkey = a.s_nationkey AND c_mktsegment <> 'BUILDING'
LEFT JOIN b ON c_nationkey = b.s_nationkey AND c_mktsegment <> 'BUILDING'
"""

QUERIES = {
    "resume_anti": (resume_anti, RESUME_SQL),
    "json_extract_status": (response_status, _STATUS_SQL),
    "retry_by_status": (retry_by_status, RETRY_SQL),
    "retry_by_missing": (retry_by_missing, RETRY_MISSING_SQL),
    "upsert_new_wins": (_upsert("new"), UPSERT_SQL["new"]),
    "upsert_existing_wins": (_upsert("existing"), UPSERT_SQL["existing"]),
    "upsert_non_null": (_upsert("non_null"), UPSERT_SQL["non_null"]),
    "completed_keys": (completed_keys, COMPLETED_SQL),
    "latest_checkpoint": (latest_checkpoint, LATEST_SQL),
    "checkpoint_summary": (checkpoint_summary, SUMMARY_SQL),
    "completion": (completion, COMPLETION_SQL),
    "recovery_summary": (recovery_summary, RECOVERY_SQL),
    "reindex_left": (reindex_left, REINDEX_SQL),
    "first_match_lookup": (first_match_lookup, LOOKUP_SQL),
    "enrich_incremental": (enrich_incremental, ENRICH_SQL),
    "retry_missing": (retry_missing, RETRY_PASS_SQL),
}
