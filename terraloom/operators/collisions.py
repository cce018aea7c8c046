"""How many categories share a hash bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.functions.hashing import hash_bucket

AUDIT_BUCKETS = 2**21
AUDIT_PREFIX_BYTES = 8


def bucket_counts(df: DataFrame, value: Column, n_buckets: int = AUDIT_BUCKETS, prefix_bytes: int = AUDIT_PREFIX_BYTES) -> DataFrame:
    return df.select(hash_bucket(value, n_buckets, prefix_bytes).alias("bucket")).where(
        F.col("bucket").isNotNull()
    ).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def collision_audit(df: DataFrame, value: Column, n_buckets: int = AUDIT_BUCKETS, prefix_bytes: int = AUDIT_PREFIX_BYTES) -> DataFrame:
    """Buckets holding more than one value, the surplus values, and their percentage."""
    counts = bucket_counts(df, value, n_buckets, prefix_bytes)
    n = F.col("n")
    return counts.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("values"),
        F.count_if(n > 1).alias("collision_buckets"),
        F.coalesce(F.sum(F.when(n > 1, n - 1)), F.lit(0)).alias("surplus"),
    ).withColumn("surplus_percent", F.col("surplus") * 100.0 / F.nullif(F.col("values"), F.lit(0)))
