"""Append-only checkpoint tables and failure records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.operators.enrich import latest_per_key, upsert
from terraloom.sources import files

CHECKPOINT_SCHEMA = (
    "year int, season string, loc_id bigint, gdd double, rain_cv double, spi3_mean double, saved_at timestamp"
)
FAILURE_SCHEMA = "latitude double, longitude double, startdate string, enddate string, error string, attempt int"


def save_checkpoint(results: DataFrame, path: str) -> None:
    """Append finished rows with the time of saving; earlier saves are never rewritten."""
    stamped = results if "saved_at" in results.columns else results.withColumn("saved_at", F.current_timestamp())
    stamped.write.mode("append").partitionBy("year", "season").parquet(path)


def load_checkpoint(
    spark: SparkSession, path: str, year: int | None = None, season: str | None = None, key: str = "loc_id",
    schema: str = CHECKPOINT_SCHEMA,
) -> DataFrame:
    """Newest row per key of one season (only its folder is read), or no rows if nothing was saved."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    saved = spark.read.schema(schema).parquet(path)
    if year is not None:
        saved = saved.where(F.col("year") == year)
    if season is not None:
        saved = saved.where(F.col("season") == season)
    return latest_per_key(saved, ["year", "season", key], ["saved_at"])


def save_recovered(recovered: DataFrame, path: str) -> None:
    """Append the rows that a retry recovered, in the form of a checkpoint."""
    save_checkpoint(recovered, path)


def merge_recovered(spark: SparkSession, results: DataFrame, path: str, year: int, season: str, key: str = "loc_id") -> DataFrame:
    """``results`` with the newest recovered row of each key put in where a value is missing."""
    recovered = load_checkpoint(spark, path, year, season, key).select(*results.columns)
    return upsert(results, recovered, [key], wins="non_null")


def write_failures(failures: DataFrame, path: str) -> None:
    failures.write.mode("append").json(path)


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """Failed requests to try again; no rows if there were none."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], FAILURE_SCHEMA)
    return spark.read.schema(FAILURE_SCHEMA).json(path)
