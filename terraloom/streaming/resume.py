"""The resumable weather pass as an incremental file stream.

The batch operators skip finished locations with an anti-join.  When responses
arrive as files, Structured Streaming keeps that bookkeeping itself: every run
takes the files it has not seen, appends their features and stops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from terraloom.operators.enrich import latest_per_key
from terraloom.operators.seasons import assign_season
from terraloom.operators.weather import mismatched_documents, weather_features, zip_parameters
from terraloom.sources import files

BUCKETS = 32  # folders of locations in each season
WRITERS = 8  # files a batch may write to one folder
DOCUMENT_SCHEMA = "loc_id bigint, prectotcorr map<string, double>, cdd10 map<string, double>"


def drain_documents(
    spark: SparkSession, source: str, target: str, progress: str, keys: Sequence[str] = ("loc_id",),
    schema: str = DOCUMENT_SCHEMA, max_files: int = 10_000,
) -> None:
    """Turn the documents (JSON lines) that arrived since the last run into feature rows.

    A season's days may arrive in several documents and batches: every batch stores
    its days in the table at ``days_path(target)`` and computes each season of a
    location that it touches from all days stored so far, where the newest batch wins
    a day.  Days lie in folders by year, season and bucket of the location, and only
    the folders that a batch writes to are read again, so a batch costs what it
    touches and not what was ever stored.
    Documents whose two maps have different dates go, whole, to the table at
    ``failures_path(target)``.  A batch that is run again after a failure overwrites
    its own folders, so it cannot count twice.
    """
    docs = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(source)

    def save(batch: DataFrame, batch_id: int) -> None:
        mismatched_documents(batch).write.mode("overwrite").parquet(f"{failures_path(target)}/batch={batch_id}")
        store_days(assign_season(zip_parameters(batch, keys, strict=False), "date"), target, keys, batch_id)
        days = touched_days(spark, target, keys, batch_id)
        if days is None:
            return
        weather_features(days, keys).withColumn("saved_at", F.current_timestamp()).write.mode("overwrite").parquet(
            f"{target}/batch={batch_id}")

    query = (
        docs.writeStream.foreachBatch(save).option("checkpointLocation", progress).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def store_days(days: DataFrame, target: str, keys: Sequence[str], batch_id: int) -> None:
    """Add a batch's days, each to the folder of its year, season and bucket; run again, it replaces what it wrote before."""
    placed = days.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")).withColumn("batch", F.lit(batch_id).cast("bigint"))
    dealt = placed.repartition("year", "season", "bucket", F.pmod(F.xxhash64("date"), F.lit(WRITERS)))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "season", "bucket", "batch").parquet(days_path(target))


def touched_days(spark: SparkSession, target: str, keys: Sequence[str], batch_id: int) -> DataFrame | None:
    """All days stored up to a batch, of the location seasons that it touches; nothing else is read.

    The folders are found by listing those of the batch: at most seasons x buckets.
    """
    root = days_path(target)
    places = sorted({path.rsplit("/", 1)[0] for path in files.matching(spark, f"{root}/year=*/season=*/bucket=*/batch={batch_id}")})
    if not places:
        return None
    stored = spark.read.option("basePath", files.qualified(spark, root)).parquet(*places)
    season = [*keys, "season", "year"]
    kept = stored.where(F.col("batch") <= batch_id).drop("bucket")
    touched = kept.where(F.col("batch") == batch_id).select(*[F.col(c).alias(f"_{c}") for c in season]).distinct()
    same = [kept[c].eqNullSafe(touched[f"_{c}"]) for c in season]
    newest = W.partitionBy(*keys, "date")
    days = kept.join(touched, same, "left_semi").withColumn("_newest", F.max("batch").over(newest))
    return days.where(F.col("batch") == F.col("_newest")).drop("batch", "_newest", "season", "year")


def days_path(target: str) -> str:
    return f"{target.rstrip('/')}-days"


def failures_path(target: str) -> str:
    return f"{target.rstrip('/')}-failures"


def drained_failures(spark: SparkSession, target: str) -> DataFrame:
    """Documents that no features could be made of, with the batch they came in."""
    return spark.read.parquet(failures_path(target))


def drained_features(spark: SparkSession, target: str, keys: Sequence[str] = ("loc_id",)) -> DataFrame:
    """Newest feature row per location and season."""
    saved = spark.read.parquet(target)
    return latest_per_key(saved, [*keys, "season", "year"], ["batch"]).drop("batch")
