"""Raster observations, raster catalogue, listing pages and file inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.operators.crawl import extract_links

CATALOGUE_SCHEMA = "url string, lon0 double, lat0 double, lon1 double, lat1 double"


def read_observations(
    spark: SparkSession, path: str, start: str, end: str, ts: str = "ts", cell: tuple[str, ...] = ("cell_id",), band: str = "evi",
) -> DataFrame:
    """(cell, ts, band) of the half-open range [start, end).

    The range is a plain comparison on the stored column, so it reaches the
    Parquet scan, and only the named columns are read.
    """
    obs = spark.read.parquet(path)
    kind = obs.schema[ts].dataType
    low, high = F.lit(start).cast(kind), F.lit(end).cast(kind)
    return obs.where((F.col(ts) >= low) & (F.col(ts) < high)).select(*cell, ts, band)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Raster files with their bounds in degrees, from CSV."""
    return spark.read.schema(CATALOGUE_SCHEMA).csv(path, header=True)


def read_listing(spark: SparkSession, path: str, url: str = "url", html: str = "html") -> DataFrame:
    """Links of the stored listing pages of a Parquet table."""
    return extract_links(spark.read.parquet(path).select(url, html), url, html)


def read_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length) of the files below a folder that are not empty; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", "length").where(F.col("length") > 0)
