"""JSON documents: daily weather responses and geocode responses.

Fixed values: the field names of both responses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terraloom.operators.enrich import response_status

WEATHER_SCHEMA = """
type string, geometry struct<type: string, coordinates: array<double>>,
properties struct<parameter: struct<CDD10: map<string, double>, PRECTOTCORR: map<string, double>>>,
header struct<title: string, fill_value: double, time_standard: string, start: string, `end`: string>
"""
GEOCODE_SCHEMA = """
results array<struct<formatted_address: string,
  address_components: array<struct<long_name: string, short_name: string, types: array<string>>>,
  geometry: struct<location: struct<lat: double, lng: double>, location_type: string>,
  place_id: string, types: array<string>>>,
status string
"""


def _weather_columns(doc: Column | None = None) -> list[Column]:
    def at(path: str) -> Column:
        if doc is None:
            return F.col(path)
        out = doc
        for name in path.split("."):
            out = out[name]
        return out

    return [
        F.get(at("geometry.coordinates"), F.lit(0)).alias("lon"), F.get(at("geometry.coordinates"), F.lit(1)).alias("lat"),
        at("properties.parameter.PRECTOTCORR").alias("prectotcorr"), at("properties.parameter.CDD10").alias("cdd10"),
        at("header.fill_value").alias("fill_value"),
    ]


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """One row per response file: lon, lat, two maps of compact date -> value, fill_value, source_file."""
    docs = spark.read.schema(WEATHER_SCHEMA).json(path, multiLine=True, mode="FAILFAST")
    return docs.select(*_weather_columns(), F.col("_metadata.file_path").alias("source_file"))


def parse_weather(df: DataFrame, body: str) -> DataFrame:
    """Responses held as text in a column; the other columns are kept."""
    parsed = df.withColumn("_doc", F.from_json(body, WEATHER_SCHEMA))
    return parsed.select(*[F.col(c) for c in df.columns if c != body], *_weather_columns(F.col("_doc")))


def parse_geocode(df: DataFrame, body: str, http: str | None = None) -> DataFrame:
    """First hit and outcome code of geocode responses held as text."""
    parsed = df.withColumn("_doc", F.from_json(body, GEOCODE_SCHEMA))
    location = F.get(F.col("_doc.results"), F.lit(0))["geometry"]["location"]
    code = response_status(F.col(http) if http else F.lit(200), F.col("_doc.results"))
    keep = [F.col(c) for c in df.columns if c != body]
    return parsed.withColumn("status", code.cast("int")).select(
        *keep, F.when(F.col("status") == 200, location["lat"]).alias("lat"),
        F.when(F.col("status") == 200, location["lng"]).alias("lon"), "status",
    )


def read_geocode(spark: SparkSession, path: str) -> DataFrame:
    """Responses stored as one file each."""
    bodies = spark.read.text(path, wholetext=True).select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("source_file"))
    return parse_geocode(bodies, "body")
