"""Scans and sinks: tables are written to the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.functions import dates, text
from terraloom.operators import crawl, enrich, weather
from terraloom.plans import series
from terraloom.plans.common import big, day_text, snap, sql_snap, table
from terraloom.plans.reshape import _STATS_SQL, STATS, _stats
from terraloom.sources import checkpoints, documents, files, observations, sinks, tables, versions
from terraloom.streaming import resume


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed CSV with missing-value texts, read back with inferred types."""
    path = files.scratch_dir(spark, "csv")
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("row_id"), F.when(F.col("c_mktsegment") == "BUILDING", F.lit("NA")).otherwise(F.col("c_mktsegment")).alias("SEX"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("amount"), F.col("c_nationkey").alias("CITY"), "c_name",
    )
    sinks.write_table(customer, path)
    return tables.read_keyed_table(spark, path).select("row_id", "SEX", "amount", "CITY", "c_name")


CSV_SQL = """
SELECT c_custkey AS row_id, nullif(c_mktsegment, 'BUILDING') AS "SEX", CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS amount,
       CAST(c_nationkey AS BIGINT) AS "CITY", c_name FROM customer
"""


def season_files(spark: SparkSession, sf: str) -> DataFrame:
    """One folder per season and year, all read back by a glob; season and year come from the file names."""
    path = files.scratch_dir(spark, "seasons")
    sinks.write_season_files(_stats(spark, sf), path)
    back = tables.read_table(spark, f"{path}/season=*/*", source_file="file")
    season, year = F.regexp_extract("file", r"season=(\w+)", 1), F.regexp_extract("file", r"year=(\d+)", 1).cast("int")
    return back.select(
        big(F.col("id")).alias("id"), season.alias("season"), year.alias("year"), *[F.col(c).cast("double").alias(c) for c in STATS])


SEASON_FILES_SQL = f"WITH {_STATS_SQL} SELECT id, season, year, {', '.join(f'\"{c}\"' for c in STATS)} FROM stats"


def checkpoint_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two saves of the same season; the newer one wins where both have a supplier."""
    path = files.scratch_dir(spark, "checkpoint")
    base = table(spark, sf, "supplier").select(
        F.lit(2021).alias("year"), F.lit("Rabi").alias("season"), F.col("s_suppkey").alias("loc_id"), F.col("s_acctbal").alias("gdd"),
        F.lit(1.0).alias("rain_cv"), F.lit(0.0).alias("spi3_mean"),
    )
    checkpoints.save_checkpoint(base.withColumn("saved_at", F.lit("2024-01-01").cast("timestamp")), path)
    newer = base.where(F.col("gdd") > 5000).withColumns({"gdd": F.col("gdd") * 2, "saved_at": F.lit("2024-01-02").cast("timestamp")})
    checkpoints.save_checkpoint(newer, path)
    checkpoints.save_checkpoint(newer.withColumn("season", F.lit("Kharif")), path)
    return checkpoints.load_checkpoint(spark, path, 2021, "Rabi").select("loc_id", snap(F.col("gdd"), 2).alias("gdd"), "rain_cv")


CHECKPOINT_SQL = f"""
SELECT s_suppkey AS loc_id, {sql_snap('CASE WHEN s_acctbal > 5000 THEN 2 * s_acctbal ELSE s_acctbal END', 2)} AS gdd, 1e0 AS rain_cv FROM supplier
"""


def checkpoint_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers still to do after a first save."""
    path = files.scratch_dir(spark, "resume")
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("loc_id"), F.col("s_acctbal").alias("gdd"))
    done = supplier.where(F.col("gdd") > 2000).withColumns(
        {"year": F.lit(2022), "season": F.lit("Kharif"), "rain_cv": F.lit(1.0), "spi3_mean": F.lit(0.0)})
    checkpoints.save_checkpoint(done, path)
    return enrich.skip_completed(supplier, checkpoints.load_checkpoint(spark, path, 2022, "Kharif"), ["loc_id"])


RESUME_SQL = "SELECT s_suppkey AS loc_id, s_acctbal AS gdd FROM supplier WHERE NOT s_acctbal > 2000"


def failure_log(spark: SparkSession, sf: str) -> DataFrame:
    """Failed requests written as JSON and read back for the retry, error texts cut to 100 characters."""
    path = files.scratch_dir(spark, "failures")
    events = table(spark, sf, "events").where(F.col("event_type") == "error")
    message = F.concat(F.lit("HTTP 500: "), F.repeat(F.col("props"), F.lit(20)))
    checkpoints.write_failures(events.select(
        F.col("value").alias("latitude"), F.col("user_id").cast("double").alias("longitude"),
        F.date_format("ts", "yyyy-MM-dd").alias("startdate"), F.lit("2024-12-31").alias("enddate"),
        text.truncate_error(message).alias("error"), F.lit(1).alias("attempt"),
    ), path)
    return checkpoints.read_failures(spark, path)


FAILURE_SQL = """
SELECT value AS latitude, CAST(user_id AS DOUBLE) AS longitude, strftime(ts, '%Y-%m-%d') AS startdate, '2024-12-31' AS enddate,
       left('HTTP 500: ' || repeat(props, 20), 100) AS error, CAST(1 AS INTEGER) AS attempt
FROM events WHERE event_type = 'error'
"""


def weather_json(spark: SparkSession, sf: str) -> DataFrame:
    """Weather responses as JSON text, parsed and unfolded to days."""
    docs = series._documents(spark, sf)
    body = F.to_json(F.struct(
        F.lit("Feature").alias("type"), F.struct(F.array(F.lit(78.0), F.lit(21.0), F.lit(357.0)).alias("coordinates")).alias("geometry"),
        F.struct(F.struct(F.col("cdd10").alias("CDD10"), F.col("prectotcorr").alias("PRECTOTCORR")).alias("parameter")).alias("properties"),
        F.struct(F.lit(-999.0).alias("fill_value")).alias("header"),
    ))
    parsed = documents.parse_weather(docs.select("o_orderpriority", body.alias("body")), "body")
    days = weather.zip_parameters(parsed, ["o_orderpriority", "lon", "lat"], fill_value=1.0)
    return days.select("o_orderpriority", "lon", "lat", day_text("date"), snap(F.col("prectotcorr"), 2).alias("prectotcorr"), "cdd10")


WEATHER_JSON_SQL = f"""
WITH {series._SEASON_DAILY_SQL}
SELECT o_orderpriority, 78e0 AS lon, 21e0 AS lat, CAST(date AS VARCHAR) AS date, {sql_snap('total', 2)} AS prectotcorr, nullif(CAST(n AS DOUBLE), 1) AS cdd10 FROM sd
"""


def geocode_json(spark: SparkSession, sf: str) -> DataFrame:
    """Geocode responses as JSON text: first hit, or a code that says why there is none."""
    hit = F.struct(F.struct(F.struct(F.col("c_acctbal").alias("lat"), F.col("c_nationkey").alias("lng")).alias("location")).alias("geometry"))
    far = F.struct(F.struct(F.struct(F.lit(0.0).alias("lat"), F.lit(0).alias("lng")).alias("location")).alias("geometry"))
    body = F.to_json(F.struct(
        F.when(F.col("c_mktsegment") == "BUILDING", F.filter(F.array(hit), lambda _: F.lit(False))).otherwise(F.array(hit, far)).alias("results"),
        F.lit("OK").alias("status")))
    http = F.when(F.col("c_mktsegment") == "MACHINERY", 429).otherwise(200)
    rows = table(spark, sf, "customer").select("c_custkey", http.alias("http"), body.alias("body"))
    return documents.parse_geocode(rows, "body", "http")


GEOCODE_SQL = """
SELECT c_custkey, CAST(CASE WHEN c_mktsegment = 'MACHINERY' THEN 429 ELSE 200 END AS INTEGER) AS http,
       CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_acctbal END AS lat,
       CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN CAST(c_nationkey AS DOUBLE) END AS lon,
       CAST(CASE c_mktsegment WHEN 'MACHINERY' THEN 429 WHEN 'BUILDING' THEN 204 ELSE 200 END AS INTEGER) AS status
FROM customer
"""


def observation_range(spark: SparkSession, sf: str) -> DataFrame:
    """Band select and half-open range straight on the Parquet scan."""
    obs = observations.read_observations(
        spark, f"{sf}/lineitem.parquet", "1996-06-01", "1996-10-31", ts="l_shipdate", cell=("l_suppkey", "l_partkey"), band="l_quantity")
    return obs.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


OBSERVATION_SQL = """
SELECT l_suppkey, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_quantity FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-06-01' AND l_shipdate < TIMESTAMP '1996-10-31'
"""


def point_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Point literals written as text lines and read back by tag."""
    path = files.scratch_dir(spark, "points")
    points = table(spark, sf, "customer")
    sinks.write_lines(points, text.point_literal(F.col("c_custkey"), F.col("c_nationkey").cast("double"), F.col("c_acctbal"), "Rabi_2020"), path)
    back = spark.read.text(path)
    return back.select(F.regexp_extract("value", r"id: '(\d+)_Rabi_2020'", 1).cast("bigint").alias("c_custkey"), "value")


POINT_LINES_SQL = """
SELECT c_custkey, 'ee.Feature(ee.Geometry.Point([' || CAST(c_nationkey AS DOUBLE) || ', ' || c_acctbal || ']), {id: ''' || c_custkey || '_Rabi_2020''}),' AS value
FROM customer
"""


def dropped_column(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table loses its repeated id column in place."""
    path = files.scratch_dir(spark, "rewrite")
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_suppkey").alias("id.1"), "s_name")
    sinks.write_table(supplier, path, row_id=None)
    sinks.rewrite_table(
        spark, path, read=lambda p: tables.read_table(spark, p), change=lambda df: df.select("id", "s_name"),
        write=lambda df, p: sinks.write_table(df, p, row_id=None))
    return tables.read_table(spark, path)


DROPPED_SQL = "SELECT s_suppkey AS id, s_name FROM supplier"


def drained_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Documents arriving in two runs of the incremental stream give the features of one batch pass."""
    root = files.scratch_dir(spark, "stream")
    docs = series._documents(spark, sf).select("o_orderpriority", "prectotcorr", "cdd10", "season")
    for part in ("Kharif", "Rabi"):
        docs.where(F.col("season") == part).drop("season").write.mode("append").json(f"{root}/in")
        resume.drain_documents(
            spark, f"{root}/in", f"{root}/out", f"{root}/progress", keys=("o_orderpriority",),
            schema="o_orderpriority string, prectotcorr map<string, double>, cdd10 map<string, double>")
    found = resume.drained_features(spark, f"{root}/out", ("o_orderpriority",))
    return found.select(
        "o_orderpriority", "season", "year", snap(F.col("gdd"), 4).alias("gdd"), snap(F.col("rain_cv")).alias("rain_cv"),
        snap(F.col("spi3_mean"), 7).alias("spi3_mean"), "spi3_reason")


def drained_split_season(spark: SparkSession, sf: str) -> DataFrame:
    """The days of every season arrive in two runs of the stream, first all even dates and then all odd ones."""
    root = files.scratch_dir(spark, "split")
    docs = series._documents(spark, sf).select("o_orderpriority", "prectotcorr", "cdd10")
    for odd in (0, 1):
        docs.withColumns({
            c: F.map_filter(c, lambda day, _: day.cast("int") % 2 == odd) for c in ("prectotcorr", "cdd10")
        }).write.mode("append").json(f"{root}/in")
        resume.drain_documents(
            spark, f"{root}/in", f"{root}/out", f"{root}/progress", keys=("o_orderpriority",),
            schema="o_orderpriority string, prectotcorr map<string, double>, cdd10 map<string, double>")
    found = resume.drained_features(spark, f"{root}/out", ("o_orderpriority",))
    return found.select(
        "o_orderpriority", "season", "year", snap(F.col("gdd"), 4).alias("gdd"), snap(F.col("rain_cv")).alias("rain_cv"),
        snap(F.col("spi3_mean"), 7).alias("spi3_mean"), "spi3_reason")


def drained_ten_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The documents arrive in ten runs by date; every run reads the folders it touches again and no others."""
    root = files.scratch_dir(spark, "ten")
    docs = series._documents(spark, sf).select("o_orderpriority", "prectotcorr", "cdd10")
    for turn in range(10):
        docs.withColumns({
            c: F.map_filter(c, lambda day, _: F.substring(day, 6, 2).cast("int") * 31 % 10 == turn) for c in ("prectotcorr", "cdd10")
        }).write.mode("append").json(f"{root}/in")
        resume.drain_documents(
            spark, f"{root}/in", f"{root}/out", f"{root}/progress", keys=("o_orderpriority",),
            schema="o_orderpriority string, prectotcorr map<string, double>, cdd10 map<string, double>")
    found = resume.drained_features(spark, f"{root}/out", ("o_orderpriority",))
    return found.select(
        "o_orderpriority", "season", "year", snap(F.col("gdd"), 4).alias("gdd"), snap(F.col("rain_cv")).alias("rain_cv"),
        snap(F.col("spi3_mean"), 7).alias("spi3_mean"), "spi3_reason")


def versioned_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """A column is dropped and another changed in place; who opened the table before still reads the old version."""
    path = files.scratch_dir(spark, "versions")
    versions.create(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"), path)
    before = versions.read_version(spark, path)
    versions.rewrite(spark, path, lambda df: df.select("s_suppkey", (-F.col("s_acctbal")).alias("s_acctbal")))
    versions.write_part(before, path)  # a writer that died before its manifest
    after = versions.read_version(spark, path)
    return after.withColumn("version", F.lit(2)).unionByName(before.withColumn("version", F.lit(1)), allowMissingColumns=True)


VERSIONED_SQL = """
SELECT s_suppkey, -s_acctbal AS s_acctbal, 2 AS version, NULL::VARCHAR AS s_name FROM supplier
UNION ALL SELECT s_suppkey, s_acctbal, 1, s_name FROM supplier
"""


def versioned_saves(spark: SparkSession, sf: str) -> DataFrame:
    """Orders saved in three appends, folded to the newest row per customer while a fourth save arrives."""
    path = files.scratch_dir(spark, "saves")
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    for turn in range(3):
        versions.append(orders.where(F.col("o_orderkey") % 4 == turn), path)
    versions.compact(spark, path, ["o_custkey"], ["o_orderkey"])
    versions.append(orders.where(F.col("o_orderkey") % 4 == 3), path)
    versions.compact(spark, path, ["o_custkey"], ["o_orderkey"])
    versions.remove_old(spark, path)
    return versions.read_version(spark, path)


SAVES_SQL = """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1
"""


def train_or_test(spark: SparkSession, sf: str) -> DataFrame:
    """Customers stored as two tables; the switch reads either."""
    root = files.scratch_dir(spark, "master")
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    for name, part in (("train", F.col("c_custkey") % 5 != 0), ("test", F.col("c_custkey") % 5 == 0)):
        sinks.write_table(customer.where(part), f"{root}/{name}", row_id=None)
    parts = [tables.read_master(spark, train, f"{root}/train", f"{root}/test").withColumn("train", F.lit(train)) for train in (True, False)]
    return parts[0].unionByName(parts[1])


TRAIN_SQL = "SELECT c_custkey, c_acctbal, c_custkey % 5 <> 0 AS train FROM customer"


def renamed_key(spark: SparkSession, sf: str) -> DataFrame:
    """The key is written under another name."""
    path = files.scratch_dir(spark, "renamed")
    sinks.write_table(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("row_id"), "s_name"), path, key_name="id")
    return tables.read_table(spark, path)


RENAMED_SQL = "SELECT s_suppkey AS id, s_name FROM supplier"


def mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Files of one folder with differing column order and an extra column, each read by its own header."""
    path = files.scratch_dir(spark, "headers")
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), "s_acctbal", "s_nationkey", "s_name")
    layouts = (["id", "s_acctbal", "s_nationkey"], ["id", "s_nationkey", "s_acctbal"], ["s_name", "id", "s_acctbal", "s_nationkey"])
    for turn, names in enumerate(layouts):
        sinks.write_table(supplier.where(F.col("id") % 3 == turn).select(*names), path, row_id=None, mode="append")
    back = tables.read_table(spark, path)
    return back.select("id", "s_acctbal", F.col("s_nationkey").cast("bigint").alias("s_nationkey"), "s_name")


HEADERS_SQL = """
SELECT s_suppkey AS id, s_acctbal, CAST(s_nationkey AS BIGINT) AS s_nationkey, CASE WHEN s_suppkey % 3 = 2 THEN s_name END AS s_name FROM supplier
"""


def appended_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Season statistics appended in two chunks under the fixed header and read back."""
    path = files.scratch_dir(spark, "stats")
    stats = _stats(spark, sf)
    for part in ("Kharif", "Rabi"):
        sinks.append_stats(stats.where(F.col("season") == part), path)
    back = tables.read_table(spark, path)
    return back.select(
        big(F.col("id")).alias("id"), "season", F.col("year").cast("int").alias("year"), *[F.col(c).cast("double").alias(c) for c in STATS])


FILES = 40


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Pages stored in many files, some missing and some empty; a page is skipped if its own file is there and holds something."""
    path = files.scratch_dir(spark, "files")
    pages = table(spark, sf, "pages").select("page_id", F.concat(F.lit("file-"), (F.col("page_id") % FILES).cast("string")).alias("name"), "url")
    turn = F.col("page_id") % FILES
    pages.where((turn % 3 != 0) & (turn % 5 != 0)).withColumn("file", F.col("name")).write.partitionBy("file").json(path)
    for number in range(0, FILES, 5):  # interrupted downloads
        files.put_new(spark, f"{path}/file=file-{number}/part.json", "")
    found = observations.read_inventory(spark, path, "*.json").select(F.regexp_extract("path", "file=([^/]+)/", 1).alias("path"), "length")
    return crawl.skip_present(pages.select("name", "page_id"), found.groupBy("path").agg(F.sum("length").alias("length")), name="name")


INVENTORY_SQL = f"""
SELECT 'file-' || CAST(page_id % {FILES} AS VARCHAR) AS name, page_id FROM pages WHERE page_id % {FILES} % 3 = 0 OR page_id % {FILES} % 5 = 0
"""


def recovered_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers in debt failed; a retry recovers some, is saved twice, and the newest save fills the gaps."""
    path = files.scratch_dir(spark, "recovered")
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("loc_id"), F.col("s_acctbal").alias("gdd"))
    results = supplier.withColumn("gdd", F.when(F.col("gdd") >= 0, F.col("gdd")))
    again = supplier.where((F.col("gdd") < 0) & (F.col("loc_id") % 2 == 0)).withColumns(
        {"year": F.lit(2021), "season": F.lit("Rabi"), "rain_cv": F.lit(1.0), "spi3_mean": F.lit(0.0)})
    checkpoints.save_recovered(again.withColumn("saved_at", F.lit("2024-01-01").cast("timestamp")), path)
    checkpoints.save_recovered(again.withColumns({"gdd": -F.col("gdd"), "saved_at": F.lit("2024-01-02").cast("timestamp")}), path)
    return checkpoints.merge_recovered(spark, results, path, 2021, "Rabi")


RECOVERED_SQL = """
SELECT s_suppkey AS loc_id, CASE WHEN s_acctbal >= 0 THEN s_acctbal WHEN s_suppkey % 2 = 0 THEN -s_acctbal END AS gdd FROM supplier
"""


def nothing_to_retry(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer has a result, so a retry changes nothing."""
    customer = table(spark, sf, "customer")
    master = customer.select(F.col("c_custkey").alias("row_id"), F.col("c_mktsegment").alias("VILLAGE"), F.col("c_name").alias("DISTRICT"))
    done = customer.select(F.col("c_custkey").alias("row_id"), F.col("c_acctbal").alias("lat"), F.col("c_acctbal").alias("lon"), F.lit(200).alias("status"))
    gazetteer = customer.select(F.col("c_mktsegment").alias("address"), F.lit(1).alias("rank"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon")).distinct()
    return enrich.retry_missing(master, done, gazetteer, ["VILLAGE", "DISTRICT"])


NOTHING_SQL = "SELECT c_custkey AS row_id, c_acctbal AS lat, c_acctbal AS lon, CAST(200 AS INTEGER) AS status FROM customer"


def millis_to_days(spark: SparkSession, sf: str) -> DataFrame:
    """Event times as milliseconds, turned into fractional days."""
    events = table(spark, sf, "events").select("event_id", (dates.epoch_micros(table(spark, sf, "events"), "ts") / 1000).alias("millis"))
    return events.select("event_id", snap(dates.epoch_millis_to_days(F.col("millis")), 6).alias("days"))


MILLIS_SQL = f"SELECT event_id, {sql_snap('epoch_us(ts) / 86400e6', 6)} AS days FROM events"


def unequal_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose two maps differ in dates are kept as failures of the stream, the others give features."""
    root = files.scratch_dir(spark, "unequal")
    docs = series._documents(spark, sf).select("o_orderpriority", "season", "prectotcorr", "cdd10")
    broken = docs.withColumn("cdd10", F.when(F.col("season") == "Rabi", F.map_filter("cdd10", lambda k, _: ~k.endswith("01"))).otherwise(F.col("cdd10")))
    broken.write.json(f"{root}/in")
    resume.drain_documents(
        spark, f"{root}/in", f"{root}/out", f"{root}/progress", keys=("o_orderpriority",),
        schema="o_orderpriority string, season string, prectotcorr map<string, double>, cdd10 map<string, double>")
    failed = resume.drained_failures(spark, f"{root}/out").groupBy("o_orderpriority", "season").agg(F.count("*").alias("n"))
    return failed.select("o_orderpriority", "season", "n")


UNEQUAL_SQL = f"""
WITH {series._SEASON_DAILY_SQL}
SELECT o_orderpriority, season, count(DISTINCT year) AS n FROM sd
WHERE season = 'Rabi' AND (o_orderpriority, year) IN (SELECT (o_orderpriority, year) FROM sd WHERE season = 'Rabi' AND day(date) = 1)
GROUP BY 1, 2
"""

QUERIES = {
    "train_or_test": (train_or_test, TRAIN_SQL),
    "renamed_key": (renamed_key, RENAMED_SQL),
    "mixed_headers": (mixed_headers, HEADERS_SQL),
    "appended_stats": (appended_stats, f"WITH {_STATS_SQL} SELECT * FROM stats"),
    "inventory": (inventory, INVENTORY_SQL),
    "recovered_merge": (recovered_merge, RECOVERED_SQL),
    "nothing_to_retry": (nothing_to_retry, NOTHING_SQL),
    "millis_to_days": (millis_to_days, MILLIS_SQL),
    "unequal_documents": (unequal_documents, UNEQUAL_SQL),
    "csv_roundtrip": (csv_roundtrip, CSV_SQL),
    "season_files": (season_files, SEASON_FILES_SQL),
    "checkpoint_roundtrip": (checkpoint_roundtrip, CHECKPOINT_SQL),
    "checkpoint_resume": (checkpoint_resume, RESUME_SQL),
    "failure_log": (failure_log, FAILURE_SQL),
    "weather_json": (weather_json, WEATHER_JSON_SQL),
    "geocode_json": (geocode_json, GEOCODE_SQL),
    "observation_range": (observation_range, OBSERVATION_SQL),
    "point_lines": (point_lines, POINT_LINES_SQL),
    "dropped_column": (dropped_column, DROPPED_SQL),
    "drained_weather": (drained_weather, series.WEATHER_SQL),
    "drained_split_season": (drained_split_season, series.WEATHER_SQL),
    "drained_ten_runs": (drained_ten_runs, series.WEATHER_SQL),
    "versioned_rewrite": (versioned_rewrite, VERSIONED_SQL),
    "versioned_saves": (versioned_saves, SAVES_SQL),
}
