"""Grid sampling and box joins over table columns used as coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.operators import geo, metric, timeseries
from terraloom.plans.common import big, snap, sql_season, sql_season_year, sql_snap, table
from terraloom.sources import files, observations, sinks


def _observations(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a raster time series: the customer's nation and balance place the cell."""
    customer = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("double").alias("lon"), (F.col("c_acctbal") / 1000).alias("lat"))
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderkey")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return geo.with_cells(joined, 1.0)


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_nationkey").cast("double").alias("lon"), (F.col("s_acctbal") / 1000).alias("lat"))


def sample_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Seasonal statistics of the cell every supplier lies in."""
    stats = timeseries.season_stats(_observations(spark, sf), ["cell_x", "cell_y"], "o_orderdate", "o_totalprice", closed="both")
    sampled = geo.sample_grid(_points(spark, sf), stats.select("cell_x", "cell_y", "season", "year", "mean", "p90"), 1.0, "s_suppkey")
    return sampled.select(
        "s_suppkey", big(F.col("cell_x")).alias("cell_x"), big(F.col("cell_y")).alias("cell_y"), "season", "year",
        snap(F.col("mean"), 4).alias("mean"), snap(F.col("p90"), 4).alias("p90"),
    )


_OBS_SQL = """
obs AS (SELECT c_nationkey AS cx, floor(c_acctbal / 1000) AS cy, o_orderdate, o_totalprice, o_orderkey
        FROM orders JOIN customer ON o_custkey = c_custkey)"""
SAMPLE_SQL = f"""
WITH {_OBS_SQL}, st AS (
  SELECT cx, cy, season, year, avg(o_totalprice) AS mean, quantile_cont(o_totalprice, 0.9) AS p90
  FROM (SELECT *, {sql_season('o_orderdate')} AS season, {sql_season_year('o_orderdate')} AS year FROM obs)
  WHERE season IS NOT NULL GROUP BY cx, cy, season, year
)
SELECT s_suppkey, CAST(s_nationkey AS BIGINT) AS cell_x, CAST(floor(s_acctbal / 1000) AS BIGINT) AS cell_y, season, year,
       {sql_snap('mean', 4)} AS mean, {sql_snap('p90', 4)} AS p90
FROM supplier LEFT JOIN st ON s_nationkey = cx AND floor(s_acctbal / 1000) = cy
"""


def first_in_cell(spark: SparkSession, sf: str) -> DataFrame:
    obs = _observations(spark, sf).withColumn("value", F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")))
    return geo.first_in_cell(obs, "o_orderkey", "value")


FIRST_SQL = f"""
WITH {_OBS_SQL}
SELECT CAST(cx AS BIGINT) AS cell_x, CAST(cy AS BIGINT) AS cell_y, arg_min(o_totalprice, o_orderkey) AS value
FROM obs WHERE o_totalprice > 100000 GROUP BY cx, cy
"""


def _boxes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    size = F.length("c_mktsegment") / 4.0
    items = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("double").alias("lon0"), (F.col("c_acctbal") / 100).alias("lat0"),
        (F.col("c_nationkey") + size).alias("lon1"), (F.col("c_acctbal") / 100 + size).alias("lat1"),
    )
    areas = table(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_nationkey").cast("double").alias("lon0"), (F.col("s_acctbal") / 100).alias("lat0"),
        (F.col("s_nationkey") + 0.5).alias("lon1"), (F.col("s_acctbal") / 100 + 3).alias("lat1"),
    )
    return items, areas


_BOXES_SQL = """
items AS (SELECT c_custkey, c_nationkey AS lon0, c_acctbal / 100 AS lat0, c_nationkey + length(c_mktsegment) / 4.0 AS lon1,
                 c_acctbal / 100 + length(c_mktsegment) / 4.0 AS lat1 FROM customer),
areas AS (SELECT s_suppkey, s_nationkey AS lon0, s_acctbal / 100 AS lat0, s_nationkey + 0.5 AS lon1, s_acctbal / 100 + 3 AS lat1 FROM supplier)
"""


def bbox_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return geo.bbox_overlap_join(*_boxes(spark, sf), "c_custkey", "s_suppkey")


BBOX_SQL = f"""
WITH {_BOXES_SQL}
SELECT c_custkey, s_suppkey FROM items i JOIN areas a
  ON i.lon1 >= a.lon0 AND i.lon0 <= a.lon1 AND i.lat1 >= a.lat0 AND i.lat0 <= a.lat1
"""


def _mixed_boxes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Points, fields, provinces and continents: sizes of both sides over five powers of ten, and long narrow strips."""
    def sized(name: str, key: str, balance: str) -> DataFrame:
        n = F.col(key) % 40
        width = F.when(n == 0, 120.0).when(n < 3, 9.0).when(n < 12, 0.4).when(n < 20, 0.0).otherwise(0.003)
        height = F.when(n == 0, 70.0).when(n == 1, 0.0005).when(n < 3, 7.0).when(n < 12, 0.3).when(n < 20, 0.0).otherwise(0.002)
        lon, lat = (F.col(key) * 7919 % 3600) / 10.0 - 180, F.col(balance) / 100
        return table(spark, sf, name).select(key, lon.alias("lon0"), lat.alias("lat0"), (lon + width).alias("lon1"), (lat + height).alias("lat1"))
    return sized("customer", "c_custkey", "c_acctbal"), sized("supplier", "s_suppkey", "s_acctbal")


def _mixed_sql(name: str, key: str, balance: str) -> str:
    n, lon, lat = f"{key} % 40", f"(({key} * 7919 % 3600) / 10e0 - 180)", f"{balance} / 100"
    return f"""
  SELECT *, lon0 + CASE WHEN {n} = 0 THEN 120e0 WHEN {n} < 3 THEN 9e0 WHEN {n} < 12 THEN 0.4e0 WHEN {n} < 20 THEN 0e0 ELSE 0.003e0 END AS lon1,
    lat0 + CASE WHEN {n} = 0 THEN 70e0 WHEN {n} = 1 THEN 0.0005e0 WHEN {n} < 3 THEN 7e0 WHEN {n} < 12 THEN 0.3e0 WHEN {n} < 20 THEN 0e0 ELSE 0.002e0 END AS lat1
  FROM (SELECT {key}, {lon} AS lon0, {lat} AS lat0 FROM {name})"""


_MIXED_SQL = f"items AS ({_mixed_sql('customer', 'c_custkey', 'c_acctbal')}), areas AS ({_mixed_sql('supplier', 's_suppkey', 's_acctbal')})"


def bbox_overlap_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Every overlapping pair where both sides hold anything from points to continents."""
    return geo.bbox_overlap_join(*_mixed_boxes(spark, sf), "c_custkey", "s_suppkey")


BBOX_MIXED_SQL = f"""
WITH {_MIXED_SQL}
SELECT c_custkey, s_suppkey FROM items i JOIN areas a
  ON i.lon1 >= a.lon0 AND i.lon0 <= a.lon1 AND i.lat1 >= a.lat0 AND i.lat0 <= a.lat1
"""


def tile_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Which areas each tile reaches: tiles of files of every size against areas of every size."""
    items, areas = _mixed_boxes(spark, sf)
    tiled = items.withColumn("tile", F.concat(F.lit("tile-"), (F.col("c_custkey") % 25).cast("string")))
    return geo.tiles_per_area(tiled, areas, "tile", "s_suppkey")


TILE_AREAS_SQL = f"""
WITH {_MIXED_SQL}
SELECT 'tile-' || CAST(c_custkey % 25 AS VARCHAR) AS tile, s_suppkey, count(*) AS n_items FROM items i JOIN areas a
  ON i.lon1 >= a.lon0 AND i.lon0 <= a.lon1 AND i.lat1 >= a.lat0 AND i.lat0 <= a.lat1 GROUP BY ALL
"""


def area_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes that touch one fixed area of interest."""
    return _boxes(spark, sf)[0].where(geo.overlaps_area((3.0, 10.0, 9.0, 37.0))).select("c_custkey")


AREA_SQL = f"""
WITH {_BOXES_SQL} SELECT c_custkey FROM items WHERE lon1 >= 3 AND lon0 <= 9 AND lat1 >= 10 AND lat0 <= 37
"""


def _tiles(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Embeddings as raster files: the label names the tile, two components give the position."""
    e = F.col("embedding")
    lon, lat = 60 + F.get(e, F.lit(0)).cast("double") * 60, 5 + F.get(e, F.lit(1)).cast("double") * 60
    tile = F.concat(F.lit("http://tiles.test/tileSG-"), F.lpad(F.col("label").cast("string"), 3, "0"), F.lit("/"))
    items = table(spark, sf, "embeddings").select(
        tile.alias("tile"), F.concat(tile, F.lpad(F.col("vec_id").cast("string"), 8, "0"), F.lit(".TIF")).alias("url"),
        lon.alias("lon0"), lat.alias("lat0"), (lon + 1).alias("lon1"), (lat + 1).alias("lat1"),
    )
    return items.select("tile").distinct(), items


_TILES_SQL = """
items AS (SELECT 'http://tiles.test/tileSG-' || lpad(CAST(label AS VARCHAR), 3, '0') || '/' AS tile,
                 'http://tiles.test/tileSG-' || lpad(CAST(label AS VARCHAR), 3, '0') || '/' || lpad(CAST(vec_id AS VARCHAR), 8, '0') || '.TIF' AS url,
                 60 + CAST(embedding[1] AS DOUBLE) * 60 AS lon0, 5 + CAST(embedding[2] AS DOUBLE) * 60 AS lat0,
                 60 + CAST(embedding[1] AS DOUBLE) * 60 + 1 AS lon1, 5 + CAST(embedding[2] AS DOUBLE) * 60 + 1 AS lat1
          FROM embeddings),
hits AS (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY url) AS rn,
                lon1 >= 68 AND lon0 <= 97 AND lat1 >= 8 AND lat0 <= 37 AS covers FROM items)
"""


def tile_semi(spark: SparkSession, sf: str) -> DataFrame:
    """Tiles with any file over the area of interest, all files looked at."""
    return geo.tiles_covering(*_tiles(spark, sf), "tile", "url", sample=None)


TILE_SQL = f"WITH {_TILES_SQL} SELECT DISTINCT tile FROM hits WHERE covers"


def tile_first_five(spark: SparkSession, sf: str) -> DataFrame:
    """The original rule: five files decide, listed tiles pass unseen."""
    return geo.tiles_covering(*_tiles(spark, sf), "tile", "url", sample=5, known=("tileSG-001", "tileSG-004"))


TILE_FIVE_SQL = f"""
WITH {_TILES_SQL} SELECT DISTINCT tile FROM hits
WHERE (covers AND rn <= 5) OR contains(tile, 'tileSG-001') OR contains(tile, 'tileSG-004')
"""


def catalogue_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """The same from a catalogue of bounds that is stored as CSV and read back."""
    tiles, items = _tiles(spark, sf)
    path = files.scratch_dir(spark, "catalogue")
    sinks.write_table(items.select("url", *geo.BOUNDS), path, row_id=None)
    bounds = observations.read_catalogue(spark, path)
    bounded = bounds.withColumn("tile", F.regexp_extract("url", "^(.*/)", 1))
    return geo.tiles_covering(tiles, bounded, "tile", "url")


SCALE, REACH = 20_000.0, 100_000.0  # metres


def nearest_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The first order value of the nearest equal-area cell that has one, for every supplier, within a stated reach in metres."""
    obs = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        (68 + F.col("c_nationkey") + F.col("c_custkey") % 100 / 100.0).alias("lon"), (8 + F.col("c_acctbal") / 500).alias("lat"), "o_orderkey",
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("value"))
    cells = metric.first_in_metric_cell(metric.with_metric_cells(obs, SCALE), "o_orderkey", "value")
    points = table(spark, sf, "supplier").select(
        "s_suppkey", (68.003 + F.col("s_nationkey") + F.col("s_suppkey") * 37 % 100 / 100.0).alias("lon"), (8 + F.col("s_acctbal") / 500).alias("lat"))
    sampled = metric.sample_nearest(points, cells, "s_suppkey", REACH, SCALE)
    return sampled.select("s_suppkey", "cell_row", "cell_column", snap(F.col("metres"), 3).alias("metres"), "value")


def _sql_row(lat: str) -> str:
    return f"floor({lat} * {metric.METRES!r} / {SCALE}e0)"


_CENTRE = f"((cell_row + 0.5) * {SCALE}e0 / {metric.METRES!r})"
NEAREST_SQL = f"""
WITH obs AS (
  SELECT 68 + c_nationkey + c_custkey % 100 / 100e0 AS lon, 8 + c_acctbal / 500 AS lat, o_orderkey, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 100000),
rowed AS (SELECT *, {_sql_row('lat')} AS cell_row FROM obs),
cells AS (
  SELECT cell_row, floor(lon * {metric.METRES!r} * cos(radians({_CENTRE})) / {SCALE}e0) AS cell_column, arg_min(o_totalprice, o_orderkey) AS value
  FROM rowed GROUP BY ALL),
middles AS (
  SELECT *, {_CENTRE} AS lat1, (cell_column + 0.5) * {SCALE}e0 / ({metric.METRES!r} * cos(radians({_CENTRE}))) AS lon1 FROM cells),
points AS (SELECT s_suppkey, 68.003e0 + s_nationkey + s_suppkey * 37 % 100 / 100e0 AS lon, 8 + s_acctbal / 500 AS lat FROM supplier),
pairs AS (
  SELECT s_suppkey, cell_row, cell_column, value, {2 * metric.EARTH!r} * asin(sqrt(least(1e0,
    pow(sin(radians(lat1 - lat) / 2), 2) + pow(sin(radians(lon1 - lon) / 2), 2) * cos(radians(lat)) * cos(radians(lat1))))) AS metres
  FROM points CROSS JOIN middles),
best AS (
  SELECT * FROM pairs WHERE metres <= {REACH} QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY metres, cell_row, cell_column) = 1)
SELECT s_suppkey, cell_row::BIGINT AS cell_row, cell_column::BIGINT AS cell_column, {sql_snap('metres', 3)} AS metres, value
FROM points LEFT JOIN best USING (s_suppkey)
"""

QUERIES = {
    "sample_grid": (sample_grid, SAMPLE_SQL),
    "nearest_sample": (nearest_sample, NEAREST_SQL),
    "first_in_cell": (first_in_cell, FIRST_SQL),
    "bbox_overlap": (bbox_overlap, BBOX_SQL),
    "bbox_overlap_mixed": (bbox_overlap_mixed, BBOX_MIXED_SQL),
    "tile_areas": (tile_areas, TILE_AREAS_SQL),
    "area_filter": (area_filter, AREA_SQL),
    "tile_semi": (tile_semi, TILE_SQL),
    "tile_first_five": (tile_first_five, TILE_FIVE_SQL),
    "catalogue_tiles": (catalogue_tiles, TILE_SQL),
}
