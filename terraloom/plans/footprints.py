"""Raster footprints in their own projections, made of table columns."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.functions import projections
from terraloom.operators import footprints, geo
from terraloom.plans.common import snap, sql_snap, table

CENTRAL = 150.0  # of the sinusoidal maps, whose eastern part lies beyond the 180th meridian


def _rasters(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as files of square rasters over the whole map, some of them across lobes or off it."""
    side = 50_000.0 + F.col("c_custkey") % 7 * 150_000.0
    x, y = (F.col("c_custkey") * 7919 % 40001 - 20_000) * 1000.0, (F.col("c_acctbal") * 1800.0 - 9_000_000.0)
    return table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("tile-"), F.col("c_nationkey").cast("string")).alias("tile"),
        x.alias("x0"), y.alias("y0"), (x + side).alias("x1"), (y + side).alias("y1"))


def _snapped(df: DataFrame) -> DataFrame:
    return df.select("c_custkey", *[snap(F.col(c)).alias(c) for c in geo.BOUNDS])


def homolosine_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds in degrees of rasters on the interrupted homolosine map."""
    return _snapped(footprints.degree_bounds(_rasters(spark, sf), projections.homolosine()))


def sinusoidal_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """The same on a sinusoidal map around 150 degrees east: boxes across the 180th meridian come in two."""
    return _snapped(footprints.degree_bounds(_rasters(spark, sf), projections.sinusoidal(CENTRAL)))


def projected_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Tiles that cover the area of interest, found from projected bounds."""
    rasters = _rasters(spark, sf).withColumn("url", F.col("c_custkey").cast("string"))
    bounds = footprints.degree_bounds(rasters, projections.homolosine())
    return geo.tiles_covering(rasters.select("tile").distinct(), bounds, "tile", "url")


_R = projections.RADIUS
_M = _R * math.pi / 180
_POINTS_SQL = f"""
rasters AS (
  SELECT c_custkey, c_nationkey, (c_custkey * 7919 % 40001 - 20000) * 1000e0 AS x0, c_acctbal * 1800e0 - 9000000e0 AS y0,
    50000e0 + c_custkey % 7 * 150000e0 AS side FROM customer),
shares AS (SELECT unnest(range(0, {footprints.POINTS + 2})) / {footprints.POINTS + 1}e0 AS s),
corners AS (SELECT *, x0 + side AS x1, y0 + side AS y1 FROM rasters),
points AS (
  SELECT c_custkey, c_nationkey, x0 + (x1 - x0) * s AS x, y0 AS y FROM corners, shares UNION ALL SELECT c_custkey, c_nationkey, x0 + (x1 - x0) * s, y1 FROM corners, shares
  UNION ALL SELECT c_custkey, c_nationkey, x0, y0 + (y1 - y0) * s FROM corners, shares UNION ALL SELECT c_custkey, c_nationkey, x1, y0 + (y1 - y0) * s FROM corners, shares)"""
_SINU_SQL = f"""{_POINTS_SQL},
turned AS (
  SELECT *, y / {_M!r} AS lat, CASE WHEN abs(y / {_M!r}) >= 90 THEN 0 ELSE x / ({_M!r} * cos(radians(y / {_M!r}))) END AS away FROM points),
seen AS (
  SELECT c_custkey, min(away) + {CENTRAL} AS lon0, min(lat) AS lat0, max(away) + {CENTRAL} AS lon1, max(lat) AS lat1
  FROM (SELECT c_custkey, away, greatest(-90, least(90, lat)) AS lat FROM turned WHERE abs(away) <= 180 + {projections.EDGE} AND abs(lat) <= 90 + {projections.EDGE})
  GROUP BY c_custkey),
boxes AS (
  SELECT c_custkey, lon0, lat0, least(lon1, 180) AS lon1, lat1 FROM seen WHERE lon0 < 180 AND lon1 > -180
  UNION ALL SELECT c_custkey, greatest(lon0, 180) - 360, lat0, lon1 - 360, lat1 FROM seen WHERE lon1 > 180 OR lon0 >= 180
  UNION ALL SELECT c_custkey, NULL, NULL, NULL, NULL FROM rasters WHERE c_custkey NOT IN (SELECT c_custkey FROM seen))"""


def _lobe(at: int) -> str:
    """End or centre of the lobe of an easting."""
    def case(parts: tuple) -> str:
        return "CASE " + " ".join(f"WHEN x <= {p[1] * _M!r} THEN {p[at]}" for p in parts[:-1]) + f" ELSE {parts[-1][at]} END"
    return f"CASE WHEN y >= 0 THEN {case(projections.NORTH)} ELSE {case(projections.SOUTH)} END"


_HOMO_SQL = f"""{_POINTS_SQL},
lobed AS (
  SELECT *, ({_lobe(0)})::DOUBLE AS west, ({_lobe(1)})::DOUBLE AS east, ({_lobe(2)})::DOUBLE AS central, abs(y) > {projections.JOINT * _M!r} AS polar,
    (y + sign(y) * {projections.joint_shift()!r}) / {projections.ROOT2 * _R!r} AS sine FROM points),
angled AS (SELECT *, CASE WHEN abs(sine) <= 1 + {projections.EDGE} THEN asin(greatest(-1, least(1, sine))) END AS t FROM lobed),
turned AS (
  SELECT *, CASE WHEN polar THEN degrees(asin(greatest(-1, least(1, (2 * t + sin(2 * t)) / pi())))) ELSE y / {_M!r} END AS lat,
    CASE WHEN polar THEN CASE WHEN cos(t) < 1e-12 THEN 0 ELSE degrees((x - central * {_M!r}) / ({2 * projections.ROOT2 * _R / math.pi!r} * cos(t))) END
      ELSE (x - central * {_M!r}) / ({_M!r} * cos(radians(y / {_M!r}))) END AS away FROM angled),
seen AS (
  SELECT c_custkey, c_nationkey, min(away + central) AS lon0, min(lat) AS lat0, max(away + central) AS lon1, max(lat) AS lat1 FROM turned
  WHERE (NOT polar OR t IS NOT NULL) AND abs(away) <= 180 + {projections.EDGE} AND away + central BETWEEN west - {projections.EDGE} AND east + {projections.EDGE}
  GROUP BY ALL),
boxes AS (
  SELECT c_custkey, c_nationkey, lon0, lat0, lon1, lat1 FROM seen
  UNION ALL SELECT c_custkey, c_nationkey, NULL, NULL, NULL, NULL FROM rasters WHERE c_custkey NOT IN (SELECT c_custkey FROM seen))"""
_BOUNDS = ", ".join(f"{sql_snap(c)} AS {c}" for c in geo.BOUNDS)
_WEST, _SOUTH, _EAST, _NORTH = geo.AREA_OF_INTEREST


def projection_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Places taken to the map and back by each projection."""
    lon, lat = F.col("c_custkey") * 7919 % 35999 / 100.0 - 179.99, F.col("c_acctbal") / 70 - 55
    out = table(spark, sf, "customer").select("c_custkey", lon.alias("lon"), lat.alias("lat"))
    for name, p in (("sinusoidal", projections.sinusoidal(20.0)), ("mollweide", projections.mollweide()), ("homolosine", projections.homolosine())):
        turn = 20 if name == "sinusoidal" else 0
        out = out.withColumn("_p", p.forward(F.col("lon") + turn, F.col("lat")))
        out = out.withColumn("_q", p.inverse(F.col("_p.x"), F.col("_p.y")))
        out = out.withColumn(f"{name}_lon", snap(F.col("_q.lon") - turn)).withColumn(f"{name}_lat", snap(F.col("_q.lat"))).drop("_p", "_q")
    return out.drop("lon", "lat")


_LON, _LAT = "c_custkey * 7919 % 35999 / 100e0 - 179.99e0", "c_acctbal / 70 - 55"
ROUNDTRIP_SQL = "SELECT c_custkey, " + ", ".join(
    f"{sql_snap(_LON)} AS {n}_lon, {sql_snap(_LAT)} AS {n}_lat" for n in ("sinusoidal", "mollweide", "homolosine")) + " FROM customer"

QUERIES = {
    "homolosine_bounds": (homolosine_bounds, f"WITH {_HOMO_SQL} SELECT c_custkey, {_BOUNDS} FROM boxes"),
    "sinusoidal_bounds": (sinusoidal_bounds, f"WITH {_SINU_SQL} SELECT c_custkey, {_BOUNDS} FROM boxes"),
    "projected_tiles": (projected_tiles, f"""
WITH {_HOMO_SQL} SELECT DISTINCT 'tile-' || CAST(c_nationkey AS VARCHAR) AS tile FROM boxes
WHERE NOT (lon1 < {_WEST} OR lon0 > {_EAST} OR lat1 < {_SOUTH} OR lat0 > {_NORTH})"""),
    "projection_roundtrip": (projection_roundtrip, ROUNDTRIP_SQL),
}
