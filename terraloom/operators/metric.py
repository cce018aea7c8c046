"""Sampling at a scale in metres: an equal-area grid, and the nearest cell that holds a value.

Cells are those of a sinusoidal grid: rows of equal height, and in each row columns of the same width in metres.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.operators.enrich import first_per_key
from terraloom.operators.skew import skew_join
from terraloom.session import ensure_checkpoint_dir

EARTH = 6_371_007.181  # fixed value: radius in metres of the sphere that such grids use
SCALE = 500.0  # fixed value: metres
HOT_CELL_ROWS = 200_000
POLEWARDS = 85.0
METRES = EARTH * math.pi / 180  # of a degree of latitude


def grid_row(lat: Column, scale: float = SCALE) -> Column:
    return F.floor(lat * F.lit(METRES) / F.lit(scale))


def row_centre(row: Column, scale: float = SCALE) -> Column:
    """Latitude of the middle of a row."""
    return (row + F.lit(0.5)) * F.lit(scale) / F.lit(METRES)


def grid_column(lon: Column, row: Column, scale: float = SCALE) -> Column:
    """Column in a row, whose cells are as wide in metres as those of any other."""
    return F.floor(lon * F.lit(METRES) * F.cos(F.radians(row_centre(row, scale))) / F.lit(scale))


def column_centre(column: Column, row: Column, scale: float = SCALE) -> Column:
    """Longitude of the middle of a cell."""
    return (column + F.lit(0.5)) * F.lit(scale) / (F.lit(METRES) * F.cos(F.radians(row_centre(row, scale))))


def with_metric_cells(df: DataFrame, scale: float = SCALE, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add ``cell_row`` and ``cell_column``; points without a place have none."""
    placed = df.withColumn("cell_row", grid_row(F.col(lat), scale))
    return placed.withColumn("cell_column", grid_column(F.col(lon), F.col("cell_row"), scale))


def distance(lon0: Column, lat0: Column, lon1: Column, lat1: Column) -> Column:
    """Great-circle metres."""
    def square(x: Column) -> Column:
        return x * x
    across = square(F.sin(F.radians(lon1 - lon0) / 2)) * F.cos(F.radians(lat0)) * F.cos(F.radians(lat1))
    return F.lit(2 * EARTH) * F.asin(F.sqrt(F.least(F.lit(1.0), square(F.sin(F.radians(lat1 - lat0) / 2)) + across)))


def _ring(rows: DataFrame, ring: Column, scale: float) -> DataFrame:
    """A row per cell at a ring around each point: rows up to ``ring`` away, in the outer two every column, else the outer columns."""
    beside = F.when(F.abs(F.col("_dr")) == ring, F.sequence(-ring, ring)).otherwise(F.array_distinct(F.array(-ring, ring)))
    at = rows.withColumn("_dr", F.explode(F.sequence(-ring, ring))).withColumn("_dc", F.explode(beside))
    at = at.withColumn("_row", F.col("cell_row") + F.col("_dr")).withColumn("_lon", F.explode("_lons"))
    return at.withColumn("_column", grid_column(F.col("_lon"), F.col("_row"), scale) + F.col("_dc")).drop("_dr", "_dc", "_lon")


def _unseen(ring: int, scale: float) -> Column:
    """No cell outside the rings up to this one has its middle nearer than this."""
    # Columns are counted from the point's own in every row; towards the pole they are narrower in degrees than at the row they were counted in.
    equatorwards = F.greatest(F.lit(0.0), F.abs(F.radians("lat")) - F.lit((ring + 1) * scale / EARTH))
    return F.lit(0.999 * (ring + 0.5) * scale) * F.sqrt(F.cos(F.radians("lat")) / F.cos(equatorwards))


def nearest_cells(
    points: DataFrame, cells: DataFrame, point_id: str, reach: float, scale: float = SCALE, hot_rows: int = HOT_CELL_ROWS,
) -> DataFrame:
    """Every point with ``cell_row``, ``cell_column`` and ``metres`` of the nearest cell of ``cells`` within ``reach`` metres, else NULLs.

    Rings of cells are searched outwards around points that are not settled: one is, once no cell further out can be nearer.  The
    distance is that to the middle of the cell; of equally near ones the southern, then the western is taken.  The number of rounds is bounded by
    ``reach / scale``; each is stored, and a round asks for 8 x ring cells of each open point.  ``point_id`` has to be unique.  Points
    within reach of the 180th meridian are sought on both sides of it; beyond 85 degrees of latitude, where such a grid has few columns,
    nothing is found.
    """
    ensure_checkpoint_dir(points.sparkSession)
    valid = cells.select(F.col("cell_row").alias("_row"), F.col("cell_column").alias("_column")).where("_row IS NOT NULL AND _column IS NOT NULL").distinct().checkpoint()
    open_ = with_metric_cells(points.select(point_id, "lon", "lat"), scale).where(
        F.col("cell_column").isNotNull() & (F.abs("lat") <= POLEWARDS))
    span = F.lit(2 * (reach + scale) / METRES) / F.cos(F.radians("lat"))
    open_ = open_.withColumn("_lons", F.when(F.abs("lon") + span > 180, F.array(F.col("lon"), F.col("lon") - 360 * F.signum("lon"))).otherwise(F.array("lon")))
    open_ = open_.withColumn("_best", F.lit(None).cast("struct<metres: double, cell_row: bigint, cell_column: bigint>"))
    settled = []
    for ring in range(int(reach / scale) + 2):
        asked = _ring(open_, F.lit(ring), scale)
        met = skew_join(asked, valid.withColumn("_there", F.lit(True)), ["_row", "_column"], "left", F.col(point_id), hot_rows)
        here = F.when(F.col("_there"), F.struct(
            distance(F.col("lon"), F.col("lat"), column_centre(F.col("_column"), F.col("_row"), scale), row_centre(F.col("_row"), scale)).alias("metres"),
            F.col("_row").alias("cell_row"), F.col("_column").alias("cell_column")))
        best = F.least(F.min("_best"), F.min(F.when(here["metres"] <= reach, here)))
        tried = met.groupBy(point_id, "lon", "lat", "_lons", "cell_row", "cell_column").agg(best.alias("_best")).checkpoint()
        done = F.coalesce(F.col("_best.metres"), F.lit(float(reach))) < _unseen(ring, scale)
        settled.append(tried.where(done).select(point_id, "_best"))
        open_ = tried.where(~done)
        if open_.isEmpty():
            break
    settled.append(open_.select(point_id, "_best"))
    found = settled[0]
    for part in settled[1:]:
        found = found.unionByName(part)
    found = found.select(point_id, "_best.cell_row", "_best.cell_column", "_best.metres")
    return points.join(found, point_id, "left")


def sample_nearest(
    points: DataFrame, cells: DataFrame, point_id: str, reach: float, scale: float = SCALE, hot_rows: int = HOT_CELL_ROWS,
) -> DataFrame:
    """Points with the values of the nearest cell; ``cells`` has one row per cell, and per season if it carries seasons."""
    return skew_join(nearest_cells(points, cells, point_id, reach, scale, hot_rows), cells, ["cell_row", "cell_column"], "left", F.col(point_id), hot_rows)


def first_in_metric_cell(obs: DataFrame, order: str, value: str) -> DataFrame:
    """Earliest non-null value of every cell: what the first reducer of a region at this scale returns."""
    return obs.where(F.col(value).isNotNull()).groupBy("cell_row", "cell_column").agg(F.min_by(value, order).alias(value))
