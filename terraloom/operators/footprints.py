"""Bounds of rasters brought from their own projection to degrees."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.functions.projections import Projection
from terraloom.operators.geo import BOUNDS

PROJECTED = ("x0", "y0", "x1", "y1")
POINTS = 21  # fixed value: points looked at between two corners


def _edges(boxes: DataFrame, points: int) -> DataFrame:
    """A row (_x, _y) for each of the corners and of ``points`` places along each edge of the projected bounds, in their stead."""
    x0, y0, x1, y1 = (F.col(c) for c in PROJECTED)
    rest, edge, s = [c for c in boxes.columns if c not in PROJECTED], F.col("_edge"), F.col("_s")
    placed = boxes.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(4 * (points + 2) - 1)))).withColumns(
        {"_edge": F.floor(F.col("_k") / (points + 2)), "_s": F.col("_k") % (points + 2) / F.lit(float(points + 1))})
    x = F.when(edge <= 1, x0 + (x1 - x0) * s).when(edge == 2, x0).otherwise(x1)
    y = F.when(edge == 0, y0).when(edge == 1, y1).otherwise(y0 + (y1 - y0) * s)
    return placed.select(*rest, x.alias("_x"), y.alias("_y"))


def degree_bounds(items: DataFrame, projection: Projection, points: int = POINTS) -> DataFrame:
    """Items with ``lon0 lat0 lon1 lat1`` in place of ``x0 y0 x1 y1``.

    The edges are looked at in ``points`` places, since they are curves in degrees; places off the map do not count.  A box across the
    180th meridian becomes two rows; one that touches the map nowhere, or lacks a bound, has NULLs.
    """
    whole = reduce(and_, [F.col(c).isNotNull() for c in PROJECTED])
    rest = [c for c in items.columns if c not in PROJECTED]
    # Every place is a row, so that its expressions are compiled; those of an item stay in its task, which finds their bounds.
    tasks = max(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    boxes = items.select(*rest, *[F.when(whole, F.col(c).cast("double")).alias(c) for c in PROJECTED]).withColumn("_row", F.monotonically_increasing_id())
    places = projection.to_degrees(_edges(boxes.repartition(tasks, "_row"), points), "_x", "_y", "_at_")
    on_map = F.col("_at_lon").isNotNull() & F.col("_at_lat").isNotNull()
    seen = places.groupBy("_row", *rest).agg(*[
        fold(F.when(on_map, F.col(f"_at_{at}"))).alias(name)
        for name, fold, at in zip(BOUNDS, (F.min, F.min, F.max, F.max), ("lon", "lat", "lon", "lat"), strict=True)])
    west, south, east, north = (F.col(c) for c in BOUNDS)

    def box(a: Column, b: Column) -> Column:
        return F.struct(*[v.alias(c) for v, c in zip((a, south, b, north), BOUNDS, strict=True)])

    # All turns are whole ones: a box lies on one side of the meridian, or is cut there.
    parts = (
        F.when((east > 180) & (west < 180), F.array(box(west, F.lit(180.0)), box(F.lit(-180.0), east - 360)))
        .when((west < -180) & (east > -180), F.array(box(F.lit(-180.0), east), box(west + 360, F.lit(180.0))))
        .when(west >= 180, F.array(box(west - 360, east - 360))).when(east <= -180, F.array(box(west + 360, east + 360)))
        .otherwise(F.array(box(west, east)))
    )
    return seen.select(*rest, F.explode(parts).alias("_box")).select(*rest, *[f"_box.{c}" for c in BOUNDS])
