"""Equal-area cells and the nearest of them against looking at all."""

from __future__ import annotations

import math
import random

import pytest

from terraloom.operators import metric


def metres(lon0, lat0, lon1, lat1):
    a = math.sin(math.radians(lat1 - lat0) / 2) ** 2 + math.sin(math.radians(lon1 - lon0) / 2) ** 2 * math.cos(math.radians(lat0)) * math.cos(math.radians(lat1))
    return 2 * metric.EARTH * math.asin(min(1, math.sqrt(a)))


def centre(row, column, scale):
    lat = (row + 0.5) * scale / metric.METRES
    return (column + 0.5) * scale / (metric.METRES * math.cos(math.radians(lat))), lat


@pytest.mark.parametrize(("seed", "where", "hot"), [(1, (10.0, 20.0), 10**6), (2, (-60.0, 78.0), 3), (3, (179.6, -40.0), 10**6), (4, (5.0, 0.0), 0)])
def test_nearest(spark, seed, where, hot):
    """Around the equator, far north, and on both sides of the 180th meridian."""
    rng, scale, reach = random.Random(seed), 5_000.0, 42_000.0
    lon0, lat0 = where
    wide = 1 / math.cos(math.radians(lat0))

    def place():
        lon = lon0 + rng.uniform(-1, 1) * wide
        return (lon + 540) % 360 - 180, lat0 + rng.uniform(-1, 1)
    points = [(i, *place()) for i in range(60)] + [(100, None, 1.0), (101, lon0, 89.0)]
    held = metric.with_metric_cells(spark.createDataFrame([place() for _ in range(40)] * 2, "lon double, lat double"), scale)
    cells = {(r.cell_row, r.cell_column) for r in held.collect()}
    got = metric.nearest_cells(spark.createDataFrame(points, "id int, lon double, lat double"), held, "id", reach, scale, hot).collect()
    assert len(got) == len(points)
    for r in got:
        near = [] if r.lon is None or abs(r.lat) > 85 else sorted((metres(r.lon, r.lat, *centre(*c, scale)), *c) for c in cells)
        if near and near[0][0] <= reach:
            assert (r.cell_row, r.cell_column) == near[0][1:] and r.metres == pytest.approx(near[0][0], abs=1e-3)
        else:
            assert (r.cell_row, r.cell_column, r.metres) == (None, None, None)


def test_cells_have_equal_areas(spark):
    """Cells are as wide in metres at 60 degrees as at the equator, and their middles lie in them."""
    df = metric.with_metric_cells(spark.createDataFrame([(12.3, 0.001), (12.3, 60.0), (-12.3, -60.0)], "lon double, lat double"), 500.0)
    for r in df.collect():
        lon, lat = centre(r.cell_row, r.cell_column, 500.0)
        lon2, _ = centre(r.cell_row, r.cell_column + 1, 500.0)
        assert metres(lon, lat, lon2, lat) == pytest.approx(500, rel=1e-4) and metres(lon, lat, r.lon, r.lat) < 500


def test_nothing_valid(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0)], "id int, lon double, lat double")
    none = metric.with_metric_cells(points, 500.0).where("id > 1")
    assert metric.sample_nearest(points, none.select("cell_row", "cell_column"), "id", 1000.0).first().metres is None
    assert metric.nearest_cells(points.where("id > 1"), metric.with_metric_cells(points, 500.0), "id", 1000.0).count() == 0
