"""Projections against known places, their own inverse, and footprints against dense sampling."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from terraloom.functions import projections
from terraloom.operators import footprints

ALL = {"sinusoidal": projections.sinusoidal(), "mollweide": projections.mollweide(), "homolosine": projections.homolosine()}


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame([(float(lon) + 0.37, float(lat)) for lon in range(-180, 180, 9) for lat in (-90, -89.99, -60.5, -40.7, -12, 0, 0.01, 40.73, 40.74, 66, 89.9, 90)],
                                 "lon double, lat double")


@pytest.mark.parametrize("name", ALL)
def test_round_trip(places, name):
    p = ALL[name]
    there = places.withColumn("p", p.forward(F.col("lon"), F.col("lat"))).withColumn("q", p.inverse(F.col("p.x"), F.col("p.y")))
    for r in there.select("lon", "lat", F.col("q.lon").alias("lon2"), F.col("q.lat").alias("lat2")).collect():
        assert r.lat2 == pytest.approx(r.lat, abs=1e-6)
        if abs(r.lat) < 89.999:
            assert r.lon2 == pytest.approx(r.lon, abs=1e-6)


def test_parts_of_the_homolosine_meet():
    """At the joint both parts have the same length along the parallel and, once shifted, the same height."""
    t = math.radians(projections.JOINT)
    for _ in range(50):
        t -= (2 * t + math.sin(2 * t) - math.pi * math.sin(math.radians(projections.JOINT))) / (2 + 2 * math.cos(2 * t))
    assert 2 * math.sqrt(2) / math.pi * math.cos(t) == pytest.approx(math.cos(math.radians(projections.JOINT)), abs=1e-6)
    assert projections.joint_shift() / projections.RADIUS == pytest.approx(0.0528035, abs=1e-6)


def test_places_off_the_map_have_no_degrees(spark):
    df = spark.createDataFrame([(0.0, 1.1e7), (2.1e7, 0.0), (1.9e7, 6e6), (-4.5e6, 8e6)], "x double, y double")
    for r in df.select(ALL["homolosine"].inverse(F.col("x"), F.col("y")).alias("p")).collect():
        assert tuple(r.p) == (None, None)


def boxes(spark, rows, projection, points=21):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, x0 double, y0 double, x1 double, y1 double")
    return sorted(tuple(r) for r in footprints.degree_bounds(df, projection, points).collect())


def test_footprints(spark):
    """Curved edges, a box across the 180th meridian, one beyond it, one off the map and one without a bound."""
    metres = projections.RADIUS * math.pi / 180
    rows = [(10 * metres, 50 * metres, 20 * metres, 60 * metres), (28 * metres, -1 * metres, 32 * metres, 1 * metres), (35 * metres, 0.0, 36 * metres, metres),
            (0.0, 95 * metres, metres, 96 * metres), (0.0, None, 1.0, 1.0)]
    out = boxes(spark, rows, projections.sinusoidal(150.0))
    assert out[0][1:] == pytest.approx((-180, 50, 150 + 20 / math.cos(math.radians(60)) - 360, 60))
    assert out[1][1:] == pytest.approx((150 + 10 / math.cos(math.radians(50)), 50, 180, 60))
    assert out[2][1:] == pytest.approx((-180, -1, -178, 1), abs=1e-2) and out[3][1:] == pytest.approx((178, -1, 180, 1), abs=1e-2)
    assert out[4][1:] == pytest.approx((-175, 0, -174, 1), abs=1e-2)
    assert out[5] == (3, None, None, None, None) and out[6] == (4, None, None, None, None)


def test_edges_are_curves(spark):
    """Corners alone miss where the western edge bulges; more points change little."""
    row = [(-100e3, -5e6, 900e3, 5e6)]
    corners, some, many = (boxes(spark, row, projections.homolosine(), n)[0] for n in (0, 21, 400))
    assert some[1:] == pytest.approx(many[1:], abs=0.05) and corners[4] == pytest.approx(many[4])


def test_places_are_rows(spark):
    """Places are plain columns, no arrays of structs, and the items that make them are spread over the tasks."""
    df = spark.range(64).selectExpr("id % 8 AS id", "id * 1e5 AS x0", "id * 1e5 AS y0", "if(id = 5, null, id * 1e5 + 2e5) AS x1", "id * 1e5 + 2e5 AS y1").coalesce(1)
    seen = footprints.degree_bounds(df, projections.homolosine())
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan
    assert seen.groupBy(F.spark_partition_id()).count().count() > 1
    assert seen.count() == 64 and seen.where("lon0 IS NULL AND lat0 IS NULL AND lon1 IS NULL AND lat1 IS NULL").count() == 1
