"""Grid sampling, box joins, links, walks and tile selection."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from terraloom.operators import crawl, geo, skew

BOX = "id int, lon0 double, lat0 double, lon1 double, lat1 double"


@pytest.mark.parametrize("hot_rows", [10**6, 10, 0])
def test_box_join_brute_force(spark, rows, hot_rows):
    """Random boxes plus edge and corner contacts; many share one cell."""
    rng = random.Random(2)

    def box(i, crowded):
        x, y = (rng.uniform(0, 3), rng.uniform(0, 3)) if crowded else (rng.uniform(-180, 170), rng.uniform(-80, 80))
        return (i, x, y, x + rng.uniform(0, 9), y + rng.uniform(0, 9))

    items = [box(i, i % 3 == 0) for i in range(150)] + [(900, 0.0, 0.0, 10.0, 10.0), (901, 10.0, 10.0, 20.0, 20.0), (902, 5.0, 5.0, 5.0, 5.0)]
    areas = [box(i, i % 2 == 0) for i in range(60)] + [(900, 10.0, 0.0, 20.0, 10.0), (901, 10.0, 10.0, 10.0, 10.0), (902, -180.0, -90.0, 180.0, 90.0)]
    got = geo.bbox_overlap_join(spark.createDataFrame(items, BOX), spark.createDataFrame(areas, BOX).withColumnRenamed("id", "aid"),
                                "id", "aid", hot_rows, salts=4)
    want = sorted(((i[0], a[0]) for i in items for a in areas
                   if not (i[3] < a[1] or i[1] > a[3] or i[4] < a[2] or i[2] > a[4])), key=lambda r: tuple((False, str(x)) for x in r))
    assert rows(got) == want


def test_cells_of_a_box_are_bounded(spark):
    """A box over the globe, a strip around it and a point all lie in a few cells of their own level, and fewer of coarser ones."""
    boxes = [(1, -180.0, -90.0, 180.0, 90.0), (2, -180.0, 0.0, 180.0, 0.001), (3, 5.0, 5.0, 5.0, 5.0), (4, 0.99, 0.99, 1.01, 1.01), (5, -2.0**24, -2.0**24, 2.0**24, 2.0**24)]
    levelled = geo._levelled(spark.createDataFrame(boxes, BOX), "id", "_item", "_i_")
    for up in (0, 1, 3):
        cells = geo._cells(levelled, "_i_", F.array(F.col("_level") + up)).groupBy("_item").count().collect()
        assert len(cells) == 5 and max(r["count"] for r in cells) <= geo.BOX_CELLS
    far = spark.createDataFrame([(1, 0.0, 0.0, 2.0**25, 1.0)], BOX)
    with pytest.raises(Exception, match="no box"):
        geo.bbox_overlap_join(far, far.withColumnRenamed("id", "area"), "id", "area").collect()


def test_pairs_of_a_crowded_cell_are_spread(spark):
    """Few small items meet many large areas in one cell: no task makes all the pairs, and every pair is there."""
    items = spark.range(90).selectExpr("CAST(id AS int) AS id", "2D AS lon0", "3D AS lat0", "10D AS lon1", "9D AS lat1")
    areas = spark.range(4000).selectExpr("CAST(id AS int) AS area", "1D AS lon0", "1D AS lat0", "100D AS lon1", "60D AS lat1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as between large tables
    try:
        pairs = geo.bbox_overlap_join(items, areas, "id", "area", 100)
        shares = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(shares) == 90 * 4000 and max(shares) < 0.6 * sum(shares)


@pytest.mark.parametrize("block", [0, 3, 10**6])
def test_block_join_is_a_join(spark, rows, block):
    left = spark.createDataFrame([(None if i % 10 == 9 else i % 3, i // 2) for i in range(40)], "k int, a int")
    right = spark.createDataFrame([(None if i % 7 == 6 else i % 4, i // 3) for i in range(30)], "k int, b int")
    got = skew.block_join(left, right, ["k"], F.col("a"), F.col("b"), block)
    assert rows(got) == rows(left.join(right, "k"))


def test_levels_are_the_finest(spark):
    """The few levels that are tried hold the finest at which a box has so many cells, whatever its size and shape."""
    rng, rows = random.Random(4), []
    for i in range(300):
        x, y, w, h = rng.uniform(-180, 180), rng.uniform(-90, 90), 2 ** rng.uniform(-16, 10), 2 ** rng.uniform(-16, 10)
        rows.append((i, x, y, x + (0 if i % 9 == 0 else w), y + (0 if i % 9 < 2 else h)))
    got = {r._item: r._level for r in geo._levelled(spark.createDataFrame(rows, BOX), "id", "_item", "_i_").collect()}
    for i, *b in rows:
        spans = ((up, [math.floor(v / 2.0**up) for v in b]) for up in range(geo.LEVELS[0], geo.LEVELS[1] + 2))
        assert got[i] == next(up for up, (w, s, e, n) in spans if (e - w + 1) * (n - s + 1) <= geo.BOX_CELLS)


def test_area_of_interest(spark, rows):
    boxes = [(1, 70.0, 10.0, 71.0, 11.0), (2, 60.0, 0.0, 120.0, 60.0), (3, 97.0, 10.0, 99.0, 11.0), (4, 97.0, 37.0, 98.0, 38.0),
             (5, 97.1, 10.0, 99.0, 11.0), (6, 60.0, 10.0, 67.9, 11.0), (7, 70.0, 37.1, 71.0, 38.0), (8, 70.0, 0.0, 71.0, 7.9)]
    assert rows(spark.createDataFrame(boxes, BOX).where(geo.overlaps_area()), "id") == [(1,), (2,), (3,), (4,)]


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_sample_grid(spark, rows, hot_rows):
    points = spark.createDataFrame([(i, 0.5, 0.5) for i in range(10)] + [(10, -0.5, 1.5), (11, 9.0, 9.0)], "id int, lon double, lat double")
    cells = spark.createDataFrame([(0, 0, 5.0), (-1, 1, 6.0)], "cell_x long, cell_y long, evi double")
    got = rows(geo.sample_grid(points, cells, 1.0, "id", hot_rows), "id", "evi")
    assert sorted(got) == [(i, 5.0) for i in range(10)] + [(10, 6.0), (11, None)]
    obs = spark.createDataFrame([(0, 0, 2, 7.0), (0, 0, 1, None), (0, 0, 3, 8.0)], "cell_x int, cell_y int, ts int, evi double")
    assert rows(geo.first_in_cell(obs, "ts", "evi")) == [(0, 0, 7.0)]


PAGE = """<html><!-- <a href="no/">x</a> --><script>var a='<a href="no2/">';</script><a href="../">up</a><a href='/'>root</a>
<A class="d" HREF="tileSG-017-053/">t</A><a href=A.TIF>a</a><a name="n">none</a><a data-href="z">no</a><a href="x.tif?a=1&amp;b=2">q</a>
<a href="http://o.test/y/">o</a><abbr href="no3">x</abbr></html>"""


def test_extract_links(spark):
    pages = spark.createDataFrame([("http://h.test/d/", PAGE), ("http://h.test/e/", "<p>none</p>")], "url string, html string")
    got = [tuple(r) for r in crawl.extract_links(pages).collect()]
    assert got == [
        ("http://h.test/d/", "tileSG-017-053/", "http://h.test/d/tileSG-017-053/", "dir"),
        ("http://h.test/d/", "A.TIF", "http://h.test/d/A.TIF", "file"),
        ("http://h.test/d/", "x.tif?a=1&b=2", "http://h.test/d/x.tif?a=1&b=2", "file"),
        ("http://h.test/d/", "http://o.test/y/", "http://o.test/y/", "dir"),
    ]


def walked_by_hand(edges, roots, max_depth):
    best = {}
    for root in roots:
        level, seen = {root}, {root}
        for depth in range(max_depth + 1):
            found = {(b, k) for a, b, k in edges if a in level}
            for b, k in found:
                best.setdefault((root, b, k), depth)
            level = {b for b, k in found if k == "dir"} - seen
            seen |= level
    return best


@pytest.mark.parametrize("hot_rows", [10**6, 5, 0])
def test_walk_brute_force(spark, hot_rows):
    """A loop, a page with many links, several roots, repeated links."""
    rng = random.Random(4)
    names = [f"d{i}/" for i in range(30)]
    edges = {(rng.choice(names), rng.choice(names), "dir") for _ in range(80)} | {("d0/", f"f{i}.tif", "file") for i in range(40)}
    edges |= {(n, f"{n}x.TIF", "file") for n in names[::3]} | {("d1/", "d0/", "dir"), ("d0/", "d1/", "dir")}
    links = spark.createDataFrame(sorted(edges) * 2, "page_url string, abs_url string, kind string")
    roots = spark.createDataFrame([("d0/",), ("d5/",), ("absent/",)], "root string")
    for depth in (0, 2, 5):
        got = {(r.root, r.url, r.kind): r.depth for r in crawl.walk_listing(links, roots, depth, hot_rows=hot_rows).collect()}
        assert got == walked_by_hand(edges, ["d0/", "d5/", "absent/"], depth)


def test_deep_walks_have_short_plans(spark):
    """Every level reads stored tables: no join is left in the plan, however deep the walk."""
    links = spark.range(12).selectExpr("concat('d', id, '/') AS page_url", "concat('d', id + 1, '/') AS abs_url", "'dir' AS kind")
    walked = crawl.walk_listing(links, spark.createDataFrame([("d0/",)], "root string"), 10)
    assert "Join" not in walked._jdf.queryExecution().optimizedPlan().toString()
    assert walked.count() == 11


def test_inverted_boxes_are_an_error(spark):
    boxes = spark.createDataFrame([(1, 170.0, 0.0, -170.0, 5.0)], BOX)
    with pytest.raises(Exception, match="no box"):
        boxes.where(geo.overlaps_area()).collect()
    with pytest.raises(Exception, match="no box"):
        geo.bbox_overlap_join(boxes, boxes.withColumnRenamed("id", "area"), "id", "area").collect()


def test_points_without_a_place_are_spread(spark):
    """Half of the points lie nowhere; no shuffle partition gets more than a small multiple of its share."""
    points = spark.range(8000).selectExpr("id", "if(id % 2 = 0, null, id % 50) AS cell_x", "0 AS cell_y")
    cells = spark.range(50).selectExpr("id AS cell_x", "0 AS cell_y", "id AS evi")
    salted = skew.salt_rows(points, skew.hot_keys(points, ["cell_x", "cell_y"], 10**6), ["cell_x", "cell_y"], F.col("id"))
    shares = salted.repartition(8, "cell_x", "cell_y", "_salt").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in shares) < 4 * 1000
    assert skew.skew_join(points, cells, ["cell_x", "cell_y"], "left", F.col("id")).where("evi IS NULL").count() == 4000


def listing(spark, tiles):
    links, catalogue = [], []
    for t, boxes in tiles.items():
        links.append(("http://h/", f"http://h/{t}/", "dir"))
        for i, (x, y) in enumerate(boxes):
            links.append((f"http://h/{t}/", f"http://h/{t}/{i:02d}.tif", "file"))
            catalogue.append((f"http://h/{t}/{i:02d}.tif", x, y, x + 1, y + 1))
    return (spark.createDataFrame(links, "page_url string, abs_url string, kind string"),
            spark.createDataFrame(catalogue, "url string, lon0 double, lat0 double, lon1 double, lat1 double"))


def test_select_tiles(spark, rows):
    """Five files decide; a listed tile passes unseen; a far tile and a tile covered only by its sixth file do not."""
    far, near = (0.0, 0.0), (80.0, 20.0)
    links, catalogue = listing(spark, {"tileSG-a": [far, near], "tileSG-b": [far] * 5 + [near], "tileSG-c": [far], "tileSG-017-053": [far], "other": [near]})
    base = spark.createDataFrame([("http://h/",)], "url string")
    assert rows(crawl.select_tiles(links, catalogue, base, sample=5)) == [("http://h/tileSG-017-053/",), ("http://h/tileSG-a/",)]
    everything = crawl.select_tiles(links, catalogue, base)
    assert rows(everything) == [("http://h/tileSG-017-053/",), ("http://h/tileSG-a/",), ("http://h/tileSG-b/",)]


def test_select_tiles_falls_back(spark):
    links, catalogue = listing(spark, {"other": [(80.0, 20.0)]})
    base = spark.createDataFrame([("http://h/",)], "url string")
    got = {r.tile for r in crawl.select_tiles(links, catalogue, base).collect()}
    assert got == {f"http://h/{t}/" for t in geo.KNOWN_TILES}


def test_inventory_and_outcomes(spark, rows):
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    stored = spark.createDataFrame([("a", 10), ("b", 0)], "path string, length long")
    assert rows(crawl.skip_present(files, stored)) == [("b",), ("c",)]
    assert tuple(crawl.outcome_summary(files, "url", ["a", "z"]).first()) == (1, 0)
