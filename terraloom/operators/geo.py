"""Grid sampling and bounding-box joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.functions.urls import contains_any
from terraloom.operators.enrich import first_per_key
from terraloom.operators.skew import BLOCK_ROWS, MOST_PARTS, block_join, skew_join

# Area of interest (west, south, east, north) in degrees, and the
# tiles known to cover it.
AREA_OF_INTEREST = (68.0, 8.0, 97.0, 37.0)
KNOWN_TILES = (
    "tileSG-017-053", "tileSG-018-052", "tileSG-018-053", "tileSG-018-054", "tileSG-019-052", "tileSG-019-053",
    "tileSG-019-054", "tileSG-019-055", "tileSG-020-052", "tileSG-020-053", "tileSG-020-054", "tileSG-020-055",
)
BOUNDS = ("lon0", "lat0", "lon1", "lat1")
BOX_CELLS = 8  # of one box at its own level, at most
LEVELS = (-12, 24)  # finest and coarsest cells of a box join are 2^level degrees wide


def cell(coordinate: Column, resolution: float) -> Column:
    return F.floor(coordinate / F.lit(float(resolution)))


def with_cells(df: DataFrame, resolution: float, lon: str = "lon", lat: str = "lat") -> DataFrame:
    return df.withColumns({"cell_x": cell(F.col(lon), resolution), "cell_y": cell(F.col(lat), resolution)})


def sample_grid(
    points: DataFrame, cells: DataFrame, resolution: float, point_id: str, hot_rows: int | None = None
) -> DataFrame:
    """Values of the grid cell each point lies in; points off the grid keep NULLs.

    ``cells`` has one row per cell (and per season, if it carries seasons): reduce
    the observations by cell first, so points in a crowded cell meet one row and
    not its whole time series.
    """
    sized = {} if hot_rows is None else {"hot_rows": hot_rows}
    return skew_join(
        with_cells(points, resolution), cells, ["cell_x", "cell_y"], "left", spread_by=F.col(point_id), **sized
    )


def first_in_cell(obs: DataFrame, order: str, value: str) -> DataFrame:
    """Earliest non-null value of every cell."""
    return obs.where(F.col(value).isNotNull()).groupBy("cell_x", "cell_y").agg(F.min_by(value, order).alias(value))


def boxes_overlap(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Closed boxes (west, south, east, north): touching edges and corners count."""
    return ~((a[2] < b[0]) | (a[0] > b[2]) | (a[3] < b[1]) | (a[1] > b[3]))


def sound_box(test: Column, prefix: str = "") -> Column:
    """``test`` where the bounds columns describe a box; west > east or south > north is an error.

    A box across the 180th meridian has to be given as two.
    """
    lon0, lat0, lon1, lat1 = (F.col(f"{prefix}{c}") for c in BOUNDS)
    shown = F.concat_ws(" ", lon0, lat0, lon1, lat1)
    wrong = F.raise_error(F.concat(F.lit("bounds west south east north are no box: "), shown)).cast("boolean")
    return F.when((lon0 > lon1) | (lat0 > lat1), wrong).otherwise(test)


def overlaps_area(area: Sequence[float] = AREA_OF_INTEREST) -> Column:
    """Filter on the bounds columns: the box overlaps one fixed area."""
    return sound_box(boxes_overlap([F.col(c) for c in BOUNDS], [F.lit(float(v)) for v in area]))


def _spans(prefix: str, level: Column) -> list[Column]:
    """First and last cell of the box columns at a level, west-east then south-north; a cell is 2^level wide."""
    side = F.pow(F.lit(2.0), level)
    lon0, lat0, lon1, lat1 = (F.floor(F.col(f"{prefix}{c}") / side) for c in BOUNDS)
    return [lon0, lon1, lat0, lat1]


def _levelled(boxes: DataFrame, name: str, out: str, prefix: str) -> DataFrame:
    """Whole boxes with ``_level``, the finest at which a box has at most ``BOX_CELLS`` cells."""
    bounds = [F.col(c) for c in BOUNDS]
    whole = reduce(and_, [b.isNotNull() for b in bounds])
    far = reduce(or_, [~(F.abs(b) <= float(2**LEVELS[1])) for b in bounds])
    wrong = F.raise_error(F.concat(F.lit("bounds west south east north are no box: "), F.concat_ws(" ", *bounds))).cast("boolean")
    sound = boxes.where(sound_box(F.when(whole & far, wrong).otherwise(whole)))
    named = sound.select(F.col(name).alias(out), *[F.col(c).alias(f"{prefix}{c}") for c in BOUNDS])

    def few(level: Column) -> Column:
        west, east, south, north = _spans(prefix, level)
        return (east - west + 1).cast("double") * (north - south + 1).cast("double") <= BOX_CELLS

    # A box spans 32 cells or more five levels below its own size, and two at most a level above it; no other level need be tried.
    size = F.greatest(F.col(f"{prefix}lon1") - F.col(f"{prefix}lon0"), F.col(f"{prefix}lat1") - F.col(f"{prefix}lat0"))
    finest = F.greatest(F.lit(LEVELS[0]), F.floor(F.log2(size)).cast("int") - 4)  # of a point: the finest there is
    tried = F.sequence(finest, F.least(F.lit(LEVELS[1] + 1), finest + 8))
    return named.withColumn("_level", F.array_min(F.filter(tried, few)))


def _cells(boxes: DataFrame, prefix: str, levels: Column) -> DataFrame:
    """A row per cell of each box at the given levels: ``_at``, ``_cx``, ``_cy``, and whether it is in the box's first column and row."""
    west, east, south, north = _spans(prefix, F.col("_at"))
    return (
        boxes.withColumn("_at", F.explode(levels)).withColumns({"_w": west, "_s": south}).withColumn("_cx", F.explode(F.sequence(F.col("_w"), east)))
        .withColumn("_cy", F.explode(F.sequence(F.col("_s"), north)))
        .withColumns({f"{prefix}first_x": F.col("_cx") == F.col("_w"), f"{prefix}first_y": F.col("_cy") == F.col("_s")}).drop("_level", "_w", "_s")
    )


def bbox_overlap_join(
    items: DataFrame, areas: DataFrame, item_id: str, area_id: str, hot_rows: int = BLOCK_ROWS, salts: int = MOST_PARTS,
) -> DataFrame:
    """(item, area) for every pair of overlapping boxes, whatever their sizes.

    Cells form a quad-tree.  A box lies in at most ``BOX_CELLS`` cells of its own level, and in their ancestors; two boxes that
    overlap share a cell of the coarser one's level.  So items and their ancestors meet the areas' own cells, and the ancestors of
    finer areas meet the items' own.  Only ancestors at levels that the other side has are made, at most one short list of levels per
    side.  A pair that shares several cells is kept in the one holding the south-west corner of its intersection, so no distinct is
    needed.  A cell with more than ``hot_rows`` of a side is joined in blocks, at most ``salts`` by ``salts`` of them.  Boxes that lack a
    bound overlap nothing; west > east or south > north is an error, as in ``overlaps_area``, and so are bounds beyond 2^24.
    """
    i, a = _levelled(items, item_id, "_item", "_i_"), _levelled(areas, area_id, "_area", "_a_")
    item_levels, area_levels = (sorted(r[0] for r in df.select("_level").distinct().collect()) for df in (i, a))

    def coarser(levels: list[int], equal: bool) -> Column:
        known = F.array(*map(F.lit, levels)).cast("array<int>")
        return F.filter(known, lambda x: x >= F.col("_level") if equal else x > F.col("_level"))

    on, own = ["_at", "_cx", "_cy"], F.array("_level")
    rows = F.struct("_item", *[f"_i_{c}" for c in BOUNDS]), F.struct("_area", *[f"_a_{c}" for c in BOUNDS])
    finer_items = block_join(_cells(i, "_i_", coarser(area_levels, True)), _cells(a, "_a_", own), on, *rows, hot_rows, salts)
    finer_areas = block_join(_cells(i, "_i_", own), _cells(a, "_a_", coarser(item_levels, False)), on, *rows, hot_rows, salts)
    ib, ab = [F.col(f"_i_{c}") for c in BOUNDS], [F.col(f"_a_{c}") for c in BOUNDS]
    # The corner is the first column and row of one of the boxes: both begin there or further to the south-west.
    corner = (F.col("_i_first_x") | F.col("_a_first_x")) & (F.col("_i_first_y") | F.col("_a_first_y"))
    return finer_items.unionByName(finer_areas).where(boxes_overlap(ib, ab) & corner).select(
        F.col("_item").alias(item_id), F.col("_area").alias(area_id))


def tiles_per_area(items: DataFrame, areas: DataFrame, tile: str, area_id: str, **options) -> DataFrame:
    """(tile, area) for every area that some item of a tile overlaps, with the number of such items."""
    pairs = bbox_overlap_join(items, areas, tile, area_id, **options)
    return pairs.groupBy(tile, area_id).agg(F.count("*").alias("n_items"))


def tiles_covering(
    tiles: DataFrame, items: DataFrame, tile: str, url: str, area: Sequence[float] = AREA_OF_INTEREST,
    sample: int | None = None, known: Sequence[str] = (),
) -> DataFrame:
    """Tiles with at least one overlapping item.

    All items are looked at, or with ``sample`` so many per tile, in url order; tiles on the ``known`` list pass unseen.
    """
    looked_at = items.select(tile, url, *BOUNDS)
    if sample is not None:  # the sampling rule is the feature: it decides which tiles pass
        looked_at = first_per_key(looked_at, [tile], [url], sample)
    hits = looked_at.where(overlaps_area(area)).groupBy(tile).agg(F.lit(True).alias("_hit"))
    listed = contains_any(F.col(tile), list(known))
    return (
        tiles.join(hits, tile, "left").where(listed | F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")
    )
