"""Links of stored listing pages, the depth-limited walk over them, and tile selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.functions import urls
from terraloom.operators import geo
from terraloom.operators.enrich import first_per_key
from terraloom.operators.skew import HOT_ROWS, any_hot, hot_keys, repeat_per_salt, salt_rows
from terraloom.session import ensure_checkpoint_dir

HIDDEN_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
ANCHOR_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# Character references that occur in link targets; the ampersand is decoded last.
REFERENCES = (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))
TILE_MARK = "tileSG-"
SAMPLE_DEPTH = 2
COLLECT_DEPTH = 3


def hrefs(html: Column) -> Column:
    """Array of the link targets on a page, quotes removed and references decoded."""
    found = F.regexp_extract_all(F.regexp_replace(html, HIDDEN_MARKUP, ""), F.lit(ANCHOR_HREF), F.lit(1))

    def decoded(href: Column) -> Column:
        out = F.trim(F.regexp_replace(href, r"""^["']|["']$""", ""))
        for name, char in REFERENCES:
            out = F.replace(out, F.lit(name), F.lit(char))
        return out

    return F.transform(found, decoded)


def extract_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(page_url, href, abs_url, kind) of the entries a listing page links to."""
    links = pages.select(F.col(url).alias("page_url"), F.explode(hrefs(F.col(html))).alias("href"))
    return links.where(urls.is_listing_entry(F.col("href"))).select(
        "page_url", "href", urls.resolve_url(F.col("page_url"), F.col("href")).alias("abs_url"),
        urls.link_kind(F.col("href")).alias("kind"),
    )


def walk_listing(links: DataFrame, roots: DataFrame, max_depth: int, root: str = "root", hot_rows: int = HOT_ROWS) -> DataFrame:
    """(root, url, kind, depth): everything reachable from each root through directories.

    The root is read at depth 0 and directories down to ``max_depth`` are read.
    The links are stored once, by page; every level is one equi-join of the new
    directories with them and is stored as well, so each level reads stored
    tables only and the plan does not grow.  Seen directories are left out, so
    loops end, and the walk stops when nothing new was found.  If a page lists
    very many entries, the links are salted once, before the first level.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = links.select(F.col("page_url").alias("_at"), F.col("abs_url").alias("url"), "kind").distinct().checkpoint()
    crowded = any_hot(edges, ["_at"], hot_rows)
    if crowded:
        hot = hot_keys(edges, ["_at"], hot_rows).checkpoint()
        edges = salt_rows(edges, F.broadcast(hot), ["_at"], F.col("url")).checkpoint()
    frontier = roots.select(F.col(root).alias("root"), F.col(root).alias("_at")).distinct().checkpoint()
    seen, levels = frontier, []
    for depth in range(max_depth + 1):
        if crowded:
            joined = edges.join(repeat_per_salt(frontier, F.broadcast(hot), ["_at"]), ["_at", "_salt"], "inner")
        else:
            joined = edges.join(frontier, "_at", "inner")
        found = joined.select("root", "url", "kind", F.lit(depth).alias("depth")).checkpoint()
        levels.append(found)
        if depth == max_depth:
            break
        fresh = found.where(F.col("kind") == "dir").select("root", F.col("url").alias("_at")).distinct()
        frontier = fresh.join(seen, ["root", "_at"], "left_anti").checkpoint()
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier).checkpoint()
    return reduce(DataFrame.unionByName, levels).groupBy("root", "url", "kind").agg(F.min("depth").alias("depth"))


def raster_files(walked: DataFrame, suffix: str = ".tif") -> DataFrame:
    return walked.where((F.col("kind") == "file") & urls.has_suffix(F.col("url"), suffix))


def tile_directories(links: DataFrame, mark: str = TILE_MARK) -> DataFrame:
    return links.where((F.col("kind") == "dir") & F.contains(F.col("abs_url"), F.lit(mark)))


def with_fallback(main: DataFrame, fallback: DataFrame) -> DataFrame:
    """``main``, or the fallback rows when it is empty."""
    empty = main.limit(1).agg((F.count(F.lit(1)) == 0).alias("e"))
    return main.unionByName(fallback.where(empty.scalar()))


def constructed_tiles(base: DataFrame, url: str, known: Sequence[str] = geo.KNOWN_TILES) -> DataFrame:
    """Tile urls built from a base url and the known tile names."""
    return base.select(
        F.col(url).alias("page_url"),
        F.explode(F.array(*[urls.child_url(F.col(url), F.lit(t)) for t in known])).alias("abs_url"),
    )


def first_files(files: DataFrame, n: int) -> DataFrame:
    """The first ``n`` files below every root, in url order."""
    return first_per_key(files, ["root"], ["url"], n)


def skip_present(files: DataFrame, inventory: DataFrame, path: str = "path", length: str = "length", name: str = "url") -> DataFrame:
    """Files that are not in the inventory, or only as an empty file there."""
    present = inventory.where(F.col(length) > 0).select(F.col(path).alias(name))
    return files.join(present, name, "left_anti")


def select_tiles(
    links: DataFrame, catalogue: DataFrame, base: DataFrame, base_url: str = "url",
    area: Sequence[float] = geo.AREA_OF_INTEREST, known: Sequence[str] = geo.KNOWN_TILES, sample: int | None = None,
) -> DataFrame:
    """Tile directories listed on the base page (or constructed) that cover the area.

    ``catalogue`` gives the bounds of the raster files by url; a sampled file
    that is not in it does not count as covering.
    """
    listed = tile_directories(links.join(base.select(F.col(base_url).alias("page_url")), "page_url", "left_semi"))
    tiles = with_fallback(
        listed.select("page_url", "abs_url"), constructed_tiles(base, base_url, known)
    ).select(F.col("abs_url").alias("tile")).distinct()
    files = raster_files(walk_listing(links, tiles, SAMPLE_DEPTH, root="tile"))
    looked_at = files if sample is None else first_files(files, sample)
    bounded = looked_at.select(F.col("root").alias("tile"), "url").join(
        catalogue.select("url", *geo.BOUNDS), "url", "inner")
    return geo.tiles_covering(tiles, bounded, "tile", "url", area, sample=None, known=known)


def outcome_summary(outcomes: DataFrame, outcome: str, names: Sequence[str]) -> DataFrame:
    """One row of conditional counts, one column per outcome."""
    return outcomes.agg(*[F.count_if(F.col(outcome) == n).alias(n) for n in names])
