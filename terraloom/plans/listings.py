"""Links, listing walks, fallbacks and outcome counts over stored pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.functions import urls
from terraloom.operators import crawl, geo
from terraloom.operators.enrich import first_per_key
from terraloom.plans.common import table
from terraloom.plans.geo import _TILES_SQL, _tiles


def links_extract(spark: SparkSession, sf: str) -> DataFrame:
    return crawl.extract_links(table(spark, sf, "pages"))


# Link targets in the pages are all quoted and root-relative, so the counterpart only needs the page's host.
LINKS_SQL = r"""
WITH h AS (
  SELECT url AS page_url, unnest(regexp_extract_all(regexp_replace(html, '<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'gis'),
         '<a\s(?:[^>]*?\s)?href\s*=\s*"([^"]*)"', 1, 'is')) AS raw FROM pages
), d AS (
  SELECT page_url, replace(replace(replace(replace(replace(trim(raw), '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS href FROM h
)
SELECT page_url, href, regexp_extract(page_url, '^[a-z]+://[^/?#]*') || href AS abs_url,
       CASE WHEN href LIKE '%/' THEN 'dir' ELSE 'file' END AS kind
FROM d WHERE href <> '/' AND NOT starts_with(href, '../')
"""


def url_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """Every page resolves a set of reference forms built from its own path."""
    last = urls.last_path_part(F.regexp_replace("url", r"[?#].*$", ""))
    refs = F.array(
        F.concat(last, F.lit(".tif")), F.concat(F.lit("./"), last), F.concat(F.lit("?C="), last), F.concat(F.lit("#"), last),
        F.concat(F.lit("//cdn.test/"), last), F.concat(F.lit("/top/../"), last, F.lit("/")), F.concat(F.lit("a/../"), last),
        F.concat(F.lit("ftp://x.test/"), last),
    )
    pages = table(spark, sf, "pages").select("url", F.posexplode(refs).alias("form", "href"))
    return pages.select("url", "form", "href", urls.resolve_url(F.col("url"), F.col("href")).alias("abs_url"))


RESOLVE_SQL = """
WITH p AS (
  SELECT url, regexp_extract(url, '^[a-z]+:') AS scheme, regexp_extract(url, '^[a-z]+://[^/?#]*') AS host,
         regexp_replace(url, '#.*$', '') AS plain, regexp_replace(url, '[?#].*$', '') AS bare,
         regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]+)/*$', 1) AS part FROM pages
), q AS (
  SELECT *, CASE WHEN bare = host THEN host || '/' ELSE regexp_extract(bare, '^(.*/)', 1) END AS dir FROM p
)
SELECT url, CAST(unnest(range(0, 8)) AS INTEGER) AS form,
       unnest([part || '.tif', './' || part, '?C=' || part, '#' || part, '//cdn.test/' || part, '/top/../' || part || '/', 'a/../' || part, 'ftp://x.test/' || part]) AS href,
       unnest([dir || part || '.tif', dir || part, bare || '?C=' || part, plain || '#' || part, scheme || '//cdn.test/' || part,
               host || '/' || part || '/', dir || part, 'ftp://x.test/' || part]) AS abs_url
FROM q
"""


def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Last path part, entry kind and a constructed child url of every link."""
    links = crawl.extract_links(table(spark, sf, "pages"))
    return links.groupBy("href").agg(F.count(F.lit(1)).alias("n")).select(
        "href", "n", urls.last_path_part(F.col("href")).alias("part"), urls.link_kind(F.col("href")).alias("kind"),
        urls.child_url(F.lit("http://base.test/x/"), F.regexp_replace("href", "^/", "")).alias("child"),
    )


PARTS_SQL = f"""
SELECT href, count(*) AS n, regexp_extract(href, '([^/]*)/*$', 1) AS part, any_value(kind) AS kind,
       'http://base.test/x/' || regexp_replace(href, '^/', '') || '/' AS child
FROM ({LINKS_SQL}) GROUP BY href
"""


def _site_links(spark: SparkSession, sf: str) -> DataFrame:
    """Listing links rebuilt from the page urls: site root, language, first character of the page, page."""
    host = F.regexp_extract("url", r"^([a-z]+://[^/?#]*)", 1)
    bare = F.regexp_replace("url", r"[?#].*$", "")
    lang = F.regexp_extract(bare, r"^[a-z]+://[^/]*/([^/]*)/", 1)
    part = urls.last_path_part(bare)
    root = F.concat(host, F.lit("/"))
    first = F.concat(root, lang, F.lit("/"))
    second = F.concat(first, F.substring(part, 1, 1), F.lit("/"))
    return table(spark, sf, "pages").select(F.explode(F.array(
        F.struct(root.alias("page_url"), first.alias("abs_url"), F.lit("dir").alias("kind")),
        F.struct(first.alias("page_url"), second.alias("abs_url"), F.lit("dir").alias("kind")),
        F.struct(second.alias("page_url"), root.alias("abs_url"), F.lit("dir").alias("kind")),
        F.struct(second.alias("page_url"), F.concat(second, part, F.lit("/")).alias("abs_url"), F.lit("dir").alias("kind")),
        F.struct(
            F.concat(second, part, F.lit("/")).alias("page_url"), F.concat(second, part, F.lit("/a.TIF")).alias("abs_url"),
            F.lit("file").alias("kind")),
        F.struct(second.alias("page_url"), F.concat(second, part, F.lit(".tif")).alias("abs_url"), F.lit("file").alias("kind")),
    )).alias("l")).select("l.*")


_SITE_SQL = """
s AS (
  SELECT DISTINCT host || '/' AS root, host || '/' || lang || '/' AS d1, host || '/' || lang || '/' || part[1] || '/' AS d2, part FROM (
    SELECT regexp_extract(url, '^[a-z]+://[^/?#]*') AS host, regexp_extract(bare, '^[a-z]+://[^/]*/([^/]*)/', 1) AS lang,
           regexp_extract(bare, '([^/]*)/*$', 1) AS part
    FROM (SELECT url, regexp_replace(url, '[?#].*$', '') AS bare FROM pages))
), e AS (
  SELECT root AS a, d1 AS b, 'dir' AS kind FROM s UNION SELECT d1, d2, 'dir' FROM s UNION SELECT d2, root, 'dir' FROM s
  UNION SELECT d2, d2 || part || '/', 'dir' FROM s UNION SELECT d2 || part || '/', d2 || part || '/a.TIF', 'file' FROM s
  UNION SELECT d2, d2 || part || '.tif', 'file' FROM s
), w AS (
  SELECT DISTINCT root AS root, root AS at, 0 AS depth FROM s
  UNION
  SELECT w.root, e.b, w.depth + 1 FROM w JOIN e ON e.a = w.at WHERE e.kind = 'dir' AND w.depth < {max_depth}
)
"""


def _walk(spark: SparkSession, sf: str, depth: int) -> DataFrame:
    links = _site_links(spark, sf)
    roots = links.where(F.col("page_url").rlike("^[a-z]+://[^/]*/$")).select(F.col("page_url").alias("root")).distinct()
    return crawl.walk_listing(links, roots, depth)


def _walk_sql(depth: int, tail: str = "") -> str:
    return (f"WITH RECURSIVE {_SITE_SQL.format(max_depth=depth)} SELECT w.root, e.b AS url, e.kind, CAST(min(w.depth) AS INTEGER) AS depth "
            f"FROM w JOIN e ON e.a = w.at {tail} GROUP BY 1, 2, 3")


def crawl_depth(spark: SparkSession, sf: str) -> DataFrame:
    return _walk(spark, sf, crawl.COLLECT_DEPTH)


def crawl_rasters(spark: SparkSession, sf: str) -> DataFrame:
    """Raster files within the sampling depth; the deepest directories stay unread."""
    return crawl.raster_files(_walk(spark, sf, crawl.SAMPLE_DEPTH))


def fallback_rows(spark: SparkSession, sf: str) -> DataFrame:
    """No page links to a tile directory, so every page gets its constructed ones."""
    pages = table(spark, sf, "pages")
    found = crawl.tile_directories(crawl.extract_links(pages)).select("page_url", "abs_url")
    return crawl.with_fallback(found, crawl.constructed_tiles(pages, "url"))


FALLBACK_SQL = f"""
SELECT url AS page_url, rtrim(url, '/') || '/' || unnest([{', '.join(f"'{t}'" for t in geo.KNOWN_TILES)}]) || '/' AS abs_url FROM pages
"""


def fallback_unused(spark: SparkSession, sf: str) -> DataFrame:
    """Tile directories exist, so the fallback adds nothing."""
    tiles = _tiles(spark, sf)[0].select(F.col("tile").alias("abs_url"))
    return crawl.with_fallback(tiles, table(spark, sf, "pages").select(F.col("url").alias("abs_url")))


def select_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Listing pages to covering tiles: walk, first five files, bounds, area."""
    tiles, items = _tiles(spark, sf)
    base = items.select(F.regexp_extract("tile", "^(.*/)tileSG", 1).alias("url")).distinct()
    links = tiles.select(
        F.regexp_extract("tile", "^(.*/)tileSG", 1).alias("page_url"), F.col("tile").alias("abs_url"), F.lit("dir").alias("kind")
    ).unionByName(items.select(F.col("tile").alias("page_url"), F.col("url").alias("abs_url"), F.lit("file").alias("kind")))
    return crawl.select_tiles(links, items.select("url", *geo.BOUNDS), base, sample=5)


SELECT_TILES_SQL = f"WITH {_TILES_SQL} SELECT DISTINCT tile FROM hits WHERE covers AND rn <= 5"


def first_n_per_group(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url", F.regexp_extract("url", "^([a-z]+)://", 1).alias("scheme"))
    return first_per_key(pages, ["scheme"], ["url", "page_id"], 5)


FIRST_N_SQL = """
SELECT page_id, url, regexp_extract(url, '^([a-z]+)://', 1) AS scheme FROM pages
QUALIFY row_number() OVER (PARTITION BY scheme ORDER BY url, page_id) <= 5
"""


def suffix_allowlist(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    return parts.where(urls.has_suffix(F.col("p_type"), "y") & urls.contains_any(F.col("p_name"), ["ring", "red", "bolt"])
                       & F.contains("p_name", F.lit(" ")))


SUFFIX_SQL = """
SELECT p_partkey, p_name, p_type FROM part
WHERE lower(p_type) LIKE '%y' AND regexp_matches(p_name, 'ring|red|bolt') AND contains(p_name, ' ')
"""


def skip_present(spark: SparkSession, sf: str) -> DataFrame:
    """Pages not stored yet: the inventory holds English pages, secure ones as empty files."""
    pages = table(spark, sf, "pages")
    inventory = pages.where(F.contains("url", F.lit("/en/"))).select(
        F.col("url").alias("path"), F.when(F.startswith("url", F.lit("https")), 0).otherwise(F.length("html")).alias("length"))
    return crawl.skip_present(pages.select("page_id", "url"), inventory)


SKIP_SQL = "SELECT page_id, url FROM pages WHERE NOT (contains(url, '/en/') AND NOT starts_with(url, 'https'))"


def outcome_summary(spark: SparkSession, sf: str) -> DataFrame:
    return crawl.outcome_summary(table(spark, sf, "events"), "event_type", ["view", "click", "error", "purchase", "signup"])


OUTCOME_SQL = "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{n}') AS {n}" for n in ("view", "click", "error", "purchase", "signup")) + " FROM events"

QUERIES = {
    "links_extract": (links_extract, LINKS_SQL),
    "url_resolve": (url_resolve, RESOLVE_SQL),
    "url_parts": (url_parts, PARTS_SQL),
    "crawl_depth": (crawl_depth, _walk_sql(3)),
    "crawl_rasters": (crawl_rasters, _walk_sql(2, "WHERE e.kind = 'file' AND lower(e.b) LIKE '%.tif'")),
    "fallback_rows": (fallback_rows, FALLBACK_SQL),
    "fallback_unused": (fallback_unused, f"WITH {_TILES_SQL} SELECT DISTINCT tile AS abs_url FROM items"),
    "select_tiles": (select_tiles, SELECT_TILES_SQL),
    "first_n_per_group": (first_n_per_group, FIRST_N_SQL),
    "suffix_allowlist": (suffix_allowlist, SUFFIX_SQL),
    "skip_present": (skip_present, SKIP_SQL),
    "outcome_summary": (outcome_summary, OUTCOME_SQL),
}
