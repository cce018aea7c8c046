"""Wide season tables, row ids and frame comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.functions import dates
from terraloom.operators import columns, compare, keys, reshape, timeseries
from terraloom.plans.common import snap, sql_season, sql_season_year, sql_snap, table
from terraloom.sources import files

YEARS = tuple(range(1991, 2003))  # at least these, also when they stay empty
SEASON_YEARS = [(s, y) for y in YEARS for s in ("Kharif", "Rabi")]
STATS = reshape.SEASON_STATS


def _stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = timeseries.season_stats(table(spark, sf, "lineitem"), ["l_suppkey"], "l_shipdate", "l_quantity", closed="both")
    return stats.select(F.col("l_suppkey").alias("id"), "season", "year", *[snap(F.col(c), 4 if c == "intercept" else 6).alias(c) for c in STATS])


_STATS_SQL = f"""
stats AS (
  SELECT id, season, year, {sql_snap('avg(y)')} AS mean, {sql_snap('max(y)')} AS max, {sql_snap('min(y)')} AS min,
         {sql_snap('stddev_pop(y)')} AS "stdDev", {sql_snap('quantile_cont(y, 0.9)')} AS p90,
         {sql_snap('CASE WHEN isnan(regr_slope(y, x)) THEN NULL ELSE regr_slope(y, x) END')} AS slope,
         {sql_snap('CASE WHEN isnan(regr_intercept(y, x)) THEN NULL ELSE regr_intercept(y, x) END', 4)} AS intercept,
         {sql_snap('sum(y) * 16')} AS auc
  FROM (SELECT l_suppkey AS id, l_quantity AS y, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS x,
               {sql_season('l_shipdate')} AS season, {sql_season_year('l_shipdate')} AS year FROM lineitem)
  WHERE season IS NOT NULL GROUP BY id, season, year
)"""


def _season_years(spark: SparkSession, sf: str) -> list[tuple[str, int]]:
    """``SEASON_YEARS``, and all others from the first to the last season-year of the shipments."""
    day = F.to_date("l_shipdate")
    years = table(spark, sf, "lineitem").where(dates.season_name(day).isNotNull()).select(dates.season_year(day).alias("y"))
    low, high = years.agg(F.min("y"), F.max("y")).first()
    if low is None:
        return SEASON_YEARS
    return [(s, y) for y in range(min(low, YEARS[0]), max(high, YEARS[-1]) + 1) for s in ("Kharif", "Rabi")]


def _wide_columns_sql(prefix: str = "") -> str:
    return ", ".join(
        f"max({prefix}\"{v}\") FILTER (WHERE season = '{s}' AND year = {y}) AS \"{v}_{y}_{s}\"" for s, y in SEASON_YEARS for v in STATS
    )


def widen_seasons(spark: SparkSession, sf: str) -> DataFrame:
    return reshape.widen_seasons(_stats(spark, sf), "id", _season_years(spark, sf), STATS)


WIDEN_SQL = f"WITH {_STATS_SQL} SELECT id, {_wide_columns_sql()} FROM stats WHERE year IN {YEARS} GROUP BY id"


def join_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Every other customer number with the seasons of the supplier of that number; rows of either side without a partner stay."""
    master = table(spark, sf, "customer").select((F.col("c_custkey") * 2).alias("id"), "c_name")
    return reshape.join_wide(master, reshape.widen_seasons(_stats(spark, sf), "id", _season_years(spark, sf), STATS), "id")


JOIN_WIDE_SQL = f"""
WITH {_STATS_SQL}
SELECT coalesce(c.id, w.id) AS id, c.c_name, w.* EXCLUDE (id)
FROM (SELECT 2 * c_custkey AS id, c_name FROM customer) c
FULL JOIN (SELECT id, {_wide_columns_sql()} FROM stats GROUP BY id) w ON w.id = c.id
"""


def _season_files(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The statistics stored as one folder per season-year, and every folder read on its own, with its season and year in each row."""
    path = files.scratch_dir(spark, "seasons")
    _stats(spark, sf).write.partitionBy("season", "year").parquet(path)
    folders = sorted(files.matching(spark, f"{path}/season=*/year=*"))
    return [spark.read.option("basePath", files.qualified(spark, path)).parquet(folder) for folder in folders]


def suffixed_season(spark: SparkSession, sf: str) -> DataFrame:
    """Every season's file with its season and year as a column suffix, its cells listed under their new names."""
    named = []
    for season in _season_files(spark, sf):
        which = columns.constant_value(season, ["season", "year"]).first()
        wide = columns.suffix_columns(columns.drop_columns(season, ["season", "year"]), f"_{which.year}_{which.season}", keep=["id"])
        named.append(wide.unpivot("id", [c for c in wide.columns if c != "id"], "column", "value"))
    return reduce(DataFrame.unionByName, named)


SUFFIX_SQL = f"""
WITH {_STATS_SQL}
SELECT id, "column" || '_' || year || '_' || season AS "column", value
FROM (SELECT id, season, year, unnest([{', '.join(f"'{v}'" for v in STATS)}]) AS "column", unnest([{', '.join(f'"{v}"' for v in STATS)}]) AS value FROM stats)
"""


def constant_season(spark: SparkSession, sf: str) -> DataFrame:
    """The season and year that each season's file holds throughout."""
    return reduce(DataFrame.unionByName, [columns.constant_value(season, ["season", "year"]) for season in _season_files(spark, sf)])


CONSTANT_SQL = f"WITH {_STATS_SQL} SELECT DISTINCT season, year FROM stats"


def attach_row_ids(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return keys.attach_row_ids(customer, ["c_nationkey", "c_acctbal", "c_custkey"])


ROW_IDS_SQL = """
SELECT row_number() OVER (ORDER BY c_nationkey, c_acctbal, c_custkey) - 1 AS row_id, c_custkey, c_nationkey, c_acctbal FROM customer
"""


def align_by_position(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers by name against suppliers by balance: equal lengths, joined by position."""
    supplier = table(spark, sf, "supplier")
    return keys.align_by_position(
        supplier.select("s_name"), supplier.select("s_acctbal", "s_suppkey"), ["s_name"], ["s_acctbal", "s_suppkey"]
    )


ALIGN_SQL = """
SELECT a.row_id, s_name, s_acctbal, s_suppkey
FROM (SELECT s_name, row_number() OVER (ORDER BY s_name) - 1 AS row_id FROM supplier) a
JOIN (SELECT s_acctbal, s_suppkey, row_number() OVER (ORDER BY s_acctbal, s_suppkey) - 1 AS row_id FROM supplier) b
  ON a.row_id = b.row_id
"""


def frame_diff(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    altered = customer.where(F.col("c_acctbal") >= 0).withColumns({
        "c_acctbal": F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).cast("decimal(12,2)"),
        "c_name": F.when(F.col("c_acctbal") > 9000, F.lit(None)).otherwise(F.col("c_name")),
    })
    return compare.frame_diff(customer, altered, ["c_custkey"])


FRAME_DIFF_SQL = """
WITH a AS (
  SELECT * REPLACE (CAST(c_acctbal AS DECIMAL(12, 2)) AS c_acctbal) FROM customer
), b AS (
  SELECT c_custkey, CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_name END AS c_name, c_nationkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM a WHERE c_acctbal >= 0
), p AS (
  SELECT c_custkey, unnest(['c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS "column",
         unnest([a.c_name, CAST(a.c_nationkey AS VARCHAR), CAST(a.c_acctbal AS VARCHAR), a.c_mktsegment]) AS "left",
         unnest([b.c_name, CAST(b.c_nationkey AS VARCHAR), CAST(b.c_acctbal AS VARCHAR), b.c_mktsegment]) AS "right"
  FROM a FULL JOIN b USING (c_custkey)
)
SELECT * FROM p WHERE "left" IS DISTINCT FROM "right"
UNION ALL SELECT c_custkey, '(row)', 'present', NULL FROM a WHERE c_custkey NOT IN (SELECT c_custkey FROM b)
"""

def tree_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against a copy in which few cells are changed, few rows lack and one is new, found by their digests."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"))
    altered = orders.where(F.col("o_orderkey") % 4001 != 17).withColumns({
        "o_orderstatus": F.when(F.col("o_orderkey") % 3001 != 5, F.col("o_orderstatus")),
        "o_totalprice": F.when(F.col("o_orderkey") % 2003 == 9, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).cast("decimal(12,2)"),
        "o_orderkey": F.when(F.col("o_orderkey") == 1, -1).otherwise(F.col("o_orderkey")),
    })
    return compare.tree_diff(orders, altered, ["o_orderkey"])


TREE_DIFF_SQL = """
WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice::DECIMAL(12, 2) AS o_totalprice FROM orders),
b AS (
  SELECT CASE WHEN o_orderkey = 1 THEN -1 ELSE o_orderkey END AS o_orderkey, o_custkey, CASE WHEN o_orderkey % 3001 <> 5 THEN o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 2003 = 9 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM a WHERE o_orderkey % 4001 <> 17),
p AS (
  SELECT o_orderkey, unnest(['o_custkey', 'o_orderstatus', 'o_totalprice']) AS "column", unnest([a.o_custkey::VARCHAR, a.o_orderstatus, a.o_totalprice::VARCHAR]) AS "left",
    unnest([b.o_custkey::VARCHAR, b.o_orderstatus, b.o_totalprice::VARCHAR]) AS "right" FROM a FULL JOIN b USING (o_orderkey))
SELECT * FROM p WHERE "left" IS DISTINCT FROM "right"
UNION ALL SELECT o_orderkey, '(row)', 'present', NULL FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
UNION ALL SELECT o_orderkey, '(row)', NULL, 'present' FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)
"""


def chunk_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders cut into about 900 chunks of consecutive ids."""
    orders = keys.attach_row_ids(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])
    return keys.attach_chunks(orders.select("row_id")).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first"))


CHUNK_SQL = """
WITH s AS (SELECT greatest(ceil(count(*) / 900e0), 1) AS size FROM orders),
r AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders)
SELECT CAST(floor(row_id / size) + 1 AS BIGINT) AS chunk, count(*) AS n, min(row_id) AS first FROM r, s GROUP BY 1
"""


def preview(spark: SparkSession, sf: str) -> DataFrame:
    return columns.first_rows(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), ["c_acctbal", "c_custkey"])


PREVIEW_SQL = "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 5"

QUERIES = {
    "widen_seasons": (widen_seasons, WIDEN_SQL),
    "join_wide": (join_wide, JOIN_WIDE_SQL),
    "suffixed_season": (suffixed_season, SUFFIX_SQL),
    "constant_season": (constant_season, CONSTANT_SQL),
    "attach_row_ids": (attach_row_ids, ROW_IDS_SQL),
    "align_by_position": (align_by_position, ALIGN_SQL),
    "chunk_positions": (chunk_positions, CHUNK_SQL),
    "preview": (preview, PREVIEW_SQL),
    "frame_diff": (frame_diff, FRAME_DIFF_SQL),
    "tree_diff": (tree_diff, TREE_DIFF_SQL),
}
