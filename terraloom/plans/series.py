"""Seasonal statistics, rolling windows, drought index and weather documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.functions import dates
from terraloom.operators import seasons, spi, timeseries, weather
from terraloom.plans.common import big, day_text, snap, sql_season, sql_season_year, sql_snap, table


def season_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = timeseries.season_stats(table(spark, sf, "lineitem"), ["l_suppkey"], "l_shipdate", "l_quantity")
    return stats.select(
        "l_suppkey", "season", "year",
        *[snap(F.col(c), 6).alias(c) for c in ("mean", "max", "min", "stdDev", "p90", "slope", "auc")],
        snap(F.col("intercept"), 4).alias("intercept"),
    )


SEASON_STATS_SQL = f"""
WITH o AS (
  SELECT l_suppkey, {sql_season('l_shipdate')} AS season, {sql_season_year('l_shipdate')} AS year,
         l_quantity AS y, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS x
  FROM lineitem
  WHERE strftime(l_shipdate, '%m-%d') NOT IN ('10-31', '04-30')
), g AS (
  SELECT l_suppkey, season, year, avg(y) AS mean, max(y) AS max, min(y) AS min, stddev_pop(y) AS sd,
         quantile_cont(y, 0.9) AS p90, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept,
         sum(y) * 16 AS auc
  FROM o WHERE season IS NOT NULL GROUP BY ALL
)
SELECT l_suppkey, season, year, {sql_snap('mean')} AS mean, {sql_snap('max')} AS max, {sql_snap('min')} AS min,
       {sql_snap('sd')} AS "stdDev", {sql_snap('p90')} AS p90,
       {sql_snap('CASE WHEN isnan(slope) THEN NULL ELSE slope END')} AS slope,
       {sql_snap('auc')} AS auc,
       {sql_snap('CASE WHEN isnan(intercept) THEN NULL ELSE intercept END', 4)} AS intercept
FROM g
"""


def season_range_join(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderdate", "o_totalprice", "o_orderpriority")
    calendar = seasons.seasons_of(orders, "o_orderdate")
    joined = seasons.season_range_join(orders, calendar, "o_orderdate", closed="both", calendar_is_small=True)
    return joined.groupBy("season", "year", day_text("start"), day_text("end")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderdate") < F.col("end")).alias("n_half_open"),
        snap(F.sum("o_totalprice"), 2).alias("total"),
    )


SEASON_RANGE_SQL = f"""
WITH c AS (
  SELECT 'Kharif' AS season, y AS year, make_date(y, 6, 1) AS "start", make_date(y, 10, 31) AS "end"
  FROM (SELECT CAST(unnest(range(1990, 2030)) AS INTEGER) AS y)
  UNION ALL
  SELECT 'Rabi', y, make_date(y, 11, 1), make_date(y + 1, 4, 30)
  FROM (SELECT CAST(unnest(range(1990, 2030)) AS INTEGER) AS y)
)
SELECT season, year, CAST("start" AS VARCHAR) AS "start", CAST("end" AS VARCHAR) AS "end", count(*) AS n,
       count(*) FILTER (WHERE CAST(o_orderdate AS DATE) < "end") AS n_half_open,
       {sql_snap('sum(o_totalprice)', 2)} AS total
FROM orders JOIN c ON CAST(o_orderdate AS DATE) BETWEEN "start" AND "end"
GROUP BY season, year, c."start", c."end"
"""


def season_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers x seasons seen in the shipments, with the shipped quantity where there is one."""
    lineitem = table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity")
    grid = seasons.season_grid(
        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey")),
        seasons.seasons_of(lineitem, "l_shipdate"),
    )
    shipped = seasons.assign_season(lineitem, "l_shipdate").groupBy("l_suppkey", "season", "year").agg(F.sum("l_quantity").alias("quantity"))
    return weather.assign_to_grid(grid, shipped, ["l_suppkey", "season", "year"]).select(
        "l_suppkey", "season", "year", day_text("start"), day_text("end"), "quantity"
    )


SEASON_GRID_SQL = f"""
WITH o AS (
  SELECT l_suppkey, l_quantity, {sql_season('l_shipdate')} AS season, {sql_season_year('l_shipdate')} AS year
  FROM lineitem
), c AS (SELECT DISTINCT season, year FROM o WHERE season IS NOT NULL)
SELECT s.s_suppkey AS l_suppkey, c.season, c.year,
       CASE WHEN c.season = 'Kharif' THEN c.year || '-06-01' ELSE c.year || '-11-01' END AS "start",
       CASE WHEN c.season = 'Kharif' THEN c.year || '-10-31' ELSE (c.year + 1) || '-04-30' END AS "end",
       q.quantity
FROM supplier s CROSS JOIN c
LEFT JOIN (SELECT l_suppkey, season, year, sum(l_quantity) AS quantity FROM o
           WHERE season IS NOT NULL GROUP BY ALL) q
  ON q.l_suppkey = s.s_suppkey AND q.season = c.season AND q.year = c.year
"""


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    """Order totals per priority and day stand in for a location's daily series."""
    return timeseries.daily_totals(
        table(spark, sf, "orders"), ["o_orderpriority"], "o_orderdate", {"o_totalprice": "total"}
    )


_DAILY_SQL = """
daily AS (
  SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS total, count(*) AS n
  FROM orders GROUP BY ALL
)"""
_SEASON_DAILY_SQL = f"""{_DAILY_SQL}, sd AS (
  SELECT *, {sql_season('date')} AS season, {sql_season_year('date')} AS year FROM daily
  WHERE month(date) <> 5
)"""
_ROLL_SQL = f"""{_SEASON_DAILY_SQL}, rolled AS (
  SELECT o_orderpriority, season, year, date, roll FROM (
    SELECT *, sum(total) OVER w AS roll, count(total) OVER w AS k FROM sd
    WINDOW w AS (PARTITION BY o_orderpriority, season, year ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW)
  ) WHERE k = 90
)"""


def gdd_rain_cv(spark: SparkSession, sf: str) -> DataFrame:
    daily = _daily(spark, sf)
    totals = timeseries.season_totals(
        daily.withColumn("cdd", F.col("total") / 1000.0), ["o_orderpriority"], "date", "cdd", "total"
    )
    return totals.select(
        "o_orderpriority", "season", "year", snap(F.col("gdd"), 4).alias("gdd"), snap(F.col("rain_cv")).alias("rain_cv")
    )


GDD_SQL = f"""
WITH {_SEASON_DAILY_SQL}
SELECT o_orderpriority, season, year, {sql_snap('sum(total / 1000.0)', 4)} AS gdd,
       {sql_snap('stddev_pop(total) / avg(total)')} AS rain_cv
FROM sd GROUP BY o_orderpriority, season, year
"""


def _rolled(spark: SparkSession, sf: str) -> DataFrame:
    daily = seasons.assign_season(_daily(spark, sf), "date")
    return timeseries.rolling_sum(daily, ["o_orderpriority", "season", "year"], "date", "total")


def rolling_90(spark: SparkSession, sf: str) -> DataFrame:
    return _rolled(spark, sf).select(
        "o_orderpriority", "season", "year", day_text("date"), snap(F.col("roll"), 2).alias("roll")
    )


ROLLING_SQL = f"""
WITH {_ROLL_SQL}
SELECT o_orderpriority, season, year, CAST(date AS VARCHAR) AS date, {sql_snap('roll', 2)} AS roll FROM rolled
"""


def gamma_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Relative precision: the shape is checked to eight digits, the scale through shape * scale."""
    fit = spi.gamma_fit(_rolled(spark, sf), ["o_orderpriority", "season", "year"], "roll")
    return fit.select(
        "o_orderpriority", "season", "year", big(F.col("n")).alias("n"),
        snap(F.ln("shape"), 6).alias("ln_shape"), snap(F.ln("scale"), 6).alias("ln_scale"), "reason",
    )


# Newton steps on ln(a) - digamma(a) = s with a recurrence lifted by 30 instead of the engine's 8.
GAMMA_ROOT_SQL = """
stats AS (
  SELECT o_orderpriority, season, year, count(roll) AS n, avg(roll) AS m, ln(avg(roll)) - avg(ln(roll)) AS s
  FROM rolled GROUP BY ALL
), start_at AS (
  SELECT *, (3 - s + sqrt((s - 3) * (s - 3) + 24 * s)) / (12 * s) AS a0 FROM stats WHERE s > 1e-14
), root AS (
  SELECT o_orderpriority, season, year, n, m,
         list_reduce(list_concat([a0], CAST(range(1, 9) AS DOUBLE[])), lambda a, k:
           a - (ln(a) - (ln(a + 30) - 0.5 / (a + 30) - 1 / (12 * (a + 30) ** 2) + 1 / (120 * (a + 30) ** 4) - 1 / (252 * (a + 30) ** 6)
                 - list_sum(list_transform(range(0, 30), lambda i: 1 / (a + i)))) - s)
           / (1 / a - (1 / (a + 30) + 0.5 / (a + 30) ** 2 + 1 / (6 * (a + 30) ** 3) - 1 / (30 * (a + 30) ** 5) + 1 / (42 * (a + 30) ** 7)
                 + list_sum(list_transform(range(0, 30), lambda i: 1 / ((a + i) * (a + i))))))) AS shape
  FROM start_at
)"""
GAMMA_SQL = f"""
WITH {_ROLL_SQL}, {GAMMA_ROOT_SQL}
SELECT o_orderpriority, season, year, n, {sql_snap('ln(shape)')} AS ln_shape, {sql_snap('ln(m / shape)')} AS ln_scale,
       CAST(NULL AS VARCHAR) AS reason
FROM root
"""


def spi_index(spark: SparkSession, sf: str) -> DataFrame:
    scored = spi.spi_index(_rolled(spark, sf), ["o_orderpriority", "season", "year"], "roll")
    return scored.select("o_orderpriority", "season", "year", day_text("date"), snap(F.col("spi3"), 6).alias("spi3"))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """One document per priority and season-year holding two date -> value maps, built from the orders."""
    daily = timeseries.daily_totals(
        table(spark, sf, "orders").withColumn("one", F.lit(1.0)),
        ["o_orderpriority"], "o_orderdate", {"o_totalprice": "rain", "one": "degree"},
    )
    day = F.date_format("date", "yyyyMMdd")
    seasonal = seasons.assign_season(daily, "date")
    return seasonal.groupBy("o_orderpriority", "season", "year").agg(
        F.map_from_entries(F.collect_list(F.struct(day, F.col("rain")))).alias("prectotcorr"),
        F.map_from_entries(F.collect_list(F.struct(day, F.col("degree")))).alias("cdd10"),
    )


def map_explode_zip(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    days = weather.zip_parameters(docs, ["o_orderpriority", "season", "year"])
    return days.select(
        "o_orderpriority", "season", "year", day_text("date"),
        snap(F.col("prectotcorr"), 2).alias("prectotcorr"), "cdd10",
    )


MAP_ZIP_SQL = f"""
WITH {_SEASON_DAILY_SQL}
SELECT o_orderpriority, season, year, CAST(date AS VARCHAR) AS date, {sql_snap('total', 2)} AS prectotcorr, CAST(n AS DOUBLE) AS cdd10 FROM sd
"""


def weather_features(spark: SparkSession, sf: str) -> DataFrame:
    """Documents to features; the index mean is near zero by construction, so it is checked to 7 digits."""
    days = weather.zip_parameters(_documents(spark, sf), ["o_orderpriority"])
    features = weather.weather_features(days, ["o_orderpriority"])
    return features.select(
        "o_orderpriority", "season", "year", snap(F.col("gdd"), 4).alias("gdd"),
        snap(F.col("rain_cv")).alias("rain_cv"), snap(F.col("spi3_mean"), 7).alias("spi3_mean"), "spi3_reason",
    )


# P(a, x) as exp(a ln x - x - lgamma(a+1)) times the sum of x^i / ((a+1)...(a+i)); the quantile by bisection on
# the normal distribution function, itself the series phi(z) * sum z^(2k+1) / (1*3*...*(2k+1)).
SPI_SCORE_SQL = """
scored AS (
  SELECT r.o_orderpriority, r.season, r.year, r.date,
         exp(f.shape * ln(r.roll / (f.m / f.shape)) - r.roll / (f.m / f.shape) - lgamma(f.shape + 1)) * (
           list_reduce(list_concat([{'t': 1e0, 's': 1e0}], list_transform(range(1, CAST(300 + 14 * sqrt(f.shape) + greatest(0, r.roll / (f.m / f.shape) - f.shape) AS BIGINT)), lambda i: {'t': CAST(i AS DOUBLE), 's': 0e0})),
             lambda acc, i: {'t': acc.t * (r.roll / (f.m / f.shape)) / (f.shape + i.t),
                             's': acc.s + acc.t * (r.roll / (f.m / f.shape)) / (f.shape + i.t)})).s AS p
  FROM rolled r JOIN root f USING (o_orderpriority, season, year)
), quantile AS (
  SELECT *, (list_reduce(list_concat([{'lo': -9e0, 'hi': 9e0}], list_transform(range(0, 50), lambda i: {'lo': 0e0, 'hi': 0e0})),
    lambda b, i: CASE WHEN
      0.5 + exp(0 - ((b.lo + b.hi) / 2) ** 2 / 2) / sqrt(2 * pi()) * (
        list_reduce(list_concat([{'t': (b.lo + b.hi) / 2, 's': (b.lo + b.hi) / 2}], list_transform(range(1, 120), lambda k: {'t': CAST(k AS DOUBLE), 's': 0e0})),
          lambda acc, k: {'t': acc.t * ((b.lo + b.hi) / 2) ** 2 / (2 * k.t + 1),
                          's': acc.s + acc.t * ((b.lo + b.hi) / 2) ** 2 / (2 * k.t + 1)})).s < p
      THEN {'lo': (b.lo + b.hi) / 2, 'hi': b.hi} ELSE {'lo': b.lo, 'hi': (b.lo + b.hi) / 2} END)).lo AS spi3
  FROM scored
)"""
SPI_SQL = f"""
WITH {_ROLL_SQL}, {GAMMA_ROOT_SQL}, {SPI_SCORE_SQL}
SELECT o_orderpriority, season, year, CAST(date AS VARCHAR) AS date, {sql_snap('spi3', 6)} AS spi3 FROM quantile
"""
WEATHER_SQL = f"""
WITH {_ROLL_SQL}, {GAMMA_ROOT_SQL}, {SPI_SCORE_SQL}, means AS (
  SELECT o_orderpriority, season, year, avg(spi3) AS spi3_mean FROM quantile GROUP BY ALL
)
SELECT sd.o_orderpriority, sd.season, sd.year, {sql_snap('sum(n)', 4)} AS gdd,
       {sql_snap('stddev_pop(total) / avg(total)')} AS rain_cv, {sql_snap('max(spi3_mean)', 7)} AS spi3_mean,
       CASE WHEN count(*) < 90 THEN 'short' END AS spi3_reason
FROM sd LEFT JOIN means m ON m.o_orderpriority = sd.o_orderpriority AND m.season = sd.season AND m.year = sd.year
GROUP BY sd.o_orderpriority, sd.season, sd.year
"""


def rate_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Calls per event type in the trailing ten minutes, against a limit of 3."""
    events = table(spark, sf, "events")
    events = events.select("event_id", "event_type", dates.epoch_micros(events, "ts").alias("us"))
    return timeseries.rate_audit(events, ["event_type"], "us", limit=3, window_seconds=600).select(
        "event_id", "event_type", "calls", "over_limit"
    )


RATE_SQL = """
SELECT event_id, event_type, c AS calls, c > 3 AS over_limit FROM (
  SELECT event_id, event_type, count(*) OVER (
    PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 599999999 PRECEDING AND CURRENT ROW) AS c
  FROM events)
"""


def time_column(spark: SparkSession, sf: str) -> DataFrame:
    """Fractional days of every event and the compact and parsed forms of its date."""
    events = table(spark, sf, "events")
    compact = dates.compact_date(F.date_format("ts", "yyyy-MM-dd"))
    return events.select(
        "event_id", snap(dates.epoch_days(events, "ts"), 6).alias("days"),
        compact.alias("compact"), dates.parse_compact_date(compact).cast("string").alias("day"),
    )


TIME_SQL = f"""
SELECT event_id, {sql_snap("epoch_us(ts) / 86400e6")} AS days, strftime(ts, '%Y%m%d') AS compact, CAST(CAST(ts AS DATE) AS VARCHAR) AS day
FROM events
"""

QUERIES = {
    "season_stats": (season_stats, SEASON_STATS_SQL),
    "season_range_join": (season_range_join, SEASON_RANGE_SQL),
    "season_grid": (season_grid, SEASON_GRID_SQL),
    "gdd_rain_cv": (gdd_rain_cv, GDD_SQL),
    "rolling_90": (rolling_90, ROLLING_SQL),
    "gamma_fit": (gamma_fit, GAMMA_SQL),
    "spi_index": (spi_index, SPI_SQL),
    "map_explode_zip": (map_explode_zip, MAP_ZIP_SQL),
    "weather_features": (weather_features, WEATHER_SQL),
    "rate_audit": (rate_audit, RATE_SQL),
    "time_column": (time_column, TIME_SQL),
}
