"""Seasonal statistics, rolling windows and the call-rate audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from terraloom.functions import dates, numeric
from terraloom.operators import quantiles
from terraloom.operators.seasons import assign_season

COMPOSITE_DAYS = 16.0  # fixed value: days one vegetation composite stands for


def season_stats(
    df: DataFrame, keys: Sequence[str], ts: str, value: str,
    closed: str = "left", auc_scale: float = COMPOSITE_DAYS, p: float = 0.9, hot_rows: int = quantiles.HOT_ROWS,
) -> DataFrame:
    """mean, max, min, stdDev, p90, slope, intercept and auc per key, season and year.

    Observations without a key or a value belong to no series and are left out.
    Series up to ``hot_rows`` observations are shuffled once and get their moments
    and their quantile in the same stage.  Longer ones get the moments from
    map-side partial sums and the quantile from ``quantiles``' distributed way.
    """
    group = [*keys, "season", "year"]
    obs = assign_season(df.select(*keys, ts, value).dropna(how="any", subset=[*keys, value]), ts, closed)
    obs = obs.select(*group, F.col(value).cast("double").alias("_v"), dates.epoch_days(obs, ts).alias("_x"))
    y, x = F.col("_v"), F.col("_x")
    moments = [
        F.avg(y).alias("mean"), F.max(y).alias("max"), F.min(y).alias("min"), F.stddev_pop(y).alias("stdDev"),
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        (F.sum(y) * F.lit(float(auc_scale))).alias("auc"),
    ]
    probs = {"p90": p}
    out = [*group, "mean", "max", "min", "stdDev", "p90", "slope", "intercept", "auc"]
    kept = [c for c in out if c != "p90"]

    hot = F.broadcast(quantiles.large_groups_of_rows(obs, group, hot_rows))
    short = quantiles.with_ranks(obs.join(hot, group, "left_anti"), group)
    short = quantiles.interpolated(short.groupBy(*group).agg(*moments, *quantiles.rank_picks(probs)), kept, probs)
    long = obs.join(hot, group, "left_semi")
    long = long.groupBy(*group).agg(*moments).join(
        quantiles.quantiles_of_large_groups(long.select(*group, "_v"), group, probs), group)
    return short.select(*out).unionByName(long.select(*out))


def season_totals(df: DataFrame, keys: Sequence[str], ts: str, degree: str, rain: str) -> DataFrame:
    """Growing degree days and rain variability per key, season and year."""
    return assign_season(df, ts).groupBy(*keys, "season", "year").agg(
        numeric.sum_or_zero(degree).alias("gdd"), numeric.population_cv(rain).alias("rain_cv")
    )


def rolling_sum(
    df: DataFrame, keys: Sequence[str], order: str, value: str, rows: int = 90, out: str = "roll"
) -> DataFrame:
    """Sum over the last ``rows`` rows of a series; incomplete windows are dropped.

    Meant for one row per day within a season (``daily_totals`` makes them), so
    a partition never holds more than the days of its season.
    """
    frame = W.partitionBy(*keys).orderBy(order).rowsBetween(-(rows - 1), 0)
    return (
        df.withColumn("_full", F.count(value).over(frame))
        .withColumn(out, F.sum(value).over(frame))
        .where(F.col("_full") == rows).drop("_full")
    )


def daily_totals(df: DataFrame, keys: Sequence[str], ts: str, sums: dict[str, str]) -> DataFrame:
    """One row per key and day: the map side already sums, so hot keys shrink before the shuffle."""
    return df.select(*keys, F.to_date(ts).alias("date"), *sums).groupBy(*keys, "date").agg(
        *[F.sum(c).alias(name) for c, name in sums.items()]
    )


def rate_audit(
    df: DataFrame, keys: Sequence[str], ts_micros: str, limit: int = 100, window_seconds: int = 60,
    slice_seconds: int | None = None,
) -> DataFrame:
    """Add ``calls`` (events of the key in the trailing window, itself included) and ``over_limit``.

    Time is cut into slices, as long as the window unless told otherwise, so that
    a hot key becomes many independent groups of one window's events each:
    an event counts in its own slice and, if its window reaches over the edge,
    in the next one.  Inside a slice an event is a +1 when it happens and a -1
    when it leaves the window, so one running sum replaces a sliding recount.
    """
    slice_seconds = window_seconds if slice_seconds is None else slice_seconds
    if slice_seconds < window_seconds:
        raise ValueError("a slice must be at least as long as the window")
    span, width = window_seconds * 1_000_000, slice_seconds * 1_000_000
    t = F.col(ts_micros)
    home = F.floor(t / F.lit(width)).cast("bigint")
    base = df.withColumn("_slice", home)
    edge = (F.col("_slice") + 1) * F.lit(width)
    # The payload travels only with the event itself, not with its markers.
    events = base.withColumns({"_t": t, "_delta": F.lit(1), "_event": F.lit(True)})
    markers = base.select(*keys, F.explode(F.filter(
        F.array(
            F.struct(F.col("_slice").alias("slice"), (t + span).alias("t"), F.lit(-1).alias("delta")),
            F.struct((F.col("_slice") + 1).alias("slice"), edge.alias("t"),
                     F.when(t + span > edge, 1).alias("delta")),
            F.struct((F.col("_slice") + 1).alias("slice"), (t + span).alias("t"),
                     F.when(t + span > edge, -1).alias("delta")),
        ),
        lambda m: m["delta"].isNotNull() & (m["t"] < (m["slice"] + 1) * F.lit(width)),
    )).alias("_m")).groupBy(*keys, "_m.slice", "_m.t", "_m.delta").agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, F.col("slice").alias("_slice"), F.col("t").alias("_t"),
        (F.col("delta") * F.col("_n")).alias("_delta"), F.lit(False).alias("_event"),
    )
    running = W.partitionBy(*keys, "_slice").orderBy("_t").rangeBetween(W.unboundedPreceding, W.currentRow)
    return (
        events.unionByName(markers, allowMissingColumns=True)
        .withColumn("calls", F.sum("_delta").over(running)).where("_event")
        .withColumn("over_limit", F.col("calls") > limit)
        .select(*df.columns, F.col("calls").cast("bigint").alias("calls"), "over_limit")
    )
