"""Season calendar and the joins that put observations into seasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.functions import dates
from terraloom.operators.skew import skew_join


def season_calendar(spark: SparkSession, years: Sequence[int], seasons: Sequence[str] = dates.SEASONS) -> DataFrame:
    """(season, year, start, end), one row per season and year."""
    rows = [(s, int(y)) for y in years for s in seasons]
    return spark.createDataFrame(rows, "season string, year int").select(
        "season", "year",
        dates.season_start(F.col("season"), F.col("year")).alias("start"),
        dates.season_end(F.col("season"), F.col("year")).alias("end"),
    )


def seasons_of(df: DataFrame, day: str) -> DataFrame:
    """Calendar rows for the seasons that occur in ``df`` (as many rows as season-years)."""
    d = F.to_date(F.col(day))
    return (
        df.select(dates.season_name(d).alias("season"), dates.season_year(d).alias("year"))
        .where(F.col("season").isNotNull()).distinct()
        .select(
            "season", "year",
            dates.season_start(F.col("season"), F.col("year")).alias("start"),
            dates.season_end(F.col("season"), F.col("year")).alias("end"),
        )
    )


def assign_season(df: DataFrame, ts: str, closed: str = "both") -> DataFrame:
    """Add ``season`` and ``year`` by closed form; rows outside every season are dropped.

    ``closed='left'`` leaves out the last day of a season, as a half-open date range does.
    """
    if closed not in ("both", "left"):
        raise ValueError("closed must be 'both' or 'left'")
    day = F.to_date(F.col(ts))
    keep = dates.season_name(day).isNotNull()
    if closed == "left":
        keep &= ~dates.is_last_season_day(day)
    return df.where(keep).withColumns(
        {"season": dates.season_name(day), "year": dates.season_year(day)}
    )


def season_range_join(
    df: DataFrame, calendar: DataFrame, ts: str, closed: str = "both", calendar_is_small: bool = False
) -> DataFrame:
    """Join rows to any calendar of date ranges (columns season, year, start, end).

    Every range is spread over the months it touches, so the join is an
    equi-join on the month with the exact dates rechecked, not a comparison of
    every row with every range.

    Months are few and crowded, so the join is salted.  A calendar made here has
    two rows per year and a date column spans at most 10,000 years: with
    ``calendar_is_small`` its months are broadcast and the rows stay where they are.
    """
    if closed not in ("both", "left"):
        raise ValueError("closed must be 'both' or 'left'")
    day = F.to_date(F.col(ts))
    months = calendar.withColumn(
        "_month", F.explode(F.sequence(F.trunc("start", "month"), F.trunc("end", "month"), F.expr("interval 1 month")))
    )
    keyed = df.withColumns({"_month": F.trunc(day, "month"), "_day": day})
    joined = (
        keyed.join(F.broadcast(months), "_month", "inner") if calendar_is_small
        else skew_join(keyed, months, ["_month"], "inner")
    )
    upper = F.col("_day") <= F.col("end") if closed == "both" else F.col("_day") < F.col("end")
    return joined.where((F.col("_day") >= F.col("start")) & upper).drop("_month", "_day")


def season_grid(locations: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every location with every season of the calendar.

    The calendar is one array (seasons x years, from a scalar subquery), so the
    locations are only exploded in place and never shuffled.
    """
    listed = calendar.agg(
        F.sort_array(F.collect_set(F.struct("year", "season", "start", "end"))).alias("c")
    ).select("c")
    return (
        locations.withColumn("_cal", listed.scalar()).withColumn("_c", F.explode("_cal"))
        .select(*locations.columns, "_c.season", "_c.year", "_c.start", "_c.end")
    )
