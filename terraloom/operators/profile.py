"""Target profiles: box summaries per category and binned scatter per number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from terraloom.functions.numeric import log_with_edges
from terraloom.operators.columns import quoted
from terraloom.operators.enrich import first_per_key
from terraloom.operators.quantiles import large_groups, quantiles_of_frequencies, value_frequencies
from terraloom.operators.skew import HOT_ROWS, skew_join

# Columns that are never profiled.
NOT_PROFILED = (
    "FarmerID", "State", "REGION", "SEX", "CITY", "Zipcode", "DISTRICT", "VILLAGE", "MARITAL_STATUS", "Location",
)
WHISKER = 1.5
# A point that can be drawn has a value and a finite target.
_DRAWN = "value IS NOT NULL AND y IS NOT NULL AND NOT isnan(value) AND NOT isnan(y) AND abs(y) < double('Infinity') AND abs(value) < double('Infinity')"


def profiled_columns(df: DataFrame, target: str, excluded: Sequence[str] = NOT_PROFILED) -> list[str]:
    return [c for c in df.columns if c != target and c not in excluded]


def log_target(df: DataFrame, target: str) -> DataFrame:
    return df.withColumn(target, log_with_edges(quoted(target)))


def _long(df: DataFrame, target: str, names: Sequence[str], kind: str, keep: Sequence[str] = ()) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(n).alias("col"), quoted(n).cast(kind).alias("value")) for n in names])
    return df.select(*keep, quoted(target).alias("y"), F.explode(cells).alias("c")).select(*keep, "c.col", "c.value", "y")


def box_summary(df: DataFrame, target: str, names: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Quartiles, whiskers and outlier count of the target per value of every named column.

    Whiskers are the outermost points within 1.5 interquartile ranges of the box.
    Target frequencies per value are shuffled once and serve both the quartiles
    and the whiskers; a value shared by a large part of the rows stays spread.
    """
    keys = ["col", "value"]
    freq = value_frequencies(_long(df, target, names, "string"), keys, "y")
    boxes = quantiles_of_frequencies(freq, keys, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * F.lit(WHISKER)
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    joined = skew_join(freq, boxes, keys, "inner", spread_by=F.col("_v"), hot=large_groups(freq, keys, hot_rows))
    return joined.groupBy(*keys).agg(
        F.sum("_n").alias("n"), F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col("_v"))).alias("low_whisker"), F.max(F.when(inside, F.col("_v"))).alias("high_whisker"),
        F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("outliers"),
    )


def bin_scatter(df: DataFrame, target: str, names: Sequence[str], bins: int = 10) -> DataFrame:
    """(col, x_bin, y_bin, n): counts on an equal-width grid, bins 1..``bins`` per axis.

    Points without a value or a finite target are not drawn.  The ranges come
    from one aggregate (one row per column) that is broadcast back.
    """
    long = _long(df, target, names, "double").where(_DRAWN)
    ranges = long.groupBy("col").agg(
        F.min("value").alias("_x0"), F.max("value").alias("_x1"), F.min("y").alias("_y0"), F.max("y").alias("_y1"))

    def bin_of(v: str, low: str, high: str):
        span = F.nullif(F.col(high) - F.col(low), F.lit(0.0))
        at = F.floor((F.col(v) - F.col(low)) * F.lit(float(bins)) / span) + 1
        return F.least(F.coalesce(at, F.lit(1)), F.lit(bins)).cast("int")

    return long.join(F.broadcast(ranges), "col").groupBy(
        "col", bin_of("value", "_x0", "_x1").alias("x_bin"), bin_of("y", "_y0", "_y1").alias("y_bin")
    ).agg(F.count(F.lit(1)).alias("n"))


def scatter_sample(df: DataFrame, target: str, names: Sequence[str], key: str, per_bin: int = 50, bins: int = 10) -> DataFrame:
    """(col, x_bin, key, x, y): at most ``per_bin`` points of each of ``bins`` equal-width bins of a column, to be drawn as they are.

    Points are taken by the least digest of column and key.  So a sample is the same however the rows lie, samples of parts can be put
    together and cut again, and each task keeps only so many; sparse ranges are drawn whole.
    """
    long = _long(df.withColumn("_key", quoted(key)), target, names, "double", ("_key",)).where(_DRAWN)
    ranges = long.groupBy("col").agg(F.min("value").alias("_x0"), F.max("value").alias("_x1"))
    span = F.nullif(F.col("_x1") - F.col("_x0"), F.lit(0.0))
    at = F.least(F.coalesce(F.floor((F.col("value") - F.col("_x0")) * F.lit(float(bins)) / span) + 1, F.lit(1)), F.lit(bins)).cast("int")
    placed = long.join(F.broadcast(ranges), "col").withColumn("x_bin", at)
    order = F.md5(F.concat_ws(":", F.col("col"), F.col("_key").cast("string")))
    taken = first_per_key(placed.withColumn("_order", order), ["col", "x_bin"], ["_order", "_key"], per_bin)
    return taken.select("col", "x_bin", F.col("_key").alias(key), F.col("value").alias("x"), "y")


def profile_target(
    df: DataFrame, target: str, excluded: Sequence[str] = NOT_PROFILED, bins: int = 10, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame | None, DataFrame | None]:
    """Box summaries of the text columns and binned scatters of the numeric ones, against the log of the target.

    All columns but the target and the excluded ones take part, each in the way its type asks for.
    """
    named, kinds = profiled_columns(df, target, excluded), dict(df.dtypes)
    texts, numbers = [c for c in named if kinds[c] == "string"], [c for c in named if kinds[c] != "string"]
    logged = log_target(df, target)
    return (box_summary(logged, target, texts, hot_rows) if texts else None, bin_scatter(logged, target, numbers, bins) if numbers else None)


def target_correlation(df: DataFrame, target: str, names: Sequence[str]) -> DataFrame:
    """(col, corr) of every numeric column with the target."""
    y = F.when(F.abs(quoted(target)) < float("inf"), quoted(target))
    found = df.agg(F.array(*[
        F.struct(F.lit(n).alias("col"), F.corr(quoted(n).cast("double"), y).alias("corr")) for n in names
    ]).alias("f"))
    return found.select(F.inline("f"))
