"""Gamma fit per group and the standardised rain index built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.functions.gamma import gamma_shape, standardized_index


def fit_reason(count: Column, low: Column, shape: Column) -> Column:
    """Why a fit is missing: NULL when there is one."""
    return (
        F.when(count == 0, F.lit("empty"))
        .when(low <= 0, F.lit("nonpositive"))
        .when(shape.isNull(), F.lit("constant"))
    )


def gamma_fit(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Shape and scale per group (location 0); no fit and a reason where none exists.

    The two averages combine on the map side, so the size of a group does not matter.
    """
    x = F.col(value)
    stats = df.groupBy(*keys).agg(
        F.count(x).alias("_n"), F.min(x).alias("_low"), F.avg(x).alias("_mean"),
        F.avg(F.when(x > 0, F.ln(x))).alias("_log"),
    )
    usable = (F.col("_n") > 0) & (F.col("_low") > 0)
    fitted = stats.withColumn(
        "shape", F.when(usable, gamma_shape(F.col("_mean"), F.col("_log")))
    )
    return fitted.select(
        *keys, "shape", (F.col("_mean") / F.nullif(F.col("shape"), F.lit(0.0))).alias("scale"),
        F.col("_n").alias("n"), fit_reason(F.col("_n"), F.col("_low"), F.col("shape")).alias("reason"),
    )


def spi_index(
    df: DataFrame, keys: Sequence[str], value: str, baseline: DataFrame | None = None, out: str = "spi3"
) -> DataFrame:
    """Score every value against the gamma fit of its group.

    The fit uses the same rows unless a ``baseline`` frame is given.
    """
    fit = gamma_fit(df if baseline is None else baseline, keys, value).select(*keys, "shape", "scale")
    return df.join(fit, list(keys), "left").withColumn(
        out, standardized_index(F.col(value).cast("double"), F.col("shape"), F.col("scale"))
    ).drop("shape", "scale")


def spi_mean(df: DataFrame, keys: Sequence[str], value: str, baseline: DataFrame | None = None) -> DataFrame:
    scored = spi_index(df, keys, value, baseline, "_spi")
    return scored.groupBy(*keys).agg(F.avg("_spi").alias("spi3_mean"))
