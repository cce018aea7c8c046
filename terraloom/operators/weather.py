"""Daily weather documents to seasonal features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from terraloom.functions import dates, numeric
from terraloom.functions.gamma import gamma_shape, mean_standardized_index
from terraloom.operators.seasons import assign_season

ROLL_DAYS = 90


def key_sets_equal(a: str, b: str):
    """Column: both maps have the same keys."""
    return (F.size(F.array_except(F.map_keys(a), F.map_keys(b))) == 0) & (
        F.size(F.array_except(F.map_keys(b), F.map_keys(a))) == 0
    )


def zip_parameters(
    docs: DataFrame, keys: Sequence[str], rain: str = "prectotcorr", degree: str = "cdd10",
    strict: bool = True, fill_value: float | None = None,
) -> DataFrame:
    """Two maps of compact date -> value become one row per date.

    The maps must have equal key sets: strict mode raises, otherwise the
    documents with a mismatch are left out (``mismatched_documents`` lists them).
    ``fill_value`` turns the service's missing-value marker into NULL.
    """
    same = key_sets_equal(rain, degree)
    checked = docs.where(same) if not strict else docs.withColumn(
        rain, F.when(same, F.col(rain)).otherwise(
            F.raise_error(F.lit(f"dates of {rain} and {degree} do not match")).cast(docs.schema[rain].dataType)
        ),
    )
    zipped = F.map_zip_with(rain, degree, lambda _, r, d: F.struct(r.alias("r"), d.alias("d")))
    days = checked.select(*keys, F.explode(zipped).alias("_day", "_v")).select(
        *keys, dates.parse_compact_date(F.col("_day")).alias("date"),
        F.col("_v.r").alias(rain), F.col("_v.d").alias(degree),
    )
    if fill_value is not None:
        marker = F.lit(float(fill_value))
        days = days.withColumns({c: F.nullif(F.col(c), marker) for c in (rain, degree)})
    return days


def mismatched_documents(docs: DataFrame, rain: str = "prectotcorr", degree: str = "cdd10") -> DataFrame:
    """Documents whose two maps have different dates; a missing map differs from any."""
    return docs.where(~F.coalesce(key_sets_equal(rain, degree), F.lit(False)))


def weather_features(
    days: DataFrame, keys: Sequence[str], date: str = "date", rain: str = "prectotcorr", degree: str = "cdd10",
    rows: int = ROLL_DAYS,
) -> DataFrame:
    """gdd, rain_cv and spi3_mean per location, season and year.

    Rows are first brought to one per location and day (two that disagree are an
    error), which bounds each season group by its calendar (at most 182 days, so at most 93 windows in the
    collected array).  The window, the fit and the scoring then share one
    partitioning by location, season and year.
    """
    group = [*keys, "season", "year"]

    def agreed(value: str):
        differ = F.raise_error(F.concat(F.lit(f"different values of {value} on "), F.col(date).cast("string"))).cast("double")
        return F.when(F.min(value) != F.max(value), differ).otherwise(F.max(value)).alias(value)

    daily = assign_season(days.groupBy(*keys, date).agg(agreed(rain), agreed(degree)), date)
    frame = W.partitionBy(*group).orderBy(date).rowsBetween(-(rows - 1), 0)
    rolled = daily.withColumn(
        "_roll", F.when(F.count(rain).over(frame) == rows, F.sum(rain).over(frame))
    )
    roll = F.col("_roll")
    stats = rolled.groupBy(*group).agg(
        numeric.sum_or_zero(degree).alias("gdd"),
        numeric.population_cv(rain).alias("rain_cv"),
        F.min(roll).alias("_low"), F.avg(roll).alias("_mean"), F.avg(F.when(roll > 0, F.ln(roll))).alias("_log"),
        F.collect_list(roll).alias("_rolls"),
    )
    fitted = stats.withColumn(
        "_shape", F.when(F.col("_low") > 0, gamma_shape(F.col("_mean"), F.col("_log")))
    ).withColumn("_scale", F.col("_mean") / F.nullif(F.col("_shape"), F.lit(0.0)))
    reason = (
        F.when(F.col("_low").isNull(), F.lit("short")).when(F.col("_low") <= 0, F.lit("nonpositive"))
        .when(F.col("_shape").isNull(), F.lit("constant"))
    )
    return fitted.select(
        *group, "gdd", "rain_cv",
        mean_standardized_index(F.col("_rolls"), F.col("_shape"), F.col("_scale")).alias("spi3_mean"),
        reason.alias("spi3_reason"),
    )


def assign_to_grid(grid: DataFrame, features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every grid row keeps its place; features that were never computed stay NULL."""
    return grid.join(features, list(keys), "left")
