"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Doubles are compared after snapping to a decimal grid.  The tie point is moved
# off the middle: averages of cents do fall exactly on ...5, where two engines
# that add in a different order would snap to different sides.
SNAP = 0.50137


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def snap(value: Column, digits: int = 6) -> Column:
    """Snap a finite double to ``digits`` decimals."""
    unit = float(10**digits)
    return F.floor(value * F.lit(unit) + F.lit(SNAP)).cast("double") / F.lit(unit)


def sql_snap(value: str, digits: int = 6) -> str:
    unit = f"{10**digits}e0"
    return f"(CAST(floor(({value}) * {unit} + {SNAP}) AS DOUBLE) / {unit})"


def day_text(name: str) -> Column:
    """A date as yyyy-MM-dd, so that both engines show it alike."""
    return F.col(name).cast("string").alias(name)


def big(value: Column) -> Column:
    return value.cast("bigint")


# The season of a date, as SQL text used by the counterparts.
def sql_season(day: str) -> str:
    return (
        f"CASE WHEN month({day}) BETWEEN 6 AND 10 THEN 'Kharif' "
        f"WHEN month({day}) >= 11 OR month({day}) <= 4 THEN 'Rabi' END"
    )


def sql_season_year(day: str) -> str:
    return f"CAST(year({day}) - CASE WHEN month({day}) <= 4 THEN 1 ELSE 0 END AS INTEGER)"
