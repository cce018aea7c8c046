"""Null- and edge-aware numeric expressions (ANSI mode is on in Spark 4)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Digits, optional fraction and exponent, or infinity: what a dataframe CSV reader turns into a number.
NUMERIC_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"
INTEGER_TEXT = r"^\s*[+-]?\d{1,18}\s*$"
NUMERIC_PREFIX = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"


def log_with_edges(x: Column) -> Column:
    """Natural log with ln(0) = -inf and ln(negative) = NaN; NULL stays NULL."""
    return (
        F.when(x > 0, F.ln(x))
        .when(x == 0, F.lit(float("-inf")))
        .when(x < 0, F.lit(float("nan")))
    )


def is_numeric_text(text: Column) -> Column:
    return text.rlike(NUMERIC_TEXT)


def is_integer_text(text: Column) -> Column:
    return text.rlike(INTEGER_TEXT)


def to_number(text: Column) -> Column:
    """Strict text-to-double: '12d' and 'NaN' are not numbers."""
    return F.when(is_numeric_text(text), F.trim(text).try_cast("double"))


def parse_prefix_number(text: Column) -> Column:
    """Longest leading number of a text (``'12.5abc'`` -> 12.5), NULL if there is none."""
    return F.nullif(F.regexp_extract(text.cast("string"), NUMERIC_PREFIX, 1), F.lit("")).try_cast("double")


def population_cv(x: str | Column) -> Column:
    """Population standard deviation over mean; a zero mean gives NaN instead of an error."""
    mean = F.avg(x)
    return F.when(mean == 0, F.lit(float("nan"))).otherwise(F.stddev_pop(x) / mean)


def sum_or_zero(x: str | Column) -> Column:
    return F.coalesce(F.sum(x), F.lit(0.0))


def min_max_scale(x: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; a constant column scales to 0."""
    span = high - low
    return F.when(x.isNotNull(), F.when(span == 0, F.lit(0.0)).otherwise((x - low) / F.nullif(span, F.lit(0.0))))


def min_max_unscale(x: Column, low: Column, high: Column) -> Column:
    return x * (high - low) + low
