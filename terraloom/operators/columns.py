"""Column bookkeeping: strict drops, suffixes, type selection, numeric detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from terraloom.functions import numeric


def quoted(name: str) -> Column:
    """Column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; unlike ``DataFrame.drop`` a missing name is an error."""
    require_columns(df, names)
    return df.drop(*names)


def suffix_columns(df: DataFrame, suffix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.toDF(*[c if c in keep else f"{c}{suffix}" for c in df.columns])


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def numeric_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, numeric, integral) for text columns, from one aggregate pass.

    A column with a NULL is not numeric; a column without rows is.
    """
    def every(test: Column) -> Column:
        return F.coalesce(F.bool_and(F.coalesce(test, F.lit(False))), F.lit(True))

    found = df.agg(F.array(*[
        F.struct(
            F.lit(n).alias("column"), every(numeric.is_numeric_text(quoted(n))).alias("numeric"),
            every(numeric.is_integer_text(quoted(n))).alias("integral"),
        ) for n in names
    ]).alias("found"))
    return found.select(F.inline("found"))


def parse_numeric(name: str, integral: bool) -> Column:
    text = F.trim(quoted(name))
    return (text.try_cast("bigint") if integral else numeric.to_number(quoted(name))).alias(name)


def first_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """Preview of the first rows in a stated order (every task keeps only ``n``)."""
    return df.orderBy(*[quoted(c) for c in order_by]).limit(n)


def constant_value(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row with the value each column holds throughout; more than one value is an error."""
    def only(n: str) -> Column:
        low, high = F.min(quoted(n)), F.max(quoted(n))
        varied = F.raise_error(F.lit(f"column {n} is not constant")).cast(df.schema[n].dataType)
        return F.when(low.eqNullSafe(high), low).otherwise(varied).alias(n)

    return df.agg(*[only(n) for n in names])
