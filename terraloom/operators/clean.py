"""Cleaning of the master table and hash encoding of its categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from terraloom.functions.hashing import hash_bucket
from terraloom.operators import columns
from terraloom.operators.columns import quoted

# Names of the farmer master table.
TARGET = "Target_Variable/Total Income"
DROPPED = ("Location", "Address type", "Ownership", "FarmerID")
REQUIRED = ("Perc_of_house_with_6plus_room", "Total_Land_For_Agriculture")
LOANS = "No_of_Active_Loan_In_Bureau"
LOAN_AMOUNT = "Avg_Disbursement_Amount_Bureau"
KEPT_TEXT = ("VILLAGE", "DISTRICT", "State", "Zipcode")
CATEGORY_BUCKETS = 256


def dedup_keep_first(df: DataFrame, row_id: str, subset: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows (over ``subset``, or all columns but the id), each with its smallest id.

    Nulls compare equal.  Copies are folded on the map side, so a row repeated
    any number of times costs one shuffled row per task.
    """
    cols = list(subset) if subset is not None else [c for c in df.columns if c != row_id]
    return df.groupBy(*[quoted(c) for c in cols]).agg(F.min(quoted(row_id)).alias(row_id)).select(
        quoted(row_id), *[quoted(c) for c in cols]
    )


def drop_zero(df: DataFrame, target: str) -> DataFrame:
    """Remove rows whose target is 0; a missing target stays."""
    return df.where(~quoted(target).eqNullSafe(F.lit(0)))


def zero_where(df: DataFrame, condition: str, amount: str) -> DataFrame:
    """Set ``amount`` to 0 where ``condition`` is 0; a missing condition changes nothing."""
    kind = df.schema[amount].dataType
    return df.withColumn(
        amount, F.when(quoted(condition) == 0, F.lit(0).cast(kind)).otherwise(quoted(amount))
    )


def hash_encode(df: DataFrame, names: Sequence[str], n_buckets: int, prefix_bytes: int = 18) -> DataFrame:
    """Replace categories by their buckets; other columns come first, encoded ones last."""
    columns.require_columns(df, names)
    kept = [quoted(c) for c in df.columns if c not in names]
    return df.select(*kept, *[hash_bucket(quoted(c), n_buckets, prefix_bytes).alias(c) for c in names])


def encode_categories(
    df: DataFrame, keep: Sequence[str], n_buckets: int = CATEGORY_BUCKETS, prefix_bytes: int = 18,
    detect_on: DataFrame | None = None,
) -> DataFrame:
    """Numeric text columns become numbers, the other text columns become buckets.

    Whether a column is numeric takes a pass over its values before the result
    has a schema.  ``detect_on`` may name a cheaper frame with the same values,
    such as the rows before repeats are folded.
    """
    names = columns.text_columns(df, exclude=keep)
    if not names:
        return df
    # One row per text column comes back: the result schema depends on it.
    found = {r["column"]: r for r in columns.numeric_columns(df if detect_on is None else detect_on, names).collect()}
    numeric = {n for n in names if found[n]["numeric"]}
    parsed = df.select(*[
        columns.parse_numeric(c, found[c]["integral"]) if c in numeric else quoted(c) for c in df.columns
    ])
    return hash_encode(parsed, [n for n in names if n not in numeric], n_buckets, prefix_bytes)


def complete_rows(df: DataFrame, target: str, required: Sequence[str]) -> DataFrame:
    """Rows with a target that is not 0 (or missing) and with every required value."""
    return drop_zero(df, target).dropna(how="any", subset=[f"`{c}`" if "." in c else c for c in required])


def clean_master(df: DataFrame, row_id: str = "row_id", n_buckets: int = CATEGORY_BUCKETS) -> DataFrame:
    """The whole cleaning pass over the farmer table.

    Ids are given once and kept: a surviving row has the id of its first copy.
    Copies pass or fail the row filters together, so these run before the
    repeats are folded, and the numeric test needs no shuffle at all.
    """
    kept = complete_rows(df, TARGET, REQUIRED)
    rows = columns.drop_columns(dedup_keep_first(kept, row_id), DROPPED)
    return encode_categories(
        zero_where(rows, LOANS, LOAN_AMOUNT), keep=KEPT_TEXT, n_buckets=n_buckets, detect_on=kept)
