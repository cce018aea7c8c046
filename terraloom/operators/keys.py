"""Row ids, key alignment and uniqueness checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from terraloom.operators.columns import quoted
from terraloom.operators.skew import skew_join
from terraloom.session import ensure_checkpoint_dir

TARGET_CALLS = 900  # fixed value: chunks one season job is cut into
_ROW_BITS = 33  # low bits of monotonically_increasing_id: position inside the partition


def attach_row_ids(df: DataFrame, order_by: Sequence[str | Column], out: str = "row_id") -> DataFrame:
    """Consecutive ids 0..n-1 in the given order, without pulling the rows into one task.

    Rows are range-partitioned and sorted, then written to the checkpoint folder
    so that positions cannot change if an executor is lost.  Only one row per
    partition (its size) is summed up in a single task.  A hash of the row
    follows the order columns, so a value shared by many rows still splits.
    """
    ensure_checkpoint_dir(df.sparkSession)
    order = [quoted(c) if isinstance(c, str) else c for c in order_by]
    order.append(F.xxhash64(*[quoted(c) for c in df.columns]))
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    )
    part = F.shiftright("_at", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return (
        placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
        .select(
            (F.col("_before") + F.col("_at").bitwiseAND(F.lit(2**_ROW_BITS - 1))).alias(out),
            *[quoted(c) for c in df.columns],
        )
    )


def spread_rows(df: DataFrame) -> DataFrame:
    """The same rows, stored evenly: for narrow rows of few or small files that each lead to much work in place."""
    ensure_checkpoint_dir(df.sparkSession)
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return df.repartition(tasks, *[quoted(c) for c in df.columns]).checkpoint()


def align_by_position(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str], out: str = "row_id") -> DataFrame:
    """Put two frames of equal length side by side by position; different lengths are an error."""
    n_left, n_right = left.count(), right.count()
    if n_left != n_right:
        raise ValueError(f"length mismatch: {n_left} rows against {n_right}")
    return attach_row_ids(left, left_order, out).join(attach_row_ids(right, right_order, out), out, "inner")


def attach_chunks(df: DataFrame, row_id: str = "row_id", calls: int = TARGET_CALLS, out: str = "chunk") -> DataFrame:
    """Number of the chunk a row falls in when consecutive ids are cut into about ``calls`` chunks (first is 1)."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    size = F.greatest(F.ceil(total / F.lit(float(calls))), F.lit(1))
    return df.withColumn(out, F.floor(quoted(row_id) / size) + 1)


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself, failing at run time if a key occurs twice."""
    rest = [c for c in df.columns if c not in keys]
    duplicated = F.raise_error(F.concat(F.lit("duplicate key: "), F.to_json(F.struct(*keys))))
    folded = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(quoted(c)).alias(c) for c in rest])
    return folded.select(*keys, *[
        F.when(F.col("_n") == 1, quoted(c)).otherwise(duplicated.cast(df.schema[c].dataType)).alias(c) for c in rest
    ])


def reindex_left(master: DataFrame, lookup: DataFrame, key: str, hot_rows: int | None = None) -> DataFrame:
    """Every master row with its lookup columns, NULL where the lookup has no such key.

    A row id is unique in the master; for a key that repeats there, ``hot_rows``
    turns on salting of the keys with more rows than that.
    """
    found = one_row_per_key(lookup, [key])
    if hot_rows is None:
        return master.join(found, key, "left")
    return skew_join(master, found, [key], "left", hot_rows=hot_rows)
