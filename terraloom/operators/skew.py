"""Equi-join that keeps one hot key from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

HOT_ROWS = 2_000_000
SALTS = 64
BLOCK_ROWS = 4096  # of one key and side in a block: a sorted join keeps so many rows of a key in plain memory
MOST_PARTS = 1024  # of one side of a key


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, marked for a broadcast.

    There are at most ``count(df) / hot_rows`` of them, so the table is safe to
    broadcast whatever the data size.  The count reads only the key columns and
    combines on the map side.
    """
    counted = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return F.broadcast(counted.where(F.col("_n") > hot_rows).select(*on, F.lit(True).alias("_hot")))


def any_hot(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> bool:
    """Run the count now: worth it where many joins on the same key follow."""
    counted = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return not counted.where(F.col("_n") > hot_rows).isEmpty()


def salt_rows(df: DataFrame, hot: DataFrame, on: Sequence[str], spread_by: Column, salts: int = SALTS) -> DataFrame:
    """Give rows of hot keys one of ``salts`` salts, all others salt 0.

    A key with a NULL matches nothing, so such rows are spread as well, whatever their number.
    """
    lost = reduce(or_, [F.col(c).isNull() for c in on])
    salt = F.when(F.col("_hot") | lost, F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")).otherwise(0)
    return df.join(hot, list(on), "left").withColumn("_salt", salt).drop("_hot")


def repeat_per_salt(df: DataFrame, hot: DataFrame, on: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Repeat rows of hot keys once per salt, so each salted partition finds them."""
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return df.join(hot, list(on), "left").withColumn("_salt", F.explode(every)).drop("_hot")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread_by: Column | None = None,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` to a ``right`` side that has few rows per key.

    Keys with more than ``hot_rows`` rows on the left get a salt: their left
    rows spread over ``salts`` shuffle partitions and their right rows are
    repeated once per salt.  ``spread_by`` should be unique per left row (a row
    id); all columns are hashed when it is not given.  ``hot`` may hand in the
    keys to salt where they are known already.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports inner and left joins")
    on = list(on)
    hot = hot_keys(left, on, hot_rows) if hot is None else F.broadcast(hot.select(*on, F.lit(True).alias("_hot")))
    spread = spread_by if spread_by is not None else F.struct(*left.columns)
    salted = salt_rows(left, hot, on, spread, salts)
    return salted.join(repeat_per_salt(right, hot, on, salts), [*on, "_salt"], how).drop("_salt")


def deal_blocks(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread_left: Column, spread_right: Column,
    block_rows: int = BLOCK_ROWS, parts: int = MOST_PARTS, keys: tuple[DataFrame, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the numbers of their blocks, for a join whose keys may have many rows on both sides; and the columns of a block.

    A salt spreads the left rows of a key only; its pairs grow with the rows of both sides.  Here a key with more than ``block_rows`` on
    a side is cut into parts there, at most ``parts`` of them, and each part meets each part of the other side in a block of its own: the
    pairs of a block are bounded, whatever the data size.  There are at most ``(rows of both) / block_rows`` such keys, so they are
    broadcast.  The ``spread`` columns should tell the rows of a side apart.  ``keys`` may hold a row's key alone, where that is cheaper
    to count.
    """
    on, rows = list(on), max(1, block_rows)

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*on).agg(F.least(F.ceil(F.count(F.lit(1)) / F.lit(rows)), F.lit(parts)).cast("int").alias(name))

    lefts, rights = keys or (left, right)
    both = counted(lefts, "_lefts").join(counted(rights, "_rights"), on)
    cut = F.broadcast(both.where((F.col("_lefts") > 1) | (F.col("_rights") > 1)))

    def dealt(df: DataFrame, spread: Column, own: str, other: str) -> DataFrame:
        """Rows with the number of their part under ``own``, once per part of the other side."""
        n = {c: F.coalesce(F.col(c), F.lit(1)) for c in (own, other)}
        named = df.withColumn("_spread", F.xxhash64(spread)).join(cut, on, "left")
        return named.withColumns({"_at_" + own: F.pmod("_spread", n[own]).cast("int"), "_at_" + other: F.explode(F.sequence(F.lit(0), n[other] - 1))}).drop(
            "_spread", own, other)

    return dealt(left, spread_left, "_lefts", "_rights"), dealt(right, spread_right, "_rights", "_lefts"), [*on, "_at__lefts", "_at__rights"]


def block_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread_left: Column, spread_right: Column,
    block_rows: int = BLOCK_ROWS, parts: int = MOST_PARTS,
) -> DataFrame:
    """Inner join whose keys may have many rows on both sides, block by block."""
    *sides, keys = deal_blocks(left, right, on, spread_left, spread_right, block_rows, parts)
    # A number of its own keeps the blocks apart: small rows would be put into few tasks, however many pairs they make.
    tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    sides = [df.repartition(tasks, *keys) for df in sides]
    return sides[0].join(sides[1].hint("merge"), keys).drop(*keys[len(on):])
