"""Cell-level differences of two frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.operators.columns import quoted
from terraloom.session import ensure_checkpoint_dir

LEVELS = 4  # of a digest tree below its root
FANOUT = 16  # children of a node; a tree has FANOUT ** LEVELS leaves


def frame_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """(keys, column, left, right) of every cell that differs; nulls equal nulls.

    Values are compared in their own type and shown as text.  Equal cells are
    dropped before the rows are unfolded, so only differences are multiplied.  A
    row that one side lacks adds a line ``(row)`` that says which side has it.
    Unless ``names`` are given, both sides must have the same columns.
    """
    keys = list(keys)
    if names is None and set(left.columns) != set(right.columns):
        raise ValueError(f"columns of one side only: {sorted(set(left.columns) ^ set(right.columns))}")
    names = list(names) if names is not None else [c for c in left.columns if c not in keys]
    a = left.select(*keys, F.struct(*[quoted(c) for c in names]).alias("_l"))
    b = right.select(*keys, F.struct(*[quoted(c) for c in names]).alias("_r"))
    def there(side: str):
        return F.when(F.col(side).isNotNull(), F.lit("present"))

    one_sided = F.struct(
        F.lit("(row)").alias("column"), there("_l").alias("left"), there("_r").alias("right"),
        (F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("same"))
    cells = F.filter(
        F.array(*[
            F.struct(
                F.lit(c).alias("column"), F.col("_l")[c].cast("string").alias("left"),
                F.col("_r")[c].cast("string").alias("right"),
                F.col("_l")[c].eqNullSafe(F.col("_r")[c]).alias("same"),
            ) for c in names
        ], one_sided),
        lambda cell: ~cell["same"],
    )
    return (
        a.join(b, keys, "full_outer").withColumn("_d", F.explode(cells))
        .select(*keys, "_d.column", "_d.left", "_d.right")
    )


def digest_tree(df: DataFrame, keys: Sequence[str], names: Sequence[str] | None = None, levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """(level, node, n, sum, mix): digests of ranges of hashed keys, leaves at ``levels`` and the root at 0.

    A leaf's digest adds up the hashes of its rows in two ways, so it does not depend on their order and combines before
    the shuffle; a parent's adds up its children's.  The table has a bounded number of rows; stored, it stands for the frame in later comparisons.
    """
    names = list(names) if names is not None else sorted(c for c in df.columns if c not in keys)
    cells = [quoted(c) for c in [*keys, *names]]
    missing = F.concat(*[c.isNull().cast("string") for c in cells])  # a hash passes over nulls
    hashed = df.select(
        _leaf(keys, levels, fanout).alias("node"), F.xxhash64(*cells, missing).alias("_a"), F.xxhash64(F.lit(1), *cells, missing).alias("_b"))

    def total(n: Column, a: Column, b: Column) -> list[Column]:
        return [F.sum(n).alias("n"), F.sum(a).cast("decimal(38,0)").alias("sum"), F.bit_xor(b).alias("mix")]

    level = hashed.groupBy("node").agg(*total(F.lit(1), F.col("_a").cast("decimal(20,0)"), F.col("_b")))
    out = level.withColumn("level", F.lit(levels))
    for depth in range(levels - 1, -1, -1):
        level = level.groupBy(F.floor(F.col("node") / fanout).alias("node")).agg(*total(F.col("n"), F.col("sum"), F.col("mix")))
        out = out.unionByName(level.withColumn("level", F.lit(depth)))
    return out.select("level", "node", "n", "sum", "mix")


def _leaf(keys: Sequence[str], levels: int, fanout: int) -> Column:
    return F.pmod(F.xxhash64(*[quoted(k) for k in keys]), F.lit(fanout**levels))


def differing_leaves(left: DataFrame, right: DataFrame, levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """Leaves whose digests differ, from the root down: only children of differing nodes are compared.  Every level is stored."""
    known = ["n", "sum", "mix"]
    nodes = None
    for depth in range(levels + 1):
        a, b = (t.where(F.col("level") == depth).select("node", F.struct(*known).alias(side)) for t, side in ((left, "_l"), (right, "_r")))
        if nodes is not None:
            parents = F.broadcast(nodes.withColumnRenamed("node", "_parent"))  # at most a tree's inner nodes
            a, b = (t.join(parents, F.floor(F.col("node") / fanout) == F.col("_parent"), "left_semi") for t in (a, b))
        nodes = a.join(b, "node", "full_outer").where(~F.col("_l").eqNullSafe(F.col("_r"))).select("node").checkpoint()
    return nodes


def tree_diff(
    left: DataFrame, right: DataFrame, keys: Sequence[str], names: Sequence[str] | None = None, levels: int = LEVELS, fanout: int = FANOUT,
    left_tree: DataFrame | None = None, right_tree: DataFrame | None = None,
) -> DataFrame:
    """``frame_diff`` of nearly equal frames: only rows in ranges of keys whose digests differ are shuffled and joined.

    Columns of different types in the two frames make all their ranges differ, and then everything is joined.  Rows that repeat a key
    belong to one range, and are compared as ``frame_diff`` does.  Stored trees may be handed in.
    """
    if names is None and set(left.columns) != set(right.columns):
        return frame_diff(left, right, keys)
    ensure_checkpoint_dir(left.sparkSession)
    trees = [digest_tree(df, keys, names, levels, fanout).checkpoint() if tree is None else tree for df, tree in ((left, left_tree), (right, right_tree))]
    nodes = F.broadcast(differing_leaves(*trees, levels, fanout).withColumnRenamed("node", "_node"))
    keyless = reduce(or_, [quoted(k).isNull() for k in keys])  # such rows have no partner anywhere
    parts = [
        df.where(~keyless).join(nodes, _leaf(keys, levels, fanout) == F.col("_node"), "left_semi").unionByName(df.where(keyless))
        for df in (left, right)]
    return frame_diff(*parts, keys, names)
