"""Connected components of an edge table, by contraction in stored rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.llm.common import stored


def _order(node: str, turn: int) -> Column:
    return F.struct(F.xxhash64(F.col(node), F.lit(turn)), F.col(node))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of the edges ``a``, ``b`` (bigint); one root per component.

    In each round every node points to its least neighbour in an order drawn anew, if that comes before itself; edges
    are then carried over to the nodes pointed at.  A fixed share of the nodes goes in each round, so long chains cost no
    more rounds than stars.  Rounds are stored, and joined tables are shuffled on both sides, so that skewed nodes can be split.
    No edges give no rows; loops and repeated edges change nothing.
    """
    edges = stored(_proper(edges), "edges")
    pointers, turn = [], 0
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        nearest = both.groupBy("a").agg(F.min(_order("b", turn)).alias("least"))
        pointer = nearest.select(
            F.col("a").alias("node"),
            F.when(F.col("least") < _order("a", turn), F.col(f"least.b")).otherwise(F.col("a")).alias("root"))
        pointer = stored(pointer, "pointers")
        pointers.append(pointer)
        for end in ("a", "b"):
            moved = pointer.select(F.col("node").alias(end), F.col("root").alias(f"to_{end}"))
            edges = edges.join(moved, end)
        edges = stored(_proper(edges.select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))), "edges")
        turn += 1
    if not pointers:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = pointers[0]
    for later in pointers[1:]:
        step = later.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = stored(found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
    return found


def _proper(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
