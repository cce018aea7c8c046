"""Feature rows as (column, slot, value) triples, for categories of any width.

A row holds one triple per column: a number has the only slot of its block, a category the slot of its value.  Slots that are not there
are zeros, and noise is a function of where it falls, so neither is ever written out; no vocabulary is gathered in one place.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.functions import numeric
from terraloom.operators.columns import quoted
from terraloom.operators.diffuse import SMOOTHING, with_steps
from terraloom.operators.skew import skew_join

HOT_ROWS = 1_000_000
PLACE = ("col", "idx")
Noise = Callable[[Column, Column, Column, Column], Column]  # of key, step, col and idx


def encode(
    df: DataFrame, key: str, nums: Sequence[str], cats: Sequence[str], scaler: DataFrame, vocabulary: DataFrame, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(key, col, idx, value): scaled numbers at slot 0, ones at the slots of categories.

    The scaler has one row per column; the vocabulary is joined, however long, with frequent values salted.  A value outside the
    vocabulary is an error; NULL has no triple.
    """
    numbers = df.select(quoted(key).alias(key), F.explode(F.array(*[
        F.struct(F.lit(n).alias("col"), quoted(n).cast("double").alias("_x")) for n in nums])).alias("_e")).select(key, "_e.*") if nums else None
    values = df.select(quoted(key).alias(key), F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), quoted(c).cast("string").alias("_v")) for c in cats])).alias("_e")).select(key, "_e.*") if cats else None
    parts = []
    if numbers is not None:
        scaled = numbers.where("_x IS NOT NULL").join(F.broadcast(scaler), "col")
        parts.append(scaled.select(key, "col", F.lit(0).alias("idx"), numeric.min_max_scale(F.col("_x"), F.col("min"), F.col("max")).alias("value")))
    if values is not None:
        known = vocabulary.select("col", F.col("value").alias("_v"), "idx")
        met = skew_join(values.where("_v IS NOT NULL"), known, ["col", "_v"], "left", F.col(key), hot_rows)
        unseen = F.raise_error(F.concat(F.lit("unseen category: "), F.col("_v"))).cast("int")
        parts.append(met.select(key, "col", F.when(F.col("idx").isNull(), unseen).otherwise(F.col("idx")).alias("idx"), F.lit(1.0).alias("value")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def hashed_noise(seed: int = 0) -> Noise:
    """Standard-normal noise that depends on key, step and slot alone, so it is the same wherever and however often it is asked for."""
    def at(key: Column, step: Column, col: Column, idx: Column) -> Column:
        def uniform(which: int) -> Column:
            return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, step, col, idx, F.lit(which)), 11) + F.lit(0.5)) / F.lit(float(2**53))
        return F.sqrt(F.lit(-2.0) * F.ln(uniform(0))) * F.cos(F.lit(2 * math.pi) * uniform(1))
    return at


def _noise(noise: Noise, key: str) -> Column:
    return noise(F.col(key), F.col("step"), F.col("col"), F.col("idx"))


def add_noise(rows: DataFrame, key: str, num_steps: int, noise: Noise | None = None, s: float = SMOOTHING) -> DataFrame:
    """Every triple once per step with ``noisy``; slots without a triple are noise alone and stay unwritten."""
    stepped = with_steps(rows, num_steps, s)
    return stepped.withColumn("noisy", F.col("signal") * F.col("value") + F.col("spread") * _noise(noise or hashed_noise(), key))


def recover(noisy: DataFrame, key: str, noise: Noise | None = None) -> DataFrame:
    """Triples with the value that the noise was added to; NULL where nothing of it is left."""
    clean = (F.col("noisy") - F.col("spread") * _noise(noise or hashed_noise(), key)) / F.col("signal")
    return noisy.withColumn("recovered", F.when(F.col("signal") != 0, clean))


def best_slots(rows: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """(keys, col, idx) with the largest value of each block, the first slot on ties; each task keeps one row per block.

    The first slot of each value comes first, so the largest has no ties: both folds are of plain numbers, which are kept in a hash table.
    The largest pair would have every row sorted.
    """
    first = rows.groupBy(*keys, "col", F.col(value).alias("_v")).agg(F.min("idx").alias("_i"))
    slot = F.when(F.max("_v").isNull(), F.min("_i")).otherwise(F.max_by("_i", "_v"))
    return first.groupBy(*keys, "col").agg(slot.alias("idx"), F.max("_v").alias("value"))


def noisy_best(noisy: DataFrame, key: str, widths: DataFrame, noise: Noise | None = None) -> DataFrame:
    """``best_slots`` of noisy blocks, all of whose slots take part.

    A slot without a triple is noise alone; it is made where it is compared and its row keeps the best one only.  This looks at every
    slot of a block, so it is for categories of a moderate width; ``widths`` holds (col, width), a row per column.
    """
    blocks = noisy.select(key, "step", "signal", "spread", "col", F.col("idx").alias("_at"), F.col("value").alias("_x")).join(F.broadcast(widths), "col")

    def better(best: Column, idx: Column) -> Column:
        there = F.when(idx == F.col("_at"), F.col("signal") * F.col("_x")).otherwise(0.0)
        drawn = (noise or hashed_noise())(F.col(key), F.col("step"), F.col("col"), idx)
        slot = F.struct((there + F.col("spread") * drawn).alias("value"), idx.alias("idx"))
        above = F.coalesce(slot["value"] > best["value"], best["value"].isNull() & slot["value"].isNotNull())
        return F.when(best["idx"].isNull() | above, slot).otherwise(best)

    none = F.struct(F.lit(None).cast("double").alias("value"), F.lit(None).cast("int").alias("idx"))
    best = F.aggregate(F.sequence(F.lit(0), F.col("width").cast("int") - 1), none, better)
    # A generator's row: it is folded once, not for each of its fields.
    return best_slots(blocks.select(key, "step", "col", F.inline(F.array(best))), [key, "step"])


def decode(
    rows: DataFrame, keys: Sequence[str], nums: Sequence[str], cats: Sequence[str], scaler: DataFrame, vocabulary: DataFrame,
    value: str = "value", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per key with a column per original name: numbers unscaled, categories by their best slot.

    The best slot is found by a grouped aggregation and named by a join on (col, idx), so a block may be as wide as there are rows.
    """
    best = best_slots(rows.select(*keys, *PLACE, F.col(value).alias("value")), keys)
    known = vocabulary.select("col", "idx", F.col("value").alias("_v"))
    named = skew_join(best.where(F.col("col").isin(list(cats))), known, list(PLACE), "inner", F.struct(*keys), hot_rows).select(
        *keys, "col", "_v", F.lit(None).cast("double").alias("_x"))
    if nums:
        numbers = best.where(F.col("col").isin(list(nums))).join(F.broadcast(scaler), "col").select(
            *keys, "col", F.lit(None).cast("string").alias("_v"), numeric.min_max_unscale(F.col("value"), F.col("min"), F.col("max")).alias("_x"))
        named = named.unionByName(numbers)
    return named.groupBy(*keys).agg(*[
        F.max(F.when(F.col("col") == c, F.col("_x" if c in nums else "_v"))).alias(c) for c in [*nums, *cats]])
