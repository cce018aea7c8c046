"""Min-max scaling and one-hot encoding with fitted tables, and their inverses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from terraloom.functions import arrays, numeric
from terraloom.operators.columns import quoted
from terraloom.operators.keys import attach_row_ids


def fit_scaler(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(col, min, max) per numeric column, from one aggregate pass."""
    fitted = df.agg(F.array(*[
        F.struct(
            F.lit(n).alias("col"), F.min(quoted(n)).cast("double").alias("min"), F.max(quoted(n)).cast("double").alias("max")
        ) for n in names
    ]).alias("f"))
    return fitted.select(F.inline("f"))


def fit_vocabulary(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(col, value, idx) with the distinct values of each column numbered in sorted order.

    The distinct runs on (col, value) and folds repeats on the map side; the values
    are then sorted by ranges, so a vocabulary of any size is numbered by many
    tasks.  Dense one-hot rows are as wide as the vocabulary; ``sparse_slots``
    encodes wide ones.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("col"), quoted(n).cast("string").alias("value")) for n in names
    ])).alias("e")).select("e.*").where(F.col("value").isNotNull())
    placed = attach_row_ids(long.distinct(), ["col", "value"], out="_place")
    starts = placed.groupBy("col").agg(F.min("_place").alias("_first"))
    return placed.join(F.broadcast(starts), "col").select("col", "value", (F.col("_place") - F.col("_first")).cast("int").alias("idx"))


def sparse_slots(df: DataFrame, cats: Sequence[str], vocabulary: DataFrame, key: str) -> DataFrame:
    """(key, col, idx): the slot that is 1 of each one-hot block, by a join, so blocks may be of any width.

    A value outside the vocabulary is an error; NULL has no slot.
    """
    long = df.select(quoted(key).alias(key), F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), quoted(c).cast("string").alias("value")) for c in cats
    ])).alias("_e")).select(key, "_e.*").where(F.col("value").isNotNull())
    unseen = F.raise_error(F.concat(F.lit("unseen category: "), F.col("value"))).cast("int")
    return long.join(vocabulary, ["col", "value"], "left").select(
        key, "col", F.when(F.col("idx").isNull(), unseen).otherwise(F.col("idx")).alias("idx"))


def _scaler_map(scaler: DataFrame) -> Column:
    return scaler.agg(F.map_from_entries(F.collect_list(F.struct("col", F.struct("min", "max")))).alias("m")).scalar()


def _vocabulary_map(vocabulary: DataFrame) -> Column:
    """col -> array of values in index order."""
    blocks = vocabulary.groupBy("col").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "value"))), lambda e: e["value"]).alias("values"))
    return blocks.agg(F.map_from_entries(F.collect_list(F.struct("col", "values"))).alias("m")).scalar()


def min_max_transform(df: DataFrame, names: Sequence[str], scaler: DataFrame) -> DataFrame:
    fitted = df.withColumn("_scaler", _scaler_map(scaler))
    return fitted.withColumns({
        n: numeric.min_max_scale(quoted(n).cast("double"), F.col("_scaler")[n]["min"], F.col("_scaler")[n]["max"])
        for n in names
    }).drop("_scaler")


def min_max_inverse(df: DataFrame, names: Sequence[str], scaler: DataFrame) -> DataFrame:
    fitted = df.withColumn("_scaler", _scaler_map(scaler))
    return fitted.withColumns({
        n: numeric.min_max_unscale(quoted(n), F.col("_scaler")[n]["min"], F.col("_scaler")[n]["max"]) for n in names
    }).drop("_scaler")


def one_hot(value: Column, vocabulary: Column) -> Column:
    """0/1 block of a value; a value outside the vocabulary is an error."""
    block = F.transform(vocabulary, lambda v: (v == value).cast("double"))
    unseen = F.raise_error(F.concat(F.lit("unseen category: "), F.coalesce(value, F.lit("NULL")))).cast("array<double>")
    return F.when(F.array_contains(vocabulary, value), block).otherwise(unseen)


def one_hot_inverse(block: Column, vocabulary: Column) -> Column:
    """The value with the largest score, the first one on ties."""
    return F.element_at(vocabulary, arrays.argmax(block).cast("int"))


def encode(
    df: DataFrame, nums: Sequence[str], cats: Sequence[str], scaler: DataFrame, vocabulary: DataFrame, out: str = "features"
) -> DataFrame:
    """Add one array: scaled numbers, then the one-hot block of every category."""
    scaled = df.withColumns({"_scaler": _scaler_map(scaler), "_vocab": _vocabulary_map(vocabulary)})
    numbers = F.array(*[
        numeric.min_max_scale(quoted(n).cast("double"), F.col("_scaler")[n]["min"], F.col("_scaler")[n]["max"]) for n in nums
    ]) if nums else F.array().cast("array<double>")
    blocks = [one_hot(quoted(c).cast("string"), F.col("_vocab")[c]) for c in cats]
    return scaled.withColumn(out, F.concat(numbers, *blocks)).drop("_scaler", "_vocab")


def decode(
    df: DataFrame, nums: Sequence[str], cats: Sequence[str], scaler: DataFrame, vocabulary: DataFrame,
    features: str = "features",
) -> DataFrame:
    """Back from the array to one column per original name."""
    fitted = df.withColumns({"_scaler": _scaler_map(scaler), "_vocab": _vocabulary_map(vocabulary)})
    cols = {
        n: numeric.min_max_unscale(F.get(features, F.lit(i)), F.col("_scaler")[n]["min"], F.col("_scaler")[n]["max"])
        for i, n in enumerate(nums)
    }
    start = F.lit(len(nums) + 1)
    for c in cats:
        width = F.size(F.col("_vocab")[c])
        cols[c] = one_hot_inverse(F.slice(features, start, width), F.col("_vocab")[c])
        start = start + width
    return fitted.withColumns(cols).drop("_scaler", "_vocab", features)


def feature_names(nums: Sequence[str], vocabulary: DataFrame, cats: Sequence[str]) -> DataFrame:
    """(position, name) of the feature array; a one-hot slot is named ``column_value``."""
    order = F.create_map(*[x for i, c in enumerate(cats) for x in (F.lit(c), F.lit(i))])
    slots = vocabulary.groupBy("col").agg(F.count(F.lit(1)).alias("width")).withColumn("_at", order[F.col("col")])
    before = F.coalesce(F.sum("width").over(W.orderBy("_at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = slots.select("col", (before + len(nums)).alias("_start"))
    named = vocabulary.join(F.broadcast(starts), "col").select(
        (F.col("_start") + F.col("idx")).cast("int").alias("position"), F.concat_ws("_", "col", "value").alias("name"))
    if not nums:
        return named
    numbers = vocabulary.sparkSession.createDataFrame(list(enumerate(nums)), "position int, name string")
    return numbers.unionByName(named)
