"""Exact interpolated quantiles without holding a large group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one buffer,
which fails once a single group holds a large share of the data.  Here

* groups up to ``HOT_ROWS`` rows are ordered by a window, which can spill: one
  shuffle by key, and other aggregates of the group fit in the same stage;
* larger groups are reduced to value frequencies, shuffled by (key, value), so
  they spread out and repeated values combine on the map side.  A histogram over
  magnitude bins that do not depend on the data (about 6e-5 of relative width)
  then tells which bins hold a wanted rank, and only those are ordered, each on
  its own.

Both give the same exact answer.  With no large group the second part is empty
and adaptive execution drops it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

BINS_PER_E = 2**14
HOT_ROWS = 1_000_000  # rows of one group that a single task may order
HOT_VALUES = 1_000_000  # the same for groups that come as value frequencies
LOG_RANGE = (-746.0, 710.0)  # natural logs of all positive doubles lie inside


def magnitude_bin(name: str) -> Column:
    """Non-decreasing step function of a double column; equal-width bins of its log magnitude."""
    low, high = LOG_RANGE
    step = f"floor((least(ln(abs({name})), {high}D) + {-low}D) * {BINS_PER_E})"
    return F.expr(f"CASE WHEN {name} > 0 THEN {step} WHEN {name} < 0 THEN -{step} ELSE 0L END")


def large_groups_of_rows(df: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``limit`` rows: at most (rows / limit) of them, which bounds a broadcast."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.where(F.col("_rows") > limit).select(*keys)


def with_ranks(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the rank range of every row's ``_v`` in its group and the size of the group."""
    group = W.partitionBy(*keys)
    ranked = df.withColumns({"_upto": F.row_number().over(group.orderBy("_v")), "_total": F.count(F.lit(1)).over(group)})
    return ranked.withColumn("_from", F.col("_upto") - 1)


def value_frequencies(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n) of the non-null, non-NaN values; rows without a key are not a group."""
    return present_values(df, keys, value).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))


def present_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.select(*keys, F.col(value).cast("double").alias("_v")).dropna(how="any")


def large_groups(freq: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Keys with more than ``limit`` distinct values: at most (distinct values / limit), which bounds a broadcast.

    The row count adds nothing to the test but keeps this read of the frequencies
    equal to the others, so they are shuffled once.
    """
    sizes = freq.groupBy(*keys).agg(F.count(F.lit(1)).alias("_values"), F.sum("_n").alias("_rows"))
    return sizes.where((F.col("_values") > limit) & (F.col("_rows") > limit)).select(*keys)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per key with one linearly interpolated quantile per entry of ``probs``."""
    keys = list(keys)
    values = present_values(df, keys, value)
    hot = F.broadcast(large_groups_of_rows(values, keys, hot_rows))
    small = with_ranks(values.join(hot, keys, "left_anti"), keys).groupBy(*keys).agg(*rank_picks(probs))
    large = quantiles_of_large_groups(values.join(hot, keys, "left_semi"), keys, probs)
    return interpolated(small, keys, probs).unionByName(large)


def quantiles_of_large_groups(values: DataFrame, keys: list[str], probs: Mapping[str, float]) -> DataFrame:
    """Quantiles of (keys, _v) rows whose groups are too large for one task."""
    freq = values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    return _ordered_in_bins(freq, keys, probs)


def quantiles_of_frequencies(
    freq: DataFrame, keys: Sequence[str], probs: Mapping[str, float], hot_values: int = HOT_VALUES
) -> DataFrame:
    """Quantiles of (keys, _v, _n) as ``value_frequencies`` makes them."""
    keys = list(keys)
    hot = F.broadcast(large_groups(freq, keys, hot_values))
    small = _ordered_whole(freq.join(hot, keys, "left_anti"), keys, probs)
    return small.unionByName(_ordered_in_bins(freq.join(hot, keys, "left_semi"), keys, probs))


def _ranks(p: float) -> tuple[str, str, str]:
    """SQL text: 0-based ranks of the two neighbours of a quantile and the share of the upper one."""
    at = f"(_total - 1) * {float(p)!r}D"
    return f"floor({at})", f"ceil({at})", f"{at} - floor({at})"


def rank_picks(probs: Mapping[str, float]) -> list[Column]:
    """Aggregates over rows (_v, _from, _upto, _total), each holding the ranks _from.._upto-1 of its group."""
    out = []
    for i, p in enumerate(probs.values()):
        low, high, share = _ranks(p)
        out += [F.expr(f"max(CASE WHEN {rank} >= _from AND {rank} < _upto THEN _v END) AS {name}{i}")
                for rank, name in ((low, "_low"), (high, "_high"))]
        out.append(F.expr(f"max({share}) AS _share{i}"))
    return out


def interpolated(picked: DataFrame, keep: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """Turn the picks into one column per quantile."""
    return picked.select(*keep, *[
        F.expr(f"CASE WHEN _share{i} = 0 THEN _low{i} ELSE _low{i} + (_high{i} - _low{i}) * _share{i} END").alias(name)
        for i, name in enumerate(probs)
    ])


def _ordered_whole(freq: DataFrame, keys: list[str], probs: Mapping[str, float]) -> DataFrame:
    group = W.partitionBy(*keys)
    ranked = freq.withColumns({
        "_upto": F.sum("_n").over(group.orderBy("_v").rowsBetween(W.unboundedPreceding, 0)),
        "_total": F.sum("_n").over(group),
    }).withColumn("_from", F.col("_upto") - F.col("_n"))
    return interpolated(ranked.groupBy(*keys).agg(*rank_picks(probs)), keys, probs)


def _ordered_in_bins(freq: DataFrame, keys: list[str], probs: Mapping[str, float]) -> DataFrame:
    binned = freq.withColumn("_bin", magnitude_bin("_v"))
    hist = binned.groupBy(*keys, "_bin").agg(F.sum("_n").alias("_m"))
    group = W.partitionBy(*keys)
    running = hist.withColumns({
        "_end": F.sum("_m").over(group.orderBy("_bin").rowsBetween(W.unboundedPreceding, 0)),
        "_total": F.sum("_m").over(group),
    }).withColumn("_start", F.col("_end") - F.col("_m"))
    holds = " OR ".join(f"({rank} >= _start AND {rank} < _end)" for p in probs.values() for rank in _ranks(p)[:2])
    wanted = running.where(holds).select(*keys, "_bin", "_start", "_total")

    in_bin = W.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ranked = binned.join(wanted, [*keys, "_bin"], "inner").withColumn(
        "_upto", F.col("_start") + F.sum("_n").over(in_bin)
    ).withColumn("_from", F.col("_upto") - F.col("_n"))
    return interpolated(ranked.groupBy(*keys).agg(*rank_picks(probs)), keys, probs)
