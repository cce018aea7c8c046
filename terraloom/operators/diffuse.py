"""Forward noising of feature arrays, noise recovery, alignment check and scoring."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from terraloom.functions import arrays

SMOOTHING = 0.008  # fixed value: offset of the cosine schedule


def alpha_at(time: Column, total_time: float, s: float = SMOOTHING) -> Column:
    """cos^2 schedule, not normalised by its value at time 0."""
    c = F.cos(((time / F.lit(float(total_time))) + F.lit(s)) / F.lit(1.0 + s) * F.lit(math.pi / 2))
    return c * c


def step_time(step: Column, num_steps: int, total_time: float) -> Column:
    """Evenly spaced times 0..total_time, both ends included."""
    if num_steps == 1:
        return step * F.lit(0.0)
    return step * F.lit(float(total_time)) / F.lit(float(num_steps - 1))


def alpha_of_step(step: Column, num_steps: int, total_time: float, s: float = SMOOTHING) -> Column:
    return alpha_at(step_time(step, num_steps, total_time), total_time, s)


def schedule(num_steps: int, s: float = SMOOTHING) -> list[tuple[int, float]]:
    """(step, alpha) of evenly spaced steps as plain numbers; the total time cancels out."""
    out = []
    for step in range(num_steps):
        share = step / (num_steps - 1) if num_steps > 1 else 0.0
        out.append((step, math.cos((share + s) / (1 + s) * math.pi / 2) ** 2))
    return out


def with_steps(df: DataFrame, num_steps: int, s: float = SMOOTHING) -> DataFrame:
    """Every row once per step, with alpha, ``signal`` (its root) and ``spread`` (the root of 1 - alpha).

    The schedule is a constant that is unfolded in place, so nothing is joined,
    shuffled or computed again per row.
    """
    entries = ", ".join(
        f"named_struct('step', {i}, 'alpha', {a!r}D, 'signal', {math.sqrt(a)!r}D, 'spread', {math.sqrt(1 - a)!r}D)"
        for i, a in schedule(num_steps, s)
    )
    return df.select(*df.columns, F.inline(F.expr(f"array({entries})")))


def add_noise(clean: Column, noise: Column, signal: Column, spread: Column) -> Column:
    return arrays.blend(clean, signal, noise, spread)


def _unblend(mixed: Column, part: Column, weight: Column, other: Column) -> Column:
    """(mixed - weight * part) / other, NULLs where ``other`` is 0 and the answer is lost."""
    solved = F.zip_with(mixed, part, lambda m, p: (m - weight * p) / other)
    return F.when(other != 0, solved).otherwise(F.transform(mixed, lambda _: F.lit(None).cast("double")))


def noise_from(noisy: Column, clean: Column, signal: Column, spread: Column) -> Column:
    """The noise that was added."""
    return _unblend(noisy, clean, signal, spread)


def clean_from(noisy: Column, noise: Column, signal: Column, spread: Column) -> Column:
    """The row the noise was added to."""
    return _unblend(noisy, noise, spread, signal)


def gaussian_like(features: Column, draw: Column) -> Column:
    """Standard-normal noise as long as the features.

    ``draw`` is a 64-bit hash of the row and the step; hashing it with the
    position drives a Box-Muller pair, so a lost task draws the same noise when
    it is run again.
    """
    def uniform(i: Column, which: int) -> Column:
        return (F.shiftrightunsigned(F.xxhash64(draw, i, F.lit(which)), 11) + F.lit(0.5)) / F.lit(float(2**53))

    return F.transform(
        features, lambda _, i: F.sqrt(F.lit(-2.0) * F.ln(uniform(i, 0))) * F.cos(F.lit(2 * math.pi) * uniform(i, 1))
    )


def forward_diffuse(
    df: DataFrame, features: str, num_steps: int, s: float = SMOOTHING,
    noise: Callable[[Column], Column] | None = None, seed: int = 0, row_id: str | None = None, step_slot: bool = False,
) -> DataFrame:
    """Add step, alpha, signal, spread, noise and noisy for every row and step.

    ``noise`` builds the noise array from the step column; without it the noise
    is drawn from a hash of the row (of ``row_id``, if given, so that equal rows
    get different noise).  ``step_slot`` appends the step to the noisy array.
    """
    stepped = with_steps(df, num_steps, s)
    if noise is not None:
        drawn = noise(F.col("step"))
    else:
        row = F.col(features) if row_id is None else F.col(row_id)
        stepped = stepped.withColumn("_draw", F.xxhash64(F.lit(seed), row, F.col("step")))
        drawn = gaussian_like(F.col(features), F.col("_draw"))
    out = stepped.withColumn("noise", drawn).withColumn(
        "noisy", add_noise(F.col(features), F.col("noise"), F.col("signal"), F.col("spread")))
    if step_slot:
        out = out.withColumn("noisy", F.concat("noisy", F.array(F.col("step").cast("double"))))
    return out.drop("_draw")


def recover_noise(df: DataFrame, noisy: str, clean: str, out: str = "recovered") -> DataFrame:
    """Add the noise of rows that carry signal and spread."""
    return df.withColumn(out, noise_from(F.col(noisy), F.col(clean), F.col("signal"), F.col("spread")))


def check_alignment(
    df: DataFrame, noisy: str, noise: str, clean: str, atol: float = 1e-5, rtol: float = 1e-5
) -> DataFrame:
    """(step, aligned): do clean rows and noise rebuild every noisy row of the step."""
    rebuilt = add_noise(F.col(clean), F.col(noise), F.col("signal"), F.col("spread"))
    return df.groupBy("step").agg(F.bool_and(arrays.all_close(rebuilt, F.col(noisy), atol, rtol)).alias("aligned"))


def mean_squared_error(df: DataFrame, predicted: str, actual: str, keys: list[str] | None = None) -> DataFrame:
    """Mean over all elements of the squared difference of two arrays."""
    sums = df.groupBy(*(keys or [])).agg(
        F.sum(arrays.squared_error(F.col(predicted), F.col(actual))).alias("_sum"), F.sum(F.size(actual)).alias("_n"))
    return sums.select(*(keys or []), (F.col("_sum") / F.nullif(F.col("_n"), F.lit(0))).alias("mse"))


def split_blocks(values: Column, n_num: int, n_cat: int) -> tuple[Column, Column]:
    return F.slice(values, 1, n_num), F.slice(values, n_num + 1, n_cat)


def denoise(
    df: DataFrame, noisy: str, score: Callable[[pd.DataFrame], pd.Series], n_num: int, n_cat: int
) -> DataFrame:
    """Subtract the noise a caller's model predicts and split the result.

    ``score`` gets an Arrow batch with all columns of ``df`` and returns one
    array of predicted noise per row.  An array that is not ``n_num + n_cat``
    slots wide is an error.
    """
    schema = f"{df.schema.simpleString()[7:-1]},predicted:array<double>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(predicted=score(batch))

    width = n_num + n_cat
    scored = df.mapInPandas(run, schema).withColumn("_raw", arrays.subtract(F.col(noisy), F.col("predicted")))
    wrong = F.raise_error(F.concat(F.lit(f"expected {width} slots, got "), F.size("_raw").cast("string"))).cast("array<double>")
    whole = F.when(F.col("_raw").isNull() | (F.size("_raw") == width), F.col("_raw")).otherwise(wrong)
    nums, cats = split_blocks(whole, n_num, n_cat)
    return scored.withColumns({"nums": nums, "cats": cats}).drop("_raw")
