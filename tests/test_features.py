"""Encoding, diffusion and profiles."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.operators import diffuse, encode, profile

DATA = [(0, 1.0, 7.0, "b", "x"), (1, 3.0, 7.0, "a", "y"), (2, 2.0, 7.0, "c", "x")]
SCHEMA = "id int, n double, flat double, c string, d string"


def fitted(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    return df, encode.fit_scaler(df, ["n", "flat"]), encode.fit_vocabulary(df, ["c", "d"])


def test_encode(spark, rows):
    df, scaler, vocab = fitted(spark)
    assert rows(vocab) == [("c", "a", 0), ("c", "b", 1), ("c", "c", 2), ("d", "x", 0), ("d", "y", 1)]
    got = {r.id: r.features for r in encode.encode(df, ["n", "flat"], ["c", "d"], scaler, vocab).collect()}
    assert got == {0: [0, 0, 0, 1, 0, 1, 0], 1: [1, 0, 1, 0, 0, 0, 1], 2: [0.5, 0, 0, 0, 1, 1, 0]}
    assert rows(encode.feature_names(["n", "flat"], vocab, ["c", "d"])) == [
        (0, "n"), (1, "flat"), (2, "c_a"), (3, "c_b"), (4, "c_c"), (5, "d_x"), (6, "d_y")]


def test_decode_inverts_encode(spark, rows):
    df, scaler, vocab = fitted(spark)
    args = (["n", "flat"], ["c", "d"], scaler, vocab)
    assert rows(encode.decode(encode.encode(df, *args).select("id", "features"), *args)) == sorted(DATA)


def test_decode_takes_first_on_ties(spark):
    _, scaler, vocab = fitted(spark)
    df = spark.createDataFrame([([0.0, 0.0, 0.4, 0.4, 0.1, -1.0, -2.0],)], "features array<double>")
    r = encode.decode(df, ["n", "flat"], ["c", "d"], scaler, vocab).first()
    assert (r.n, r.flat, r.c, r.d) == (1.0, 7.0, "a", "x")


@pytest.mark.parametrize("value", ["new", None])
def test_unseen_category_fails(spark, value):
    df, scaler, vocab = fitted(spark)
    odd = df.withColumn("c", F.lit(value).cast("string"))
    with pytest.raises(Exception, match="unseen category"):
        encode.encode(odd, ["n"], ["c"], scaler, vocab).collect()


def test_alpha_schedule_golden(spark):
    got = [r[0] for r in spark.range(5).select(diffuse.alpha_of_step(F.col("id"), 5, 100.0)).collect()]
    want = [0.9998445910004082, 0.8468805280142708, 0.49376684270229254, 0.144249681202635, 0.0]
    assert got == pytest.approx(want, abs=1e-12)
    steps = diffuse.with_steps(spark.range(1), 5).collect()
    assert [r.alpha for r in steps] == pytest.approx(want, abs=1e-12) and [r.step for r in steps] == list(range(5))
    assert all(r.signal**2 == pytest.approx(r.alpha) and r.spread**2 == pytest.approx(1 - r.alpha) for r in steps)
    assert spark.range(1).select(diffuse.step_time(F.col("id"), 1, 100.0)).first()[0] == 0.0


def test_noise_round_trip(spark):
    df, scaler, vocab = fitted(spark)
    encoded = encode.encode(df, ["n"], ["c"], scaler, vocab).select("id", "features")
    out = diffuse.forward_diffuse(encoded, "features", 4, seed=3, row_id="id")
    assert out.count() == 12
    for r in diffuse.recover_noise(out, "noisy", "features").collect():
        a = r.alpha
        assert r.noisy == pytest.approx([math.sqrt(a) * x + math.sqrt(1 - a) * e for x, e in zip(r.features, r.noise)])
        assert r.recovered == pytest.approx(r.noise, abs=1e-9)
    assert {r.step: r.aligned for r in diffuse.check_alignment(out, "noisy", "noise", "features").collect()} == {i: True for i in range(4)}
    clean = out.where("step < 3").select("features", diffuse.clean_from(F.col("noisy"), F.col("noise"), F.col("signal"), F.col("spread")).alias("back"))
    for r in clean.collect():
        assert r.back == pytest.approx(r.features, abs=1e-9)
    slot = diffuse.forward_diffuse(encoded, "features", 2, step_slot=True).where("step = 1").first()
    assert len(slot.noisy) == len(slot.features) + 1 and slot.noisy[-1] == 1.0


def test_drawn_noise_repeats_and_is_normal(spark):
    df = spark.range(20_000).select("id", F.array(F.lit(0.0), F.lit(0.0)).alias("f"))
    draw = lambda d: diffuse.forward_diffuse(d, "f", 2, seed=1, row_id="id").select("id", "step", "noise")
    again = draw(df.repartition(7))
    assert draw(df).exceptAll(again).isEmpty()
    e = np.array([r.noise for r in again.collect()])
    assert abs(e.mean()) < 0.02 and abs(e.var() - 1) < 0.02 and abs((np.abs(e) < 1.96).mean() - 0.95) < 0.005
    assert abs(np.corrcoef(e[:, 0], e[:, 1])[0, 1]) < 0.02


def test_mse_and_denoise(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0], [1.0, 0.0, 0.0]), (2, [0.0, 0.0, 0.0], [0.0, 0.0, 3.0])], "id int, a array<double>, b array<double>")
    assert diffuse.mean_squared_error(df, "a", "b").first().mse == pytest.approx((4 + 9 + 9) / 6)
    out = diffuse.denoise(df, "a", lambda batch: batch["b"], 1, 2)
    got = {r.id: (list(r.nums), list(r.cats)) for r in out.collect()}
    assert got == {1: ([0.0], [2.0, 3.0]), 2: ([0.0], [0.0, -3.0])}


@pytest.mark.parametrize("hot_rows", [10**6, 5])
def test_box_summary(spark, hot_rows):
    rng = random.Random(8)
    data = [("a" if i % 3 else "b", math.exp(rng.gauss(0, 1) + (8 if i % 50 == 0 else 0))) for i in range(600)] + [(None, 1.0), ("a", None)]
    df = profile.log_target(spark.createDataFrame(data, "k string, t double"), "t")
    got = {r.value: r for r in profile.box_summary(df, "t", ["k"], hot_rows).collect()}
    assert set(got) == {"a", "b"}
    for k in "ab":
        y = np.log([v for kk, v in data if kk == k and v is not None])
        q1, med, q3 = np.quantile(y, [0.25, 0.5, 0.75])
        inside = y[(y >= q1 - 1.5 * (q3 - q1)) & (y <= q3 + 1.5 * (q3 - q1))]
        r = got[k]
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, med, q3))
        assert (r.low_whisker, r.high_whisker) == pytest.approx((inside.min(), inside.max()))
        assert r.n == len(y) and r.outliers == len(y) - len(inside)


def test_bin_scatter(spark, rows):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (10.0, 10.0), (10.0, -math.inf), (None, 1.0)], "x double, y double")
    assert rows(profile.bin_scatter(df, "y", ["x"], bins=5)) == [("x", 1, 1, 2), ("x", 5, 5, 1)]
    flat = spark.createDataFrame([(3.0, 4.0)], "x double, y double")
    assert rows(profile.bin_scatter(flat, "y", ["x"])) == [("x", 1, 1, 1)]
    assert profile.target_correlation(df, "y", ["x"]).first()["corr"] == pytest.approx(1.0)
    assert profile.profiled_columns(df.withColumn("SEX", F.lit(1)), "y") == ["x"]


def test_wide_vocabulary(spark):
    """More values than any dense block should hold: numbered by many tasks, encoded as slots."""
    df = spark.range(120_000).selectExpr("id", "concat('v', lpad(id, 7, '0')) AS c", "if(id % 3 = 0, null, id % 2) AS d")
    vocabulary = encode.fit_vocabulary(df, ["c", "d"])
    assert vocabulary.groupBy("col").agg(F.count("*"), F.min("idx"), F.max("idx"), F.count_distinct("idx")).orderBy("col").collect() == [
        ("c", 120_000, 0, 119_999, 120_000), ("d", 2, 0, 1, 2)]
    slots = encode.sparse_slots(df, ["c", "d"], vocabulary, "id")
    assert slots.where("col = 'c' AND idx <> id").isEmpty() and slots.where("col = 'd'").count() == 80_000
    with pytest.raises(Exception, match="unseen category"):
        encode.sparse_slots(df.selectExpr("id", "'new' AS c"), ["c"], vocabulary, "id").collect()


def test_denoise_checks_the_width(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "id int, a array<double>")
    with pytest.raises(Exception, match="expected 2 slots, got 3"):
        diffuse.denoise(df, "a", lambda batch: batch["a"], 1, 1).collect()
