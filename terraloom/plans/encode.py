"""Scaling, one-hot blocks, noise schedule, recovery and losses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terraloom.operators import diffuse, encode, keys
from terraloom.plans.common import snap, sql_snap, table

NUMS = ["p_size", "p_retailprice"]
CATS = ["p_brand", "p_type"]


def _fit(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    part = table(spark, sf, "part")
    return part, encode.fit_scaler(part, NUMS), encode.fit_vocabulary(part, CATS)


def fit_scaler(spark: SparkSession, sf: str) -> DataFrame:
    return encode.fit_scaler(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


FIT_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS col, min({c}) AS min, max({c}) AS max FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount"))


def fit_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return encode.fit_vocabulary(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


VOCAB_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS col, value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS value FROM lineitem)"
    for c in ("l_returnflag", "l_linestatus", "l_linenumber"))


def minmax_scale(spark: SparkSession, sf: str) -> DataFrame:
    """A column that is the same everywhere scales to 0."""
    part = table(spark, sf, "part").withColumn("flat", F.lit(7.0))
    scaled = encode.min_max_transform(part, [*NUMS, "flat"], encode.fit_scaler(part, [*NUMS, "flat"]))
    return scaled.select("p_partkey", *[snap(F.col(c), 8).alias(c) for c in NUMS], "flat")


_SCALED_SQL = """
scaled AS (
  SELECT p_partkey, (p_size - min(p_size) OVER ()) / CAST(max(p_size) OVER () - min(p_size) OVER () AS DOUBLE) AS p_size,
         (p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()) AS p_retailprice,
         p_brand, p_type FROM part)"""
SCALE_SQL = f"WITH {_SCALED_SQL} SELECT p_partkey, {sql_snap('p_size', 8)} AS p_size, {sql_snap('p_retailprice', 8)} AS p_retailprice, 0e0 AS flat FROM scaled"


def minmax_inverse(spark: SparkSession, sf: str) -> DataFrame:
    part, scaler, _ = _fit(spark, sf)
    back = encode.min_max_inverse(encode.min_max_transform(part, NUMS, scaler), NUMS, scaler)
    return back.select("p_partkey", *[snap(F.col(c), 6).alias(c) for c in NUMS])


INVERSE_SQL = f"SELECT p_partkey, {sql_snap('p_size')} AS p_size, {sql_snap('p_retailprice')} AS p_retailprice FROM part"


def _slots(df: DataFrame, name: str, digits: int) -> DataFrame:
    """An array column as one row per slot, values snapped."""
    rest = [c for c in df.columns if c != name]
    long = df.select(*rest, F.posexplode(name).alias("slot", "_x"))
    return long.select(*rest, "slot", snap(F.col("_x"), digits).alias(name))


_SLOT_SQL = "CAST(unnest(range(0, len(f))) AS INTEGER) AS slot"


def onehot(spark: SparkSession, sf: str) -> DataFrame:
    """Feature arrays, one row per slot: two scaled numbers and two one-hot blocks."""
    part, scaler, vocabulary = _fit(spark, sf)
    encoded = encode.encode(part, NUMS, CATS, scaler, vocabulary)
    return _slots(encoded.select("p_partkey", "features"), "features", 8)


_VOCAB_ARRAYS = """
vocab AS (SELECT (SELECT list(v ORDER BY v) FROM (SELECT DISTINCT p_brand AS v FROM part)) AS brands,
                 (SELECT list(v ORDER BY v) FROM (SELECT DISTINCT p_type AS v FROM part)) AS types)"""
_FEATURES_SQL = f"""{_SCALED_SQL}, {_VOCAB_ARRAYS}, feats AS (
  SELECT p_partkey, list_concat(list_concat([p_size, p_retailprice], list_transform(brands, lambda b: CAST(b = p_brand AS DOUBLE))),
                                list_transform(types, lambda t: CAST(t = p_type AS DOUBLE))) AS f
  FROM scaled, vocab)"""
ONEHOT_SQL = f"""
WITH {_FEATURES_SQL} SELECT p_partkey, slot, {sql_snap('x', 8)} AS features
FROM (SELECT p_partkey, {_SLOT_SQL}, unnest(f) AS x FROM feats)
"""


def onehot_inverse(spark: SparkSession, sf: str) -> DataFrame:
    """decode(encode(row)) is the row."""
    part, scaler, vocabulary = _fit(spark, sf)
    encoded = encode.encode(part, NUMS, CATS, scaler, vocabulary).select("p_partkey", "features")
    decoded = encode.decode(encoded, NUMS, CATS, scaler, vocabulary)
    return decoded.select("p_partkey", snap(F.col("p_size")).alias("p_size"), snap(F.col("p_retailprice")).alias("p_retailprice"), *CATS)


DECODE_SQL = f"SELECT p_partkey, {sql_snap('p_size')} AS p_size, {sql_snap('p_retailprice')} AS p_retailprice, p_brand, p_type FROM part"


def feature_names(spark: SparkSession, sf: str) -> DataFrame:
    _, _, vocabulary = _fit(spark, sf)
    return encode.feature_names(NUMS, vocabulary, CATS)


NAMES_SQL = f"""
WITH {_VOCAB_ARRAYS}, n AS (
  SELECT list_concat(list_concat({NUMS}, list_transform(brands, lambda b: 'p_brand_' || b)), list_transform(types, lambda t: 'p_type_' || t)) AS names FROM vocab)
SELECT CAST(unnest(range(0, len(names))) AS INTEGER) AS position, unnest(names) AS name FROM n
"""

STEPS, TOTAL = 5, 100.0


def alpha_schedule(spark: SparkSession, sf: str) -> DataFrame:
    """Alpha of every shipment line, its line number taken as the step of seven."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    alpha = diffuse.alpha_of_step(F.col("l_linenumber") - 1, 7, TOTAL)
    return lines.groupBy("l_linenumber", snap(alpha, 9).alias("alpha")).agg(F.count(F.lit(1)).alias("n"))


ALPHA_SQL = f"""
SELECT l_linenumber, {sql_snap(f"cos(((l_linenumber - 1) / 6.0 + 0.008) / 1.008 * pi() / 2) ** 2", 9)} AS alpha, count(*) AS n
FROM lineitem GROUP BY l_linenumber
"""


def _noise(features: str):
    """Noise from the features themselves, so both engines can build the same one."""
    return lambda step: F.transform(F.col(features), lambda x: F.sin(x * 37 + step) * 1.4)


def _diffused(spark: SparkSession, sf: str) -> DataFrame:
    """Every part once per step; a part makes hundreds of values a step, so the parts are spread first."""
    part, scaler, vocabulary = _fit(spark, sf)
    spread = keys.spread_rows(part.select("p_partkey", *NUMS, *CATS))
    encoded = encode.encode(spread, NUMS, CATS, scaler, vocabulary).select("p_partkey", "features")
    return diffuse.forward_diffuse(encoded, "features", STEPS, noise=_noise("features"))


_DIFFUSED_SQL = f"""{_FEATURES_SQL}, stepped AS (
  SELECT p_partkey, f, CAST(unnest(range(0, {STEPS})) AS INTEGER) AS step FROM feats
), alphas AS (
  SELECT *, cos((step / {STEPS - 1}.0 + 0.008) / 1.008 * pi() / 2) ** 2 AS alpha FROM stepped
), diffused AS (
  SELECT *, list_transform(f, lambda x: sqrt(alpha) * x + sqrt(1 - alpha) * sin(x * 37 + step) * 1.4) AS noisy FROM alphas
)"""


def forward_noise(spark: SparkSession, sf: str) -> DataFrame:
    noisy = _diffused(spark, sf).select("p_partkey", "step", snap(F.col("alpha"), 9).alias("alpha"), "noisy")
    return _slots(noisy, "noisy", 6)


FORWARD_SQL = f"""
WITH {_DIFFUSED_SQL}
SELECT p_partkey, step, {sql_snap('alpha', 9)} AS alpha, slot, {sql_snap('x')} AS noisy
FROM (SELECT p_partkey, step, alpha, {_SLOT_SQL}, unnest(noisy) AS x FROM diffused)
"""


def recover_noise(spark: SparkSession, sf: str) -> DataFrame:
    """The recovered noise is the noise that went in (step 0 adds nearly none, hence fewer digits)."""
    back = diffuse.recover_noise(_diffused(spark, sf), "noisy", "features")
    return _slots(back.select("p_partkey", "step", "recovered"), "recovered", 4)


RECOVER_SQL = f"""
WITH {_FEATURES_SQL}
SELECT p_partkey, step, slot, {sql_snap('sin(x * 37 + step) * 1.4', 4)} AS recovered
FROM (SELECT p_partkey, step, {_SLOT_SQL}, unnest(f) AS x FROM (
  SELECT p_partkey, f, CAST(unnest(range(0, {STEPS})) AS INTEGER) AS step FROM feats))
"""


def check_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Step 3 is given noise that is off, so only that step fails."""
    diffused = _diffused(spark, sf)
    off = F.when(F.col("step") == 3, F.transform("noise", lambda x: x + 0.01)).otherwise(F.col("noise"))
    return diffuse.check_alignment(diffused.withColumn("noise", off), "noisy", "noise", "features")


ALIGN_SQL = f"""
WITH {_DIFFUSED_SQL}, cells AS (SELECT step, alpha, unnest(f) AS x, unnest(noisy) AS noisy FROM diffused),
rebuilt AS (SELECT step, noisy, sqrt(alpha) * x + sqrt(1 - alpha) * (sin(x * 37 + step) * 1.4 + CASE WHEN step = 3 THEN 0.01 ELSE 0 END) AS again FROM cells)
SELECT step, bool_and(abs(again - noisy) <= 1e-5 + 1e-5 * abs(noisy)) AS aligned FROM rebuilt GROUP BY step
"""


def mse(spark: SparkSession, sf: str) -> DataFrame:
    """Loss of the clean features as a guess for the noisy ones, per step."""
    loss = diffuse.mean_squared_error(_diffused(spark, sf), "noisy", "features", ["step"])
    return loss.select("step", snap(F.col("mse"), 6).alias("mse"))


MSE_SQL = f"""
WITH {_DIFFUSED_SQL}, cells AS (SELECT step, unnest(noisy) AS a, unnest(f) AS b FROM diffused)
SELECT step, {sql_snap('avg((a - b) * (a - b))')} AS mse FROM cells GROUP BY step
"""


def denoise(spark: SparkSession, sf: str) -> DataFrame:
    """A scorer that predicts half of every noisy value, over Arrow batches; the width comes from the vocabulary."""
    noisy = _diffused(spark, sf).select("p_partkey", "step", "noisy")
    width = _fit(spark, sf)[2].count()
    parts = diffuse.denoise(noisy, "noisy", lambda batch: batch["noisy"].map(lambda a: a * 0.5), len(NUMS), width)

    def labelled(block: str) -> Column:
        return F.transform(block, lambda x, i: F.struct(F.lit(block).alias("block"), i.alias("slot"), snap(x).alias("value")))

    return parts.select("p_partkey", "step", F.inline(F.concat(labelled("nums"), labelled("cats"))))


DENOISE_SQL = f"""
WITH {_DIFFUSED_SQL}
SELECT p_partkey, step, CASE WHEN slot < 2 THEN 'nums' ELSE 'cats' END AS block,
       CAST(CASE WHEN slot < 2 THEN slot ELSE slot - 2 END AS INTEGER) AS slot, {sql_snap('x - x * 0.5')} AS value
FROM (SELECT p_partkey, step, {_SLOT_SQL}, unnest(noisy) AS x FROM diffused)
"""


def random_noise(spark: SparkSession, sf: str) -> DataFrame:
    """Noise drawn for every shipment line: one decimal of its mean and variance is known beforehand."""
    lines = table(spark, sf, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice").alias("key"),
        F.array("l_discount", "l_tax").alias("features"))
    drawn = diffuse.forward_diffuse(lines, "features", 3, seed=7, row_id="key")
    return drawn.select("step", F.explode("noise").alias("e")).groupBy("step").agg(
        F.count("e").alias("n"), snap(F.avg("e"), 1).alias("mean"), snap(F.var_pop("e"), 1).alias("variance"))


RANDOM_SQL = """
SELECT CAST(s AS INTEGER) AS step, 2 * count(*) AS n, 0e0 AS mean, 1e0 AS variance
FROM lineitem, (SELECT unnest(range(0, 3)) AS s) GROUP BY s
"""


def sparse_slots(spark: SparkSession, sf: str) -> DataFrame:
    """Slots of the customers' names, a category with as many values as rows, and of their segments."""
    customer = table(spark, sf, "customer")
    cats = ["c_name", "c_mktsegment"]
    return encode.sparse_slots(customer, cats, encode.fit_vocabulary(customer, cats), "c_custkey")


SPARSE_SQL = """
SELECT c_custkey, 'c_name' AS col, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS idx FROM customer
UNION ALL SELECT c_custkey, 'c_mktsegment', CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) FROM customer
"""

QUERIES = {
    "sparse_slots": (sparse_slots, SPARSE_SQL),
    "fit_scaler": (fit_scaler, FIT_SQL),
    "fit_vocabulary": (fit_vocabulary, VOCAB_SQL),
    "minmax_scale": (minmax_scale, SCALE_SQL),
    "minmax_inverse": (minmax_inverse, INVERSE_SQL),
    "onehot": (onehot, ONEHOT_SQL),
    "onehot_inverse": (onehot_inverse, DECODE_SQL),
    "feature_names": (feature_names, NAMES_SQL),
    "alpha_schedule": (alpha_schedule, ALPHA_SQL),
    "forward_noise": (forward_noise, FORWARD_SQL),
    "recover_noise": (recover_noise, RECOVER_SQL),
    "check_alignment": (check_alignment, ALIGN_SQL),
    "mse": (mse, MSE_SQL),
    "denoise": (denoise, DENOISE_SQL),
    "random_noise": (random_noise, RANDOM_SQL),
}
