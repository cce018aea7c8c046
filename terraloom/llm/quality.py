"""Quality rules: counted base rules, and the likelihood ratio of hashed n-grams, in DataFrame operations only.

Word unigrams and bigrams are hashed into ``BUCKETS`` buckets.  One multinomial is counted over trusted documents, one over
the whole corpus, both smoothed by one.  A document's score is the mean log-likelihood ratio of its n-grams; every
document is compared with one threshold between the scores of good and bad labelled documents, and nothing is drawn at random.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.llm.common import hashed_sample, stored, words

BUCKETS = 16_384
LABELLED = 20_000  # bound of the sample of labelled documents, good and bad each
GOOD_QUANTILE = 0.005  # of the good documents' scores; the threshold never lies above it
BAD_QUANTILE = 0.9  # of the bad ones'; where that is lower, the threshold lies half-way
UNIT = 1_000_000  # ratios are summed as whole millionths, so that the order of adding does not matter
LEAST_WORDS = 50
SYMBOLS = "[#*$%&|<>]"
HAS_WORD = "[^\\x20\\x09-\\x0D]"


@dataclass(frozen=True)
class Ratios:
    """Log-likelihood ratio of each bucket in millionths, and the least mean that passes."""

    values: list[int]
    least: float


def _bucket(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")


def _followed(tokens: Column) -> Column:
    """Pairs of each word and the next; the last word's partner is null."""
    return F.arrays_zip(tokens.alias("w"), F.slice(tokens, F.lit(2), F.greatest(F.size(tokens), F.lit(1))).alias("v"))


def bucket_counts(docs: DataFrame, flag: str, text: str = "text") -> DataFrame:
    """``bucket``, ``target`` and ``corpus`` counts of all n-grams; target counts those of rows whose flag is set.

    A word's bucket is counted once, and a pair's once if there is a next word.
    """
    pairs = (
        docs.select(F.col(flag).alias("flag"), words(F.col(text)).alias("tokens"))
        .select("flag", F.explode(_followed(F.col("tokens"))).alias("pair"))
    )
    grams = pairs.select("flag", F.explode(F.array(
        _bucket(F.col("pair.w")), F.when(F.col("pair.v").isNotNull(), _bucket(F.col("pair.w"), F.col("pair.v"))))).alias("bucket"))
    return grams.where("bucket IS NOT NULL").groupBy("bucket").agg(
        F.sum(F.when(F.col("flag"), 1).otherwise(0).cast("bigint")).alias("target"), F.count("*").alias("corpus"))


def labelled(labels: DataFrame, key: str = "doc_id", bound: int = LABELLED) -> DataFrame:
    """``_labelled``, ``quality`` and ``toxic``: at most ``bound`` keys of either quality, spread over all by a hash.

    Of several labels of one key the worse counts.
    """
    each = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_labelled")).agg(
        F.min("quality").alias("quality"), F.max(F.coalesce(F.col("toxic"), F.lit(0))).alias("toxic"))
    return hashed_sample(each.where("quality = 1"), "_labelled", bound).union(hashed_sample(each.where("quality = 0"), "_labelled", bound))


def mean_ratio(tokens: Column, values: list[int]) -> Column:
    """Mean ratio of the n-grams of a word array; null without words."""
    table = F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")  # folded to one constant
    each = F.transform(_followed(tokens), lambda p: F.get(table, _bucket(p["w"])) + F.when(
        p["v"].isNotNull(), F.get(table, _bucket(p["w"], p["v"]))).otherwise(F.lit(0).cast("bigint")))
    total = F.aggregate(each, F.lit(0).cast("bigint"), lambda a, x: a + x)
    n = F.size(tokens).cast("bigint") * 2 - 1
    return F.when(n > 0, total.cast("double") / (n * UNIT))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", bound: int = LABELLED) -> Ratios:
    """Counts over all documents; the target and the threshold come from a bounded sample of the labelled ones.

    The target is the good documents that are not toxic.  Without any, every score is 0 and passes.
    """
    sample = F.broadcast(labelled(labels, key, bound))
    marked = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(sample, F.col("_key") == F.col("_labelled"), "left")
    counts = bucket_counts(marked.withColumn("_flag", F.expr("coalesce(quality = 1 AND toxic = 0, false)")), "_flag", "_text").collect()
    by_bucket = {r.bucket: (r.target, r.corpus) for r in counts}
    target, corpus = (sum(c[i] for c in by_bucket.values()) for i in (0, 1))
    if not target:
        return Ratios([0] * BUCKETS, 0.0)

    def ratio(bucket):
        t, c = by_bucket.get(bucket, (0, 0))
        return round(UNIT * (math.log((t + 1) / (target + BUCKETS)) - math.log((c + 1) / (corpus + BUCKETS))))

    values = [ratio(b) for b in range(BUCKETS)]
    scores = (
        marked.where("_labelled IS NOT NULL").select("quality", words(F.col("_text")).alias("tokens"))
        .where(F.size("tokens") >= LEAST_WORDS).select("quality", mean_ratio(F.col("tokens"), values).alias("score"))
    )
    good, bad = scores.agg(
        F.percentile(F.when(F.col("quality") == 1, F.col("score")), GOOD_QUANTILE),
        F.percentile(F.when(F.col("quality") == 0, F.col("score")), BAD_QUANTILE)).first()
    if good is None:
        return Ratios(values, min(values) / UNIT)
    return Ratios(values, (good + bad) / 2 if bad is not None and bad < good else good)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``_tokens`` and the counted columns to documents."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(HAS_WORD))
    counted = docs.withColumn("_tokens", words(F.col(text))).withColumns({
        "n_words": F.size("_tokens").cast("bigint"),
        "word_chars": F.char_length(F.array_join("_tokens", "")).cast("bigint"),
        "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("bigint"),
        "_lines": lines,
    }).withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint")).drop("_lines")
    return _with_repeats(counted)


def _with_repeats(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words in three-word windows that occur twice or more in the text, first occurrences included.

    Windows are sorted as hashes with their position in the low bits, so that equal ones become neighbours; neighbours with
    equal hashes are then compared word by word.
    """
    at = "get(_tokens, {0}) = get(_tokens, {1}) AND get(_tokens, {0} + 1) = get(_tokens, {1} + 1) AND get(_tokens, {0} + 2) = get(_tokens, {1} + 2)"
    here, there = "int(x & _mask)", "int(get(_sorted, {0}) & _mask)"
    same = (
        "(shiftright(x, _bits) = shiftright(get(_sorted, {0}), _bits) AND " + at.format(here, there) + ")")
    return (
        df.withColumn("_bits", F.ceil(F.log2(F.greatest(F.size("_tokens"), F.lit(2)).cast("double"))).cast("int"))
        .withColumn("_mask", F.expr("shiftleft(1L, _bits) - 1L"))
        .withColumn("_sorted", F.expr(
            "sort_array(CASE WHEN size(_tokens) >= 3 THEN transform(sequence(0, size(_tokens) - 3), i -> "
            "shiftleft(xxhash64(get(_tokens, i), get(_tokens, i + 1), get(_tokens, i + 2)), _bits) | bigint(i)) "
            "ELSE cast(array() AS array<bigint>) END)"))
        .withColumn("_found", F.expr(
            "sort_array(transform(filter(_sorted, (x, i) -> coalesce(" + same.format("i + 1") + ", false) OR "
            "(i > 0 AND coalesce(" + same.format("i - 1") + ", false))), x -> x & _mask))"))
        .withColumn("n_repeat_words", F.expr(
            "aggregate(transform(_found, (p, i) -> least(3L, coalesce(get(_found, i + 1) - p, 3L))), 0L, (a, x) -> a + x)"))
        .drop("_bits", "_mask", "_sorted", "_found")
    )


def judge(docs: DataFrame, ratios: Ratios, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, ``base_failed``, ``score`` and ``kept`` of every document, as a stored table.

    It is stored because a later filter on its columns would be pushed down with the expressions behind them, once per use.
    A null text has no words and fails; a text of one word has no pair; null keys and repeated rows are judged like any other; no
    documents give no rows.
    """
    measured = measures(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = (
        measured.withColumn("score", mean_ratio(F.col("_tokens"), ratios.values)).withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(0.0)) >= F.lit(ratios.least)))
        .select(F.col("_key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
    )
    return stored(judged, "quality")


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    return judge(docs, fit(docs, labels, key, text, **options), key, text)
