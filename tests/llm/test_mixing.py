"""Source targets, copies and the Pareto order, against the SQL form and simple rules."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from terraloom.llm import mixing
from tests.compare import connect, differences


def plain_targets(sizes):
    """Targets by resharing the excess round after round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        out = {s: 2 * sizes[s] if s in full else rest * weight[s] / free for s in names}
        over = {s for s in names if s not in full and out[s] > 2 * sizes[s]}
        if not over:
            return out
        full |= over


@pytest.mark.parametrize("seed", range(5))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 7, 1000, 50_000]) * rng.randint(1, 9) for s in [None, "", "a", "B", "é", "z9", "zz"][: rng.randint(1, 7)]}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = plain_targets(sizes)
    assert got == pytest.approx(want)


def test_takes_near_the_target(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 90), None, rng.choice(["a", "a", "a", "b", "c", None])) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    out = mixing.mix(docs).collect()
    by = {}
    for r in out:
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        by.setdefault(r.target, [r.source_size, 0])[1] += r.taken
    assert all(abs(taken - target) <= 50 for target, (_, taken) in by.items())
    assert sorted(mixing.mix(docs).collect()) == sorted(out)


@pytest.mark.parametrize("few", [1, 2, 3])
def test_many_sources_are_placed_by_ranges(spark, few):
    rng = random.Random(few)
    sizes = {s: rng.choice([0, 1, 7, 1000, 50_000]) * rng.randint(1, 9) for s in [None, "", "a", "B", "é", "z9", "zz", "b", "c"]}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    assert {r.source: r.target for r in mixing.source_targets(df, few=few).collect()} == pytest.approx(plain_targets(sizes))


def test_rows_of_one_key_are_decided_one_by_one(spark):
    """Ten thousand rows without a key, a third of them equal, and as many of one key: every source comes near its target."""
    rows = [(None, "w " * (1 + i % 7), None, "a") for i in range(7000)] + [(None, "w w w", None, "a")] * 3000 + [(5, "x " * 10, None, "b")] * 10_000
    rows += [(i, "y " * 10, None, "c") for i in range(10, 3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("row", F.lit("x"))
    out = mixing.mix(docs).groupBy("target").agg(F.sum("taken").alias("taken"), F.count("*").alias("n")).collect()
    assert sorted(r.n for r in out) == [2990, 10_000, 10_000] and all(abs(r.taken - r.target) <= 10 for r in out)
    again = mixing.mixed_documents(docs.repartition(7))
    words = again.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()
    assert again.columns == docs.columns and sorted(r.n for r in words) == sorted(r.taken for r in out)


def test_awkward_rows(make_docs, awkward):
    rows = [(*r, None, ["s", None, ""][i % 3]) for i, r in enumerate(awkward)]
    out = mixing.mix(make_docs(rows, True)).collect()
    assert len(out) == len(rows) and all(r.taken <= 2 * r.size for r in out)
    whole = mixing.mixed_documents(make_docs(rows, True))
    assert whole.columns == make_docs(rows, True).columns
    assert whole.count() == sum(r.taken // r.size for r in out if r.size)


def test_empty_table(make_docs):
    assert mixing.mix(make_docs([])).count() == 0 and mixing.mixed_documents(make_docs([])).count() == 0


def test_against_sql(spark, sf_docs, request):
    from tests.llm.conftest import SF_DIR
    assert differences(mixing.mix(sf_docs), connect(SF_DIR), mixing.ORACLE) == []
