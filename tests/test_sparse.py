"""Sparse features against dense ones, digest trees against the full comparison, scatter samples against sorting."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from terraloom.operators import compare, encode, profile, sparse


@pytest.fixture(scope="module")
def people(spark):
    rows = [(i, float(i % 7), f"name {i}", ("a", "b", None, "c")[i % 4]) for i in range(60)]
    return spark.createDataFrame(rows, "id int, age double, name string, kind string")


@pytest.mark.parametrize("hot", [10**6, 3])
def test_round_trip(people, rows, hot):
    scaler, vocabulary = encode.fit_scaler(people, ["age"]), encode.fit_vocabulary(people, ["name", "kind"])
    triples = sparse.encode(people, "id", ["age"], ["name", "kind"], scaler, vocabulary, hot)
    assert triples.count() == 60 * 3 - 15  # a missing category has no triple
    back = sparse.decode(triples, ["id"], ["age"], ["name", "kind"], scaler, vocabulary, hot_rows=hot)
    assert rows(back.withColumn("age", F.round("age", 9))) == rows(people)
    noisy = sparse.add_noise(triples, "id", 3)
    again = sparse.add_noise(triples.repartition(7), "id", 3)
    assert rows(noisy) == rows(again)
    found = sparse.recover(noisy.where("step < 2"), "id")
    assert found.where("abs(recovered - value) > 1e-9").count() == 0 and found.count() == 2 * triples.count()


def test_noisy_best_looks_at_every_slot(people, spark):
    """The best slot of a noisy block, missing slots included, is that of the dense block."""
    vocabulary = encode.fit_vocabulary(people, ["kind"])
    triples = sparse.encode(people.where("kind IS NOT NULL"), "id", [], ["kind"], None, vocabulary)
    widths = vocabulary.groupBy("col").agg(F.count("*").alias("width"))
    noisy = sparse.add_noise(triples, "id", 4)
    at = sparse.hashed_noise()
    dense = noisy.withColumnRenamed("idx", "here").withColumn("idx", F.explode(F.array(*map(F.lit, range(3))))).withColumn(
        "x", F.when(F.col("idx") == F.col("here"), F.col("signal")).otherwise(0.0) + F.col("spread") * at(F.col("id"), F.col("step"), F.col("col"), F.col("idx")))
    want = {}
    for r in dense.orderBy("idx").collect():
        if (r.id, r.step) not in want or r.x > want[r.id, r.step][1]:
            want[r.id, r.step] = (r.idx, r.x)
    got = {(r.id, r.step): (r.idx, r.value) for r in sparse.noisy_best(noisy, "id", widths).collect()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1]) for k in want)


def test_best_slots_hold_numbers_only(spark, rows):
    """The first slot of equal values, nulls last, and no task sorts the rows to find it."""
    triples = [(1, "a", 4, 2.0), (1, "a", 3, 2.0), (1, "a", 2, 1.0), (1, "a", 9, None), (2, "a", 7, None), (2, "a", 6, None), (2, "b", 5, -1.0), (None, "a", 8, 0.5), (None, "a", 8, 0.5)]
    df = spark.createDataFrame(triples, "id int, col string, idx int, value double")
    best = sparse.best_slots(df, ["id"])
    assert rows(best, "id", "col", "idx", "value") == rows(spark.createDataFrame([(1, "a", 3, 2.0), (2, "a", 6, None), (2, "b", 5, -1.0), (None, "a", 8, 0.5)], df.schema))
    noisy = sparse.add_noise(df, "id", 3)
    plan = sparse.noisy_best(noisy, "id", df.select("col", F.lit(3).alias("width")).distinct())._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_unseen_category(people):
    scaler, vocabulary = encode.fit_scaler(people, ["age"]), encode.fit_vocabulary(people.where("id < 5"), ["name"])
    with pytest.raises(Exception, match="unseen category"):
        sparse.encode(people, "id", ["age"], ["name"], scaler, vocabulary).collect()


def test_tree_diff(spark, rows):
    left = spark.range(500).selectExpr("id", "if(id % 9 = 0, null, id * 2) AS a", "concat('x', id) AS b").union(spark.sql("SELECT null, 1L, 'n'"))
    right = left.where("id IS NULL OR id <> 77").selectExpr("id", "if(id = 18, 5, if(id = 20, null, a)) AS a", "if(id = 300, 'y', b) AS b").union(spark.sql("SELECT 900L, 1L, 'new'"))
    assert rows(compare.tree_diff(left, right, ["id"])) == rows(compare.frame_diff(left, right, ["id"]))
    keyed = left.where("id IS NOT NULL")
    assert compare.tree_diff(keyed, keyed.repartition(5), ["id"]).count() == 0
    trees = [compare.digest_tree(df, ["id"]).checkpoint() for df in (left, right)]
    assert compare.differing_leaves(*trees).count() <= 5  # of 500 rows, five keys differ
    assert rows(compare.tree_diff(left, right, ["id"], left_tree=trees[0], right_tree=trees[1])) == rows(compare.frame_diff(left, right, ["id"]))


def test_nulls_count_in_digests(spark):
    """A hash passes over nulls: (1, null) and (null, 1) must not look alike."""
    a, b = (spark.sql(f"SELECT 1 AS id, {x} AS a, {y} AS b") for x, y in (("1", "CAST(null AS INT)"), ("CAST(null AS INT)", "1")))
    assert compare.tree_diff(a, b, ["id"]).count() == 2


def test_scatter_sample(spark):
    points = [(i, float(i * i % 997), None if i % 50 == 0 else float(i % 13), float("inf") if i % 60 == 1 else 1.0) for i in range(400)]
    df = spark.createDataFrame(points, "id int, x double, z double, y double")
    got = {(r.col, r.x_bin, r.id, r.x) for r in profile.scatter_sample(df, "y", ["x", "z"], "id", 5, 4).collect()}
    want = set()
    for col, at in (("x", 1), ("z", 2)):
        drawn = [(p[0], p[at]) for p in points if p[at] is not None and p[3] == 1.0]
        low, high = min(v for _, v in drawn), max(v for _, v in drawn)
        bins = {}
        for i, v in drawn:
            bins.setdefault(min(int((v - low) * 4 / (high - low)) + 1, 4), []).append((hashlib.md5(f"{col}:{i}".encode()).hexdigest(), i, v))
        want |= {(col, b, i, v) for b, members in bins.items() for _, i, v in sorted(members)[:5]}
    assert got == want
