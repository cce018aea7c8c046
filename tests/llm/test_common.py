"""Samples, stored steps and the division of labour between the subpackage and the rest."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from terraloom.llm.common import hashed_sample, stored, words
from terraloom.llm.queries import QUERIES


@pytest.mark.parametrize(("rows", "bound"), [(0, 5), (3, 5), (5000, 100), (5000, 5000)])
def test_hashed_sample(spark, rows, bound):
    df = spark.range(rows)
    picked = sorted(r.id for r in hashed_sample(df, "id", bound).collect())
    assert len(picked) <= bound and len(picked) >= min(rows, bound) * 0.9
    assert picked == sorted(r.id for r in hashed_sample(df.repartition(7), "id", bound).collect())


def test_words(spark):
    df = spark.createDataFrame([("  a\tb\n\x0bc d ",), ("",), (None,)], "t string")
    assert [r.w for r in df.select(words(F.col("t")).alias("w")).collect()] == [["a", "b", "c d"], [], []]


def test_stored_steps_end_the_lineage(spark):
    df = stored(spark.range(10).repartition(3).selectExpr("id", "id % 2 AS k").groupBy("k").count(), "step")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and df.count() == 2


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeated_passages", "mix", "pack"]


def test_nothing_else_imports_the_subpackage():
    root = Path(__file__).resolve().parents[2]
    code = "import sys, terraloom.plans as p; p.registered(); sys.exit(any(m.startswith('terraloom.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True).returncode == 0
