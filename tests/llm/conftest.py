from __future__ import annotations

import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text[, lang[, source]]) tuples, with columns whose names clash with inner ones."""
    clashing = ["key", "fp", "root", "size", "words", "rank", "shard", "data", "digest", "row", "bin", "copies", "draw", "value"]

    def build(rows, extra=False):
        full = [(*r, *(None,) * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        return df.selectExpr("*", *[f"'x' AS `{c}`" for c in clashing]) if extra else df
    return build


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "alpha beta gamma delta"), (5, "alpha beta gamma delta"), (5, "alpha beta gamma delta"),
    (6, "one"), (7, "x " * 30_000), (8, "é ß 漢字 \x00 z"), (9, "alpha beta gamma delta"),
]


@pytest.fixture(scope="session")
def awkward():
    return AWKWARD
