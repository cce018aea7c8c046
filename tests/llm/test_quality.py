"""Counted rules against plain counting; ratios against their formula; the verdict against labels."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from terraloom.llm import quality
from tests.llm.conftest import SF_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    tokens = WORD.findall(text)
    windows = Counter(zip(tokens, tokens[1:], tokens[2:]))
    covered = {p for i in range(len(tokens) - 2) if windows[tuple(tokens[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(tokens) < 50 or 100 * len(covered) > 50 * len(tokens)
    return (len(tokens), sum(map(len, tokens)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def counted(df):
    return sorted(((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


def test_whole_table(sf_docs, labels):
    out = quality.quality(sf_docs, labels)
    assert counted(out) == sorted(((r.doc_id, plain(r.text)) for r in sf_docs.collect()), key=str)
    assert out.where("kept AND base_failed").count() == 0


def test_awkward_rows(make_docs, awkward, labels):
    rows = [*awkward, (20, "a b c " * 40), (21, "p q\n\np q\n \np q\nr"), (22, "one # two | <three>"), (23, "w " * 49), (24, " ".join(f"w{i}" for i in range(50)))]
    out = quality.quality(make_docs(rows, True), labels)
    assert counted(out) == sorted(((k, plain(t)) for k, t in rows), key=str)
    assert {r.doc_id: r.kept for r in out.collect()}[24] in (True, False)


def test_empty_tables(make_docs, awkward, labels):
    assert quality.quality(make_docs([]), labels).count() == 0
    out = quality.quality(make_docs([*awkward, (24, " ".join(f"w{i}" for i in range(50)))]), labels.limit(0)).collect()
    assert [r.doc_id for r in out if r.kept] == [24]  # nothing to compare with: the base rules decide


def test_ratios(spark, make_docs):
    """Counts cover every document and both n-gram orders; a document's score is their mean ratio."""
    rows = [(i, f"good{i % 3} fine words here {i}") for i in range(9)] + [(100 + i, "bad stuff all over") for i in range(5)]
    docs = make_docs(rows)
    marked = spark.createDataFrame([(i, 1, 0) for i in range(9)] + [(0, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.fit(docs, marked)
    counts = quality.bucket_counts(docs.selectExpr("text", "doc_id < 100 AS good"), "good").collect()
    grams = [2 * len(t.split()) - 1 for _, t in rows]
    assert sum(r.corpus for r in counts) == sum(grams) and sum(r.target for r in counts) == sum(grams[:9])
    by = {r.bucket: r for r in counts}
    for b in (min(by), max(by)):
        want = math.log((by[b].target + 1) / (sum(grams[:9]) + quality.BUCKETS)) - math.log((by[b].corpus + 1) / (sum(grams) + quality.BUCKETS))
        assert model.values[b] == round(1e6 * want)
    scores = {r.doc_id: r.score for r in quality.judge(docs, model).collect()}
    assert min(scores[i] for i in range(9)) > max(scores[100 + i] for i in range(5))


def test_verdict_follows_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.quality(docs, labels).join(labels, "doc_id").where("NOT base_failed")
    good, bad = out.where("quality = 1"), out.where("quality = 0")
    assert good.where("kept").count() >= 0.98 * good.count()
    assert bad.where("kept").count() <= 0.1 * bad.count()
