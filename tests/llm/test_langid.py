"""Language identification: best paths against an exhaustive search, held-out accuracy, awkward rows."""

from __future__ import annotations

import zlib
from itertools import product

import numpy as np
import pytest

from terraloom.llm import langid


@pytest.mark.parametrize("seed", range(5))
def test_best_paths(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, 7, 6)
    scores = rng.normal(0, 5, (int(sizes.sum()), 3)).astype(np.float32)
    starts = np.cumsum(sizes) - sizes
    path = langid.best_paths(scores, starts, sizes, 4.0)
    for start, size in zip(starts, sizes):
        def worth(labels):
            return sum(float(scores[start + i, l]) for i, l in enumerate(labels)) - 4.0 * sum(a != b for a, b in zip(labels, labels[1:]))
        best = max(map(worth, product(range(3), repeat=int(size)))) if size else 0
        assert worth(path[start:start + size].tolist()) == pytest.approx(best, abs=1e-4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count()
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    tested = [r for r in out if r.held_out]
    assert sum(r.lang == r.lang_pred for r in tested) >= 0.97 * len(tested)


TRAINING = [(i, t, lang) for i in range(1000, 1040) for t, lang in (
    ("the cat and the dog with them", "en"), ("der hund und die katze mit ihnen", "de"), ("кошка и собака с ними", "ru"))]


def test_spans_of_mixed_text(make_docs):
    model = langid.train(make_docs(TRAINING))
    text = "the dog and the cat with the dog — 12 der hund und die katze und der hund кошка и собака"
    found = langid.spans(make_docs([(1, text), (2, "..."), (3, None), (4, "the cat")]), model).collect()
    assert [(r.doc_id, r.first_word, r.end_word, r.lang) for r in found] == [
        (1, 0, 8, "en"), (1, 8, 18, "de"), (1, 18, 21, "ru"), (2, 0, 1, "de"), (4, 0, 2, "en")]
    out = {r._row.doc_id: (r.lang_pred, r.score) for r in langid.identified(make_docs([(1, text), (2, "..."), (3, None)]), model).collect()}
    assert out[2] == out[3] == ("und", 0.0) and out[1][0] == "de" and 0.3 < out[1][1] < 0.5


def test_labels_of_predicted_rows_are_not_used(make_docs):
    """Changing the labels, sources and ids of held-out documents changes no prediction."""
    held = [i for i in range(100, 400) if zlib.crc32(str(i).encode()) % 4 == 2][:9]
    extra = [(i, TRAINING[i % 3][1], TRAINING[i % 3][2]) for i in held]
    wrong = [(i, t, "xx", "s") for i, t, _ in extra]
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in langid.languages(make_docs(TRAINING + rows)).collect()} for rows in (extra, wrong))
    assert a == b and {x for x, _ in a.values()} == {"en", "de", "ru"}


def test_awkward_rows(make_docs, awkward):
    rows = [(k, t, "en" if t and "alpha" in t else None) for k, t in awkward]
    docs = make_docs([*rows, *TRAINING], True)
    out = langid.languages(docs).collect()
    assert len(out) == len(rows) + len(TRAINING)
    assert all(r.lang_pred == "und" and r.score == 0 for r in out if r.doc_id in (2, 3))
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.lang_pred != "und" for r in out)


def test_empty_tables(make_docs):
    assert langid.languages(make_docs([])).count() == 0
    unlabelled = langid.languages(make_docs([(1, "some words"), (2, None)])).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in unlabelled} == {(1, "und", 0.0), (2, "und", 0.0)}
