"""The hidden Markov model against sums over all paths, plain counting and held-out likelihood."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from terraloom.llm import hmm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def random_model(rng, states=3, size=5):
    def rows(a):
        return a / a.sum(axis=-1, keepdims=True)
    return hmm.Model(rows(rng.random(states)), rows(rng.random((states, states))), rows(rng.random((states, size))).T)


def paths(model, doc):
    for path in product(range(len(model.start)), repeat=len(doc)):
        p = model.start[path[0]] * model.emit[doc[0], path[0]]
        for a, b, x in zip(path, path[1:], doc[1:]):
            p *= model.step[a, b] * model.emit[x, b]
        yield path, p


@pytest.mark.parametrize("seed", range(4))
def test_recursions_match_all_paths(seed):
    rng = np.random.default_rng(seed)
    model = random_model(rng)
    docs = [rng.integers(0, 5, n) for n in rng.integers(1, 6, 7)]
    values, sizes = np.concatenate(docs), np.array([len(d) for d in docs])
    stepped, order, active, at = hmm.by_step(values, sizes)
    like = np.empty(len(docs))
    like[order] = hmm.forward(model, stepped, active, at, False)[0]
    assert like == pytest.approx([math.log(sum(p for _, p in paths(model, d))) for d in docs])
    starts, steps, emissions = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for d in docs:
        whole = sum(p for _, p in paths(model, d))
        for path, p in paths(model, d):
            starts[path[0]] += p / whole
            for a, b in zip(path, path[1:]):
                steps[a, b] += p / whole
            for x, s in zip(d, path):
                emissions[x, s] += p / whole
    got = [np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))]
    assert hmm.expected_counts(model, values, sizes, got) == pytest.approx(like.sum())
    for a, b in zip(got, (starts, steps, emissions)):
        assert a == pytest.approx(b, rel=1e-4, abs=1e-5)


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*WORD.findall(low), None]


def check_base(out, rows):
    kept = [(k, t) for k, t, *_ in rows if k is not None and zlib.crc32(str(k).encode()) % 10]
    counts = Counter(x for _, t in kept for x in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((
        (k, k is None or zlib.crc32(str(k).encode()) % 10 == 0, len(tokens(t)), sum(x in counts for x in tokens(t)), total,
         round(sum(math.log10((counts[x] + .1) / (total + .1 * (distinct + 1))) for x in tokens(t)), 5)) for k, t, *_ in rows), key=str)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out), key=str) == want


def test_whole_table(sf_docs):
    """A small head sends most words through the join; counts and base scores stay exact, and held-out text gets likelier."""
    out = hmm.scores(sf_docs, head=300).collect()
    check_base(out, [(r.doc_id, r.text) for r in sf_docs.collect()])
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("head", [0, 2, 100])
def test_awkward_rows(make_docs, awkward, head):
    rows = [*awkward, (11, "Alpha BETA gamma É"), (12, "y" * 5000), (30, "never seen words")]
    out = hmm.scores(make_docs(rows, True), head=head, most=2).collect()
    check_base(out, rows)
    assert all(r.score < 0 for r in out)


def test_empty_tables(make_docs):
    assert hmm.scores(make_docs([]), most=1).count() == 0
    held = [i for i in range(99) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    out = hmm.scores(make_docs([(held[0], "a b"), (held[1], None)])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in sorted(out)] in ([(3, 0, 0), (1, 0, 0)], [(1, 0, 0), (3, 0, 0)])


def test_classes_agree(spark):
    words = [b"", b"a", b"ab", b"abc", b"abcd", "naïveté".encode(), b"\xff\xfe\xfd\xfc"]
    df = spark.createDataFrame([(w,) for w in words], "w binary")
    got = [r.c for r in df.select(hmm.class_column(df.w).alias("c")).collect()]
    assert got == [hmm.class_of(w) for w in words]


def test_rounds_raise_the_likelihood(spark, sf_docs):
    rows = sf_docs.limit(50)
    counts = hmm.token_counts(rows.selectExpr("cast(text AS binary) AS data"))
    known = hmm.symbols(counts, 200)
    coded = hmm.encoded(rows, known, "doc_id", "text")
    model, likes = hmm.first_model(known.unigram, 4), []
    for _ in range(4):
        model, like = hmm.baum_welch(coded, model, known.unigram)
        likes.append(like)
    assert likes == sorted(likes)
    assert known.unigram.sum() == pytest.approx(1) and model.emit.sum(axis=0) == pytest.approx(np.ones(4))


@pytest.mark.parametrize("share", [1, 8])
def test_last_rounds_read_every_training_document_until_they_settle(spark, monkeypatch, share):
    rows = spark.range(5000).selectExpr("id AS rid", "id % 10 = 0 AS held_out", "1L AS n_tokens", "unhex('00000000') AS symbols")
    read, likes = [], iter([-9.0, -9.0] * (share > 1) + [-100.0, -60.0, -50.0, -49.99, -1.0])

    def round_of(data, model, unigram):
        read.append(data.count())
        return model, next(likes)

    monkeypatch.setattr(hmm, "baum_welch", round_of)
    hmm.train(rows, np.array([0.5, 0.5]), 2, share)
    assert read[-4:] == [4500] * 4 and len(read) == 4 + 2 * (share > 1)
    assert all(400 < n < 700 for n in read[:-4])


def test_scores_are_those_of_the_model(spark, sf_docs):
    """The operator's score of each text is the forward recursion of its own model over classes, times each rare token's share of its class."""
    fitted = {}
    original = hmm.train

    def keep(*args, **kwargs):
        fitted["model"] = original(*args, **kwargs)
        return fitted["model"]

    docs = [(r.doc_id, r.text) for r in sf_docs.limit(60).collect()]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    hmm.train, out = keep, None
    try:
        out = {r.doc_id: r.score for r in hmm.scores(frame, head=40).collect()}
    finally:
        hmm.train = original
    model = fitted["model"]
    counts = Counter(x for k, t in docs if zlib.crc32(str(k).encode()) % 10 for x in tokens(t))
    kept = hmm.symbols(hmm.token_counts(frame.where(~hmm.held_out(frame.doc_id)).selectExpr("cast(text AS binary) AS data")), 40)
    for key, text in docs:
        alpha, total = model.start, 0.0
        for i, token in enumerate(tokens(text)):
            raw = b"" if token is None else token.encode()
            number = kept.numbers.get(raw)
            if number is None:
                at = hmm.class_of(raw)
                total += math.log10((counts[token] + hmm.ADDED) / kept.class_totals[at])
                number = len(kept.counts) + at
            alpha = (alpha if i == 0 else alpha @ model.step) * model.emit[number]
            total += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
        assert out[key] == pytest.approx(total, abs=1e-6)


def test_runs_cover_every_token():
    for sizes in ([1], [3, 8, 16, 17, 1], [4, 4], [40]):
        runs = hmm.training_runs(np.zeros(sum(sizes), int), np.array(sizes), 8)
        assert runs.sum() == sum(sizes) and runs.max() <= 8 and set(np.cumsum(sizes)) <= set(np.cumsum(runs))
