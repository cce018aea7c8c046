"""Repeated passages against counting every string."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from terraloom.llm import suffix_dedup


def plain(texts, length=200):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each text, by counting all strings."""
    counts = Counter(d[i:i + length] for d in texts for i in range(len(d) - length + 1))
    out = []
    for d in texts:
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - length + 1):
            if counts[d[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        covered = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        kept = np.frombuffer(d, np.uint8)[~covered].tobytes()
        out.append((len(d), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(df, rows):
    want = sorted(((k, *p) for (k, _), p in zip(rows, plain([(t or "").encode() for _, t in rows]))), key=str)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)
    assert got == want


def passages(seed):
    """Texts with shared passages of many lengths, edited copies, periods and runs."""
    rng = random.Random(seed)
    def prose(n):
        return "".join(rng.choice("abcdefgé \n") for _ in range(n))
    shared = [prose(rng.choice([150, 199, 200, 201, 230, 600])) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(rng.choice([prose(rng.randint(0, 300)), rng.choice(shared), "ab" * rng.randint(0, 200), "x" * rng.randint(0, 300)]))
        rows.append((i, "".join(parts)))
    base = prose(1500)
    for i in range(20):
        at = rng.randint(0, 1499)
        rows.append((100 + i, base[:at] + rng.choice("XYZ") + base[at + 1:]))
    rows.append((200, base + base))
    return rows


@pytest.mark.parametrize(("seed", "hot", "batch"), [(1, 10**9, 10**9), (2, 10**9, 7), (3, 3, 50)])
def test_made_texts(make_docs, seed, hot, batch):
    rows = passages(seed)
    check(suffix_dedup.repeated_passages(make_docs(rows), hot=hot, batch_size=batch), rows)


@pytest.mark.parametrize("unit", ["x", "abcdefgh", "0123456789" * 15])
def test_stretches_of_a_short_period(make_docs, unit):
    """A long stretch keeps few anchors, and its bytes go whether or not another text has them."""
    data = (unit * (1_000_000 // len(unit))).encode()
    found = suffix_dedup.anchors(data)
    kept, first, last = suffix_dedup.without_repeats(data, found)
    assert sum((hi - lo + 200) for lo, hi in zip(kept[1].tolist(), kept[2].tolist())) < 2000 + 4 * len(unit) * 200
    assert len(first) <= 3 and (last - first + 1).sum() >= len(data) - 3 * 200 - 2 * len(unit)
    rows = [(1, unit * (60_000 // len(unit))), (2, "start " + unit * (700 // len(unit)) + " end"), (3, "q" + unit * (199 // len(unit)))]
    check(suffix_dedup.repeated_passages(make_docs(rows)), rows)


def test_whole_table(sf_docs):
    check(suffix_dedup.repeated_passages(sf_docs), [(r.doc_id, r.text) for r in sf_docs.collect()])


def test_awkward_rows(make_docs, awkward):
    rows = [(k, t and t[:3000]) for k, t in awkward] + [(20, "q" * 200), (21, "q" * 199), (22, "r" * 201)]
    check(suffix_dedup.repeated_passages(make_docs(rows, True)), rows)


def test_empty_table(make_docs):
    assert suffix_dedup.repeated_passages(make_docs([])).count() == 0
    assert suffix_dedup.without_repeated_passages(make_docs([])).count() == 0


def test_texts_are_cut(make_docs):
    rng = random.Random(5)
    shared = "é" + "".join(rng.choice("abcdefgh ") for _ in range(250))
    rows = [(1, "first " + shared + " end"), (2, "other " + shared[1:] + "é"), (3, None), (4, "short")]
    out = {r.doc_id: r for r in suffix_dedup.without_repeated_passages(make_docs(rows, True)).collect()}
    # The blank before the passage differs from the second text's, so only the passage without its first letter goes.
    assert out[1].text == "first é end" and out[2].text == "other é"
    assert out[1].n_chars == len(out[1].text) and out[3].text is None and out[4].text == "short"


def test_segments_of_a_long_text(monkeypatch):
    """Anchors of a text searched in segments are those of the whole, but for cuts at segment borders."""
    data = bytes(random.Random(4).choices(b"abcd", k=5000))
    whole = suffix_dedup.anchors(data)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    parts = suffix_dedup.anchors(data)

    def of_start(found):
        return [int(a) for a, lo, hi in zip(*found[:3]) for _ in range(lo, hi + 1)]
    assert of_start(whole) == of_start(parts) and len(of_start(whole)) == 5000 - 199
