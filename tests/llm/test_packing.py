"""Token pieces against whole-text tokenising; plans and places against their rules."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from terraloom.llm import packing
from terraloom.llm.queries import vocabulary


def whole_ids(texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary())
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def check(df, rows):
    want = []
    for (key, *_), ids in zip(rows, whole_ids([r[1] for r in rows])):
        for i, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want.append((key, i, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    out = df.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=str) == sorted(want, key=str)
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences), sum(w[3] for w in want)


def test_whole_table(sf_docs):
    n, tokens = check(packing.pack(sf_docs, vocabulary()), [(r.doc_id, r.text) for r in sf_docs.collect()])
    assert n <= -(-tokens // 2048) * 1.02 + 1


def test_awkward_rows(make_docs, awkward):
    check(packing.pack(make_docs(awkward, True), vocabulary()), awkward)


def test_empty_table(make_docs):
    assert packing.pack(make_docs([]), vocabulary()).count() == 0


def test_words_tokenise_alone():
    """Ids of a text are the ids of its words in a row, whatever the characters."""
    rng = random.Random(1)
    alphabet = "aBé'sß漢İΣς \t\n\r　́ͅ\x00\x1c\x85<|startoftext|>'re don't 12 ½ ﬁ"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    ids = packing.WordIds(vocabulary())
    assert [np.frombuffer(ids.text_ids(t.encode()), "<u4").tolist() + [0] for t in texts] == whole_ids(texts)


def test_added_tokens_are_what_the_plain_call_makes_of_them(make_docs):
    rows = [(1, "hello <|endoftext|> world"), (2, "a<|endoftext|>b <|startoftext|><|startoftext|>, x"), (3, "<|ENDOFTEXT|> <|endo ftext|>"), (4, "\u3000<|endoftext|>\u3000y.")]
    assert whole_ids(["hello <|endoftext|> world"]) == [[3306, 49407, 1002, 0]]
    check(packing.pack(make_docs(rows), vocabulary()), rows)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 10)
    ids = packing.WordIds(vocabulary())
    text = " ".join(f"w{i % 37}" for i in range(500))
    assert ids.text_ids(text.encode()) == packing.WordIds(vocabulary()).text_ids(text.encode())
    assert len(ids.young) <= 47 and len(ids.old) <= 47 and ids.old


@pytest.mark.parametrize("seed", range(8))
def test_plans_place_every_piece(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([8, 64, 2048]))
    counts = np.zeros(capacity + 1, np.int64)
    some = rng.integers(1, capacity + 1, int(rng.integers(1, capacity + 1)))
    counts[some] = rng.integers(1, int(rng.choice([2, 50, 10**9])), len(some))
    kinds = packing.plan(counts)
    used = np.zeros_like(counts)
    for content, number in kinds:
        assert number > 0 and sum(n * m for n, m in content) <= capacity
        for n, m in content:
            used[n] += m * number
    assert (used == counts).all()
    least = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
    assert sum(n for _, n in kinds) <= max(least, int(counts[capacity // 2 + 1:].sum())) * 1.3 + 2


def test_fit_matches_an_exact_mixture():
    """A histogram made of patterns is met almost exactly."""
    rng = np.random.default_rng(0)
    counts = np.zeros(65, np.int64)
    for _ in range(40):
        a, b = sorted(rng.integers(1, 60, 2))
        for part in (a, b - a, 64 - b):
            counts[part] += 1000 if part else 0
    assert sum(n for _, n in packing.plan(counts)) <= 40_000 * 1.005
