"""Merkle fingerprints against a tree built text by text, and the order of documents against sorting them."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terraloom.llm import merkle

BLANK, WORD = "[\x20\x09-\x0D]", "[^\x20\x09-\x0D]"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def first_leaves(paragraph):
    """Up to sixteen words that something follows, one by one, then leaves as elsewhere."""
    head = re.match(f"{BLANK}*(?:{WORD}+{BLANK}+){{0,16}}", paragraph)[0]
    return re.findall(f"{WORD}+{BLANK}*|{BLANK}+", head) + leaves(paragraph[len(head):])


def leaves(paragraph):
    """Runs of up to eight words, ending at a word with closing punctuation; blanks that nothing precedes are a leaf."""
    out, words, start = [], 0, 0
    tokens = [(m.start(), m.end()) for m in re.finditer(f"{WORD}+{BLANK}*", paragraph)]
    if not tokens:
        return [paragraph] if paragraph else []
    if tokens[0][0]:
        out.append(paragraph[:tokens[0][0]])
        start = tokens[0][0]
    for a, b in tokens:
        words += 1
        if words == 8 or re.search("[.,;:!?]$", re.sub(f"{BLANK}+$", "", paragraph[a:b])):
            out.append(paragraph[start:b])
            words, start = 0, b
    return out + ([paragraph[start:]] if start < len(paragraph) else [])


def tree(text):
    """Fingerprint and leaves of a text."""
    sections, everything = [], []
    for section in re.split(r"(?<=\n\n)(?=[^\n])", text) if text else []:
        paragraphs = []
        for paragraph in re.split(r"(?<=\n)(?=[^\n])", section):
            found = leaves(paragraph) if everything else first_leaves(paragraph)
            everything += found
            paragraphs.append((sha("".join(sha(x) for x in found)), "".join("." + sha(x)[:8] + str(len(x)) for x in found)))
        sections.append((sha("".join(d for d, _ in paragraphs)), "".join(";" + d[:8] + t for d, t in paragraphs)))
    return sha("".join(d for d, _ in sections))[:32] + "".join("|" + d[:8] + t for d, t in sections), everything


def near(a, b):
    total = sum(map(len, a)) + sum(map(len, b))
    return 2 * sum(len(x) * n for x, n in (Counter(a) & Counter(b)).items()) / total if total else 1.0


def plain(rows):
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, sha(r[1])), reverse=True)
    out = []
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        k = len(text) // 3
        edited = text[:len(text) - k] + after[:k]
        (a, x), (b, y) = tree(text), tree(edited)
        start = None
        if a[:32] != b[:32]:
            same = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            start = sum(map(len, x[:same]))
        out.append((key, len(text), sha(edited), a, b, near(x, y), near(x, tree(after)[1]), start))
    return sorted(out, key=str)


def check(df, rows):
    assert sorted((tuple(r) for r in df.collect()), key=str) == plain(rows)


def made(seed, n=40):
    rng = random.Random(seed)
    words = ["alpha", "é,", "b.", "漢字", "x!y", "...", "d", "long" * 30]
    def text():
        return "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\n", "\n\n", "\t\n\n\n", "\x0b"]) for _ in range(rng.randint(0, 60)))
    return [(i * 3 % 101, rng.choice(["", " ", "\n"]) + text() + rng.choice(["", "end"])) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_made_texts(make_docs, seed):
    rows = made(seed)
    check(merkle.fingerprints(make_docs(rows, True), bucket_bytes=500), rows)


def test_whole_table(sf_docs):
    check(merkle.fingerprints(sf_docs), [(r.doc_id, r.text) for r in sf_docs.collect()])


@pytest.mark.parametrize("hot", [1, 10**6])
def test_awkward_rows(make_docs, awkward, hot):
    rows = [*awkward, *[(5, f"text {i} of key five") for i in range(60)], *[(None, f"no key {i % 7}") for i in range(40)], *[(50, "the same")] * 50]
    check(merkle.fingerprints(make_docs(rows, True), bucket_bytes=40, hot=hot), rows)


def test_few_rows(make_docs):
    assert merkle.fingerprints(make_docs([])).count() == 0
    for rows in ([(1, "a b c")], [(1, None)], [(None, "x\ny")], [(2, "same"), (1, "same")]):
        check(merkle.fingerprints(make_docs(rows)), rows)


def test_edits_are_found(make_docs):
    """An edit leaves the branches before it alone, and later filters do not unfold the expressions."""
    lines = [f"line {i} has some words, and a few more words of its own.\n" + "\n" * (i % 4 == 3) for i in range(20)]
    changed = [*lines[:9], "another line stands here\n", *lines[10:]]
    df = make_docs([(1, "".join(lines))]).select(F.col("text").alias("a")).withColumn("b", F.lit("".join(changed)))
    df = merkle.with_fingerprint(merkle.with_fingerprint(df, "a", "fa"), "b", "fb")
    row = merkle.with_edit_start(merkle.with_likeness(df, "fa", "fb", "near"), "fa", "fb", "start").first()
    assert row.start == sum(map(len, lines[:9])) and 0.9 < row.near < 1
    assert merkle.fingerprints(make_docs(made(3, 9))).where("near_edited > 2 AND near_next > edit_start").count() == 0
