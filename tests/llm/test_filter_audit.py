"""The audit against applying every order of the filters document by document."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import pytest

from terraloom.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def fails(rows):
    """Letters that each (key, text) row fails."""
    least = {}
    for key, text in rows:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    for key, text in rows:
        text = text or ""
        words = WORD.findall(text)
        yield "".join(letter for letter, bad in (
            ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 2 * len(text)), ("D", bool(re.search(r"[#$%&*|]", text))),
            ("E", key is not None and key > least[text])) if bad)


def plain(rows, labels):
    good = {k for k, q, _ in labels if q == 1}
    toxic = {k for k, _, t in labels if t == 1}
    docs = [(source or "", key, bad) for (key, _, source), bad in zip(rows, fails([r[:2] for r in rows]))]
    out, shapley = [], Counter()
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[2]]
                left = [d for d in left if letter not in d[2]]
                failing = [d for d in docs if d[0] == part and letter in d[2]]
                shapley[part, letter] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), len(failing) - len(gone), sum(d[2] == letter for d in failing),
                            sum(d[1] in good for d in gone), sum(d[1] in toxic for d in gone)])
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def documents(make_docs, rows):
    return make_docs([(key, text, "en", source) for key, text, source in rows], True)


def check(spark, make_docs, rows, labels, **options):
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = filter_audit.filter_audit(documents(make_docs, rows), table, **options)
    assert got.columns == COLUMNS and dict(got.dtypes)["step"] == "int"
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, labels)


@pytest.fixture(scope="module")
def mixed():
    long = " ".join(f"w{i}" for i in range(220))
    texts = [long, long + " #", "A B C", "", None, "x " * 300, long.upper(), "é" * 9, "a|b", "tab\tand\x0bline\n" * 120]
    return [(i, texts[(i * 7 + i // 5) % 10], ("s1", "s2", None, "")[i % 4]) for i in range(70)]


def test_all_orders(spark, make_docs, mixed):
    check(spark, make_docs, mixed, [(i, i % 2, int(i % 3 == 0)) for i in range(0, 70, 2)] + [(4, 1, 1), (4, 0, None), (5, None, 1), (None, 1, 1), (999, 1, 1)])


@pytest.mark.parametrize("hot", [1, 10**6])
def test_repeated_and_missing_keys(spark, make_docs, awkward, hot):
    rows = [(k, t, "s") for k, t in awkward] + [(None, "", "s")] * 5 + [(5, "y z", "t")] * 6 + [(4, "y z", "s")] * 3 + [(2, "", None)] * 4
    check(spark, make_docs, rows, [(5, 1, 1), (4, 1, 0), (2, 0, 1)], hot_rows=hot)


def test_empty_tables(spark, make_docs, mixed):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.filter_audit(make_docs([]), labels).count() == 0
    check(spark, make_docs, mixed[:6], [])


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_intervals_cover_each_order_once(n):
    orders = list(permutations(range(n)))
    for mask in range(1, 2**n):
        spans = [(step, rank) for m, step, first, end in filter_audit.removal_intervals(n) if m == mask for rank in range(first, end)]
        want = [(min(i for i, f in enumerate(order, 1) if mask >> f & 1), rank) for rank, order in enumerate(orders)]
        assert sorted(spans) == sorted(want)


def test_orders_by_rank(spark):
    from pyspark.sql import functions as F
    got = spark.range(120).select(filter_audit.order_of(F.col("id"), "ABCDE").alias("o"), "id").orderBy("id").collect()
    assert [r.o for r in got] == ["".join(p) for p in permutations("ABCDE")]
