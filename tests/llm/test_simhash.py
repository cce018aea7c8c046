"""SimHash near-duplicates against a comparison of all pairs."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from terraloom.llm import simhash
from terraloom.llm.graph import components


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, distance=2):
    """Group number of each value, by comparing all pairs."""
    values = np.array(values, np.uint64)
    group = list(range(len(values)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= distance) + i + 1:
            a, b = top(i), top(int(j))
            group[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(values))]


def check(df, rows):
    texts = [(r[0], plain_fingerprint(r[1])) for r in rows]
    groups = plain_components([fp for _, fp in texts])
    least = {}
    for (key, _), g in zip(texts, groups):
        if key is not None:
            least[g] = min(least.get(g, key), key)
    want = sorted(((k, f"{fp:016x}", least.get(g)) for (k, fp), g in zip(texts, groups)), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str) == want


def test_whole_table(sf_docs):
    check(simhash.near_duplicates(sf_docs, shard=40), [(r.doc_id, r.text) for r in sf_docs.collect()])


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_rows(make_docs, awkward, extra):
    check(simhash.near_duplicates(make_docs(awkward, extra)), awkward)


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0
    assert simhash.without_near_duplicates(make_docs([])).count() == 0


def test_one_of_each_group_stays(make_docs, awkward):
    docs = make_docs(awkward, True)
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5, 6, 7, 8]


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_tree_search_finds_all_links(shards):
    """Clusters, chains and loose values: shards with guests give the components of all pairs."""
    random = np.random.default_rng(shards)
    centres = random.integers(0, 2**63, 60).astype(np.uint64)
    flips = np.uint64(1) << random.integers(0, 64, (60, 40, 3)).astype(np.uint64)
    near = centres[:, None] ^ np.bitwise_xor.reduce(flips, axis=2)
    values = np.unique(np.concatenate([near.ravel(), random.integers(0, 2**63, 500).astype(np.uint64)]))
    tree = simhash.Tree(values[::3], shards, 2)
    copies = {}
    for shard, rows, home in tree.route(values):
        copies.setdefault(shard, []).append((rows, home))
    whole = simhash.Forest(len(values))
    homes = 0
    for parts in copies.values():
        rows, home = (np.concatenate(x) for x in zip(*parts))
        own = simhash.Forest(len(rows))
        simhash.PAIRS, kept = 1000, simhash.PAIRS
        simhash.search(values[rows], np.flatnonzero(home), np.flatnonzero(~home), 2, own)
        simhash.PAIRS = kept
        whole.unite(rows, rows[own.parent])
        homes += home.sum()
    assert homes == len(values)
    want = plain_components(values)
    assert len(set(zip(whole.parent.tolist(), want))) == len(set(want)) == len(set(whole.parent.tolist()))


def test_components_of_a_chain(spark):
    edges = spark.range(300).selectExpr("id * 7919 % 601 AS a", "(id + 1) * 7919 % 601 AS b").unionByName(spark.createDataFrame([(9999, 9999)], "a bigint, b bigint"))
    found = components(edges)
    assert found.count() == 301 and found.select("root").distinct().count() == 1
