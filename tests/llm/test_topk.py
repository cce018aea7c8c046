"""Bit-sliced top-k against full products."""

from __future__ import annotations

import numpy as np
import pytest

from terraloom.llm import topk
from tests.compare import connect, differences
from tests.llm.conftest import SF_DIR


@pytest.mark.parametrize("seed", range(6))
def test_block_search(seed):
    rng = np.random.default_rng(seed)
    n, dim = int(rng.integers(1, 700)), int(rng.integers(1, 20))
    wide = int(rng.choice([1, 3, 1000, 2**25, 2**56]))
    matrix = rng.integers(-wide, wide + 1, (n, dim))
    matrix[: n // 2] = matrix[0]  # many ties
    ids = np.sort(rng.integers(-50, 2000, n))
    slices, bits, low = topk.slice_block(matrix)
    assert low == matrix.min()
    for query in [matrix[-1], -matrix[0], np.zeros(dim, np.int64), rng.integers(-9, 9, dim)]:
        own = int(ids[rng.integers(0, n)])
        for low_bits in (0, 4, 40):
            got = topk.search_block(ids, matrix, slices, bits, own, query, 10, low_bits)
            scores = matrix.astype(object) @ query.astype(object)
            want = sorted((-s, i) for i, s in zip(ids.tolist(), scores.tolist()) if i != own)[:10]
            assert list(zip((-got[1]).tolist(), got[0].tolist())) == want


def test_unsound_vectors_take_no_part(spark):
    rows = [
        (0, [1.0, 0.5]), (1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]),
        (6, [0.5, 0.5]), (6, [0.5, 0.5]), (7, [0.5, 0.5]), (8, [1.0, 2.0, 3.0]), (9, [1e30, 1.0]), (10, [float('-inf'), 1.0]), (100, [-1.0, 0.0001]), (200, None),
    ]
    df = spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], "vec_id bigint, embedding array<float>, label int, id string, block string, score string")
    got = topk.top_k(df, df.where("vec_id % 100 = 0"), k=3, block=2).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [
        (0, 1, 6, 786432), (0, 2, 6, 786432), (0, 3, 7, 786432),
        (100, 1, 6, -524288), (100, 2, 6, -524288), (100, 3, 7, -524288)]
    assert topk.top_k(df.limit(0), df).count() == topk.top_k(df, df.limit(0)).count() == 0


def test_large_components(spark):
    """Large but finite components take part; scores beyond 64 bits are ranked exactly; empty vectors meet each other."""
    rows = [(0, [1.0, 1.0]), (1, [70000.0, 1.0]), (2, [3.0, 4.0]), (3, [1e12, 1.0]), (4, [1e13, 0.0]), (5, [-1e13, 0.0]), (100, [1e13, 1.0]), (6, []), (200, []), (7, [1e16, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, df.where("vec_id % 100 = 0"), k=9, block=3).collect())
    quantised = {k: [int(1024 * x) for x in v] for k, v in rows if k != 7}
    want = []
    for q in (0, 100, 200):
        scores = sorted((-sum(a * b for a, b in zip(quantised[q], v)), k) for k, v in quantised.items() if k != q and len(v) == len(quantised[q]))
        want += [(q, i, k, max(-(2**63), min(2**63 - 1, -s))) for i, (s, k) in enumerate(scores, 1)]
    assert got == sorted(want) and (0, 4, 1, 1024 * 1024 * 70001) in got


def test_against_sql(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    assert differences(topk.top_k(df, df.where("vec_id % 100 = 0"), block=100, chunk=2), connect(SF_DIR), topk.ORACLE) == []
