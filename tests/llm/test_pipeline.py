"""Every stage of the pipeline against a brute-force version of it on its own input."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from terraloom.llm import mixing
from terraloom.llm.common import stored
from tests.llm import test_packing, test_simhash, test_suffix_dedup
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage, as run() chains them."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(900, None, None, None, None), (901, "1 2 3", "en", "src1", 5), (902, "", "en", None, 0)], docs.schema)
    docs, out = docs.union(odd).union(docs.limit(3)), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF_DIR), name)
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_order_and_columns(stages):
    assert list(stages) == ["language", "near_duplicates", "repeated_passages", "mix", "pack"]
    for name, (before, after) in stages.items():
        assert name == "pack" or (after.columns == before.columns and after.dtypes == before.dtypes)


def test_language(stages):
    before, after = stages["language"]
    assert rows(after) == [r for r in rows(before) if any(c.isalpha() for c in r[1] or "")]


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    got, all_rows = rows(after), rows(before)
    groups = test_simhash.plain_components([test_simhash.plain_fingerprint(r[1]) for r in all_rows])
    least = {}
    for r, g in zip(all_rows, groups):
        least[g] = min(least.get(g, r), r, key=lambda x: x[0])
    assert got == sorted(least.values(), key=str)


def test_repeated_passages(stages):
    before, after = stages["repeated_passages"]
    texts = {r[0]: r[1] for r in rows(before)}
    plain = dict(zip(texts, test_suffix_dedup.plain([t.encode() for t in texts.values()])))
    for doc_id, text, _, _, n_chars in rows(after):
        n, removed, _, _ = plain[doc_id]
        if removed:
            assert n - removed - 6 <= len(text.encode()) <= n - removed and n_chars == len(text)
        else:
            assert text == texts[doc_id]
    assert sorted(texts) == sorted(r[0] for r in rows(after)) and any(p[1] for p in plain.values())


def test_mix(stages):
    before, after = stages["mix"]
    con = duckdb.connect()
    con.register("documents", before.toPandas())
    taken = {r[0]: (r[1], r[4]) for r in con.execute(mixing.ORACLE).fetchall()}
    count = {}
    for r in after.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert count == {k: t // s for k, (s, t) in taken.items() if t}


def test_pack(stages):
    before, after = stages["pack"]
    sequences, tokens = test_packing.check(after, [(r.doc_id, r.text) for r in before.collect()])
    assert sequences <= -(-tokens // 2048) * 1.02 + 1


def test_run(spark, stages):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == stages["pack"][1].columns and out.count() > 0
