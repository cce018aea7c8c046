"""Operators for training-data pipelines: near-duplicates, repeated passages, licences, archives, packing, quality, language, mixing, search, scoring,
collocations, fingerprints and audits of filters."""

from __future__ import annotations


def registered() -> dict:
    """Name -> (callable(spark, dir), SQL or None)."""
    from terraloom.llm.queries import QUERIES

    return dict(QUERIES)
