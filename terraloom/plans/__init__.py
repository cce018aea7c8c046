"""Registered queries over the test tables, each with its SQL counterpart.

Every module here holds a ``QUERIES`` dict: name -> (callable(spark, dir), SQL or None).
"""

from __future__ import annotations

from importlib import import_module

MODULES = ("series", "clean", "enrich", "similar", "reshape", "geo", "footprints", "listings", "encode", "sparse", "profile", "stored")


def registered() -> dict:
    out = {}
    for module in MODULES:
        for name, entry in import_module(f"{__name__}.{module}").QUERIES.items():
            if name in out:
                raise ValueError(f"query {name} is registered twice")
            out[name] = entry
    return out
