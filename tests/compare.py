"""Side-by-side check of registered queries: Spark result against DuckDB's."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "array<double>": "DOUBLE[]", "array<string>": "VARCHAR[]",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(0.0 if v == 0 else v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types and all values agree."""
    out = []
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    want_types = {r[0]: r[1] for r in described}
    have_types = {n: KINDS.get(t, t) for n, t in df.dtypes}
    if want_types != have_types:
        out.append(f"schema: spark {sorted(have_types.items())} sql {sorted(want_types.items())}")
        if set(want_types) != set(have_types):
            return out
    have = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows([r[0] for r in described], con.execute(sql).fetchall())
    if len(have) != len(want):
        out.append(f"rows: spark {len(have)} sql {len(want)}")
    if not have:
        out.append("no rows")
    a, b = set(have), set(want)
    if have != want:
        out.append(f"only spark {sorted(a - b)[:3]} only sql {sorted(b - a)[:3]} ({len(a - b)}/{len(b - a)})")
    return out
