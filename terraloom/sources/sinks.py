"""CSV, text and in-place sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from terraloom.operators.columns import quoted
from terraloom.sources import files

STATS_HEADER = ("id", "season", "year", "mean", "max", "min", "stdDev", "p90", "slope", "intercept", "auc")


def write_table(df: DataFrame, path: str, row_id: str | None = "row_id", key_name: str | None = None, mode: str = "error") -> None:
    """CSV with a header.  The key comes first, under ``key_name`` if one is given; ``row_id=None`` leaves it out."""
    rest = [quoted(c) for c in df.columns if c not in ("row_id", row_id)]
    cols = rest if row_id is None else [quoted(row_id).alias(key_name or row_id), *rest]
    df.select(*cols).write.mode(mode).csv(path, header=True, nullValue="", emptyValue='""', escape='"')


def write_season_files(df: DataFrame, path: str, mode: str = "error") -> None:
    """One folder per season and year."""
    df.write.mode(mode).partitionBy("season", "year").csv(path, header=True, nullValue="", escape='"')


def append_stats(df: DataFrame, path: str, header: Sequence[str] = STATS_HEADER) -> None:
    """Append one batch of season statistics; NULL is an empty field."""
    df.select(*header).write.mode("append").csv(path, header=True, nullValue="", emptyValue="", escape='"')


def write_lines(df: DataFrame, line: Column, path: str, mode: str = "error") -> None:
    """Plain text, one line per row."""
    df.select(line.alias("value")).write.mode(mode).text(path)


def rewrite_table(spark: SparkSession, path: str, read: Callable[[str], DataFrame], change: Callable[[DataFrame], DataFrame],
                  write: Callable[[DataFrame, str], None]) -> str:
    """Read, change and write back a stored table; returns where the old version went.

    The new version is written beside the old one and put in place by two renames.
    A job that dies while writing leaves the table as it was; between the renames
    the path does not exist for a moment, and the old version stays under the
    returned name until the caller removes it.
    """
    base = path.rstrip("/")
    tag = uuid.uuid4().hex[:8]
    fresh, old = f"{base}.new-{tag}", f"{base}.old-{tag}"
    write(change(read(path)), fresh)
    files.rename(spark, base, old)
    files.rename(spark, fresh, base)
    return old
