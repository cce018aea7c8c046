"""Stored tables with atomic versions.

A table is a folder of parts and a folder of manifests.  A write puts a new part beside the others and then a manifest that
lists the parts of the new version; the manifest appears by one rename that fails if another writer was first.  Whoever reads takes
the newest manifest and sees that version whole, whatever is written meanwhile; a job that dies before its manifest leaves nothing
but a part that no version names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from terraloom.operators.enrich import latest_per_key
from terraloom.sources import files

DIGITS = 12  # of a manifest's name


class VersionConflict(Exception):
    """Another writer has put the version in place first."""


def _manifest(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/versions/{version:0{DIGITS}d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    found = files.matching(spark, f"{path.rstrip('/')}/versions/[0-9]*.json")
    return sorted(int(f.rsplit("/", 1)[1].split(".")[0]) for f in found)


def _contents(spark: SparkSession, path: str, version: int) -> dict:
    return json.loads(files.read_short(spark, _manifest(path, version)))


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or a given one; what is committed later does not show in it."""
    if version is None:
        known = versions(spark, path)
        if not known:
            raise FileNotFoundError(f"no version of {path}")
        version = known[-1]
    contents = _contents(spark, path, version)
    schema = StructType.fromJson(contents["schema"])
    if not contents["parts"]:
        return spark.createDataFrame([], schema)
    root = f"{path.rstrip('/')}/parts"
    rows = spark.read.schema(schema).option("basePath", files.qualified(spark, root))
    return rows.parquet(*[f"{root}/part={p}" for p in contents["parts"]]).select(*[f"`{c}`" for c in schema.names])


def write_part(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write rows as a part that no version names yet."""
    name = uuid.uuid4().hex
    df.write.partitionBy(*partition_by).parquet(f"{path.rstrip('/')}/parts/part={name}")
    return name


def commit(spark: SparkSession, path: str, parts: Sequence[str], schema: StructType, base: int) -> int:
    """Make the parts version ``base + 1``; ``VersionConflict`` if there is one already."""
    text = json.dumps({"parts": list(parts), "schema": schema.jsonValue()})
    if not files.put_new(spark, _manifest(path, base + 1), text):
        raise VersionConflict(f"{path} has a version {base + 1} already")
    return base + 1


def create(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """The first version of a table."""
    return commit(df.sparkSession, path, [write_part(df, path, partition_by)], df.schema, 0)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Add rows.  The part is written once; if another writer commits meanwhile, it is named by a later manifest."""
    spark, part = df.sparkSession, write_part(df, path, partition_by)
    while True:
        known = versions(spark, path)
        if not known:
            try:
                return commit(spark, path, [part], df.schema, 0)
            except VersionConflict:
                continue
        contents = _contents(spark, path, known[-1])
        schema = StructType.fromJson(contents["schema"])
        if {f.name: f.dataType for f in schema} != {f.name: f.dataType for f in df.schema}:
            raise ValueError(f"columns {df.columns} do not fit {schema.names}")
        try:
            return commit(spark, path, [*contents["parts"], part], schema, known[-1])
        except VersionConflict:
            continue


def rewrite(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = ()) -> int:
    """Replace all rows by ``change`` of them; ``VersionConflict`` if anything was committed meanwhile, and then nothing is lost."""
    base = versions(spark, path)[-1]
    changed = change(read_version(spark, path, base))
    return commit(spark, path, [write_part(changed, path, partition_by)], changed.schema, base)


def compact(spark: SparkSession, path: str, keys: Sequence[str], newest: Sequence[str], partition_by: Sequence[str] = ()) -> int:
    """One part with the newest row per key in place of all parts.

    Parts that others append meanwhile are kept behind it, and rows of theirs win when it is read or compacted again.
    """
    base = versions(spark, path)[-1]
    folded = _contents(spark, path, base)["parts"]
    rows = latest_per_key(read_version(spark, path, base), keys, newest)
    part = write_part(rows, path, partition_by)
    while True:
        latest = versions(spark, path)[-1]
        now = _contents(spark, path, latest)
        if now["parts"][:len(folded)] != folded:
            raise VersionConflict(f"{path} was rewritten")
        try:
            return commit(spark, path, [part, *now["parts"][len(folded):]], StructType.fromJson(now["schema"]), latest)
        except VersionConflict:
            continue


def remove_old(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Remove all versions but the last ``keep``, and the parts that none of those names; no writer may be at work."""
    known = versions(spark, path)
    kept = {p for v in known[-keep:] for p in _contents(spark, path, v)["parts"]}
    for version in known[:-keep]:
        files.remove(spark, _manifest(path, version))
    for part in files.matching(spark, f"{path.rstrip('/')}/parts/part=*"):
        if part.rsplit("=", 1)[1] not in kept:
            files.remove(spark, part)
