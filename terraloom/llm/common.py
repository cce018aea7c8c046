"""Shared pieces of the corpus operators: words, stored steps and batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terraloom.session import ensure_checkpoint_dir

# Words are maximal runs of anything but space and the five ASCII line and tab characters.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\f\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; empty for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), "")


def spaceless(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; a null text counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a step to the shared folder and read it back: its lineage ends there, and lost executors cost nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, path: str) -> None:
    """Remove a stored step that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def forget_stored(df: DataFrame) -> None:
    """The same for what ``stored`` returned."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        forget(df.sparkSession, folder)


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a stored table of at most ``rows`` short rows; a larger one is joined by shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def hashed_sample(df: DataFrame, column: str, bound: int) -> DataFrame:
    """At most ``bound`` rows, those with the least hashes of a column; very nearly as many if there are more.

    Rows are counted first and all but a little over ``bound`` are left out where they lie, so what meets in one place does not grow
    with the number of tasks.
    """
    order = F.shiftrightunsigned(F.xxhash64(column), 24)
    share = min(1.0, (1.1 * bound + 20) / max(1, df.count()))
    return df.where(order < F.lit(int(share * 2**40))).orderBy(order, column).limit(bound)


def record_batches(schema: pa.Schema, rows: Iterable[tuple], size: int = 8192) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` tuples."""
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) >= size:
            yield as_batch(schema, block)
            block = []
    if block:
        yield as_batch(schema, block)


def as_batch(schema: pa.Schema, block: list[tuple]) -> pa.RecordBatch:
    columns = zip(*block, strict=True) if block else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
