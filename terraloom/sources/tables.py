"""CSV scans with dataframe-reader rules for headers, missing values and types."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from terraloom.functions import numeric
from terraloom.operators.columns import quoted

# Texts that mean a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
TRAIN_PATH, TEST_PATH = "data/train_data.csv", "data/test_data.csv"


def parsed_header(line: str) -> tuple[str, ...]:
    """Column names of a header line; a repeated name gets ``.1``, ``.2``, ... appended."""
    seen: dict[str, int] = {}
    out = []
    for name in next(csv.reader([line.lstrip("\ufeff")])):
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(name if n == 0 else f"{name}.{n}")
    return tuple(out)


def headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of a path by their header: names -> files.

    One pass over the lines keeps one line per file; header names must not hold line breaks.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    first = lines.where((F.col("start") == 0) & (F.trim("value") != "")).groupBy("file").agg(F.min_by("value", "at").alias("line"))
    out: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file").collect():
        out.setdefault(parsed_header(row["line"]), []).append(row["file"])
    return out


def read_text_csv(
    spark: SparkSession, path: str | list[str], source_file: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Every column as text, blank lines skipped, missing-value texts kept as they are.

    ``path`` may be a glob; every file is read by its own header, columns that a
    file lacks are NULL in its rows.  A row with more fields than its header is
    an error.  ``source_file`` names a column for the file a row came from.
    """
    found = headers(spark, path)
    if not found:
        raise ValueError(f"no header line in {path}")
    parts = [
        _read_by_names(spark, path if len(found) == 1 else files, names, source_file, multi_line) for names, files in found.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _read_by_names(
    spark: SparkSession, path: str | list[str], names: Sequence[str], source_file: str | None, multi_line: bool
) -> DataFrame:
    positions = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(p, T.StringType()) for p in [*positions, "_surplus"]])
    rows = spark.read.schema(schema).csv(
        path, header=True, enforceSchema=True, multiLine=multi_line, escape='"', nullValue="", emptyValue="")
    ragged = F.raise_error(F.concat(F.lit(f"more than {len(names)} fields: ..."), F.col("_surplus"))).cast("boolean")
    cols = [F.col(p).alias(n or "_key") for p, n in zip(positions, names)]
    if source_file:
        cols.append(F.col("_metadata.file_path").alias(source_file))
    return rows.where(F.when(F.col("_surplus").isNull(), F.lit(True)).otherwise(ragged)).select(*cols)


def normalise_nulls(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Missing-value texts become NULL in every text column."""
    kinds = dict(df.dtypes)
    return df.select(*[
        F.when(~quoted(c).isin(*tokens), quoted(c)).alias(c) if kinds[c] == "string" else quoted(c) for c in df.columns
    ])


def infer_types(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Text columns whose present values are all whole numbers, numbers or booleans get that type.

    One aggregate pass decides; a column without any value becomes DOUBLE.
    """
    names = list(names) if names is not None else [c for c, kind in df.dtypes if kind == "string"]
    if not names:
        return df

    def every(test: Column) -> Column:
        return F.coalesce(F.bool_and(test), F.lit(True))

    row = df.agg(*[
        F.struct(
            F.count(quoted(n)).alias("present"), every(numeric.is_integer_text(quoted(n))).alias("whole"),
            every(numeric.is_numeric_text(quoted(n))).alias("number"),
            every(F.lower(quoted(n)).isin("true", "false")).alias("boolean"),
        ).alias(f"t{i}") for i, n in enumerate(names)
    ]).first()

    def typed(n: str) -> Column:
        if n not in names:
            return quoted(n)
        t = row[f"t{names.index(n)}"]
        if t["present"] == 0:
            return F.lit(None).cast("double").alias(n)
        if t["whole"]:
            return F.trim(quoted(n)).cast("bigint").alias(n)
        if t["number"]:
            return numeric.to_number(quoted(n)).alias(n)
        return quoted(n).cast("boolean").alias(n) if t["boolean"] else quoted(n)

    return df.select(*[typed(c) for c in df.columns])


def read_table(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, source_file: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header line.  Columns in ``schema`` are cast to its types, the others are inferred."""
    rows = normalise_nulls(read_text_csv(spark, path, source_file, multi_line))
    known = {f.name: f.dataType for f in schema.fields} if schema else {}
    open_names = [c for c in rows.columns if c not in known and c != source_file]
    inferred = infer_types(rows, open_names)
    return inferred.select(*[quoted(c).cast(known[c]).alias(c) if c in known else quoted(c) for c in inferred.columns])


def read_keyed_table(spark: SparkSession, path: str | list[str], row_id: str = "row_id", **options) -> DataFrame:
    """CSV whose first column, whatever its name, is the row key."""
    df = read_table(spark, path, **options)
    return df.toDF(row_id, *df.columns[1:])


def read_master(spark: SparkSession, train: bool = True, train_path: str = TRAIN_PATH, test_path: str = TEST_PATH) -> DataFrame:
    """The training table or the test table."""
    return read_table(spark, train_path if train else test_path)
