"""Small file-system helpers on the session's Hadoop file system."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from terraloom.session import ensure_checkpoint_dir


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _path(spark, path)
    return fs.exists(hadoop)


def rename(spark: SparkSession, source: str, target: str) -> None:
    hadoop, fs = _path(spark, source)
    if not fs.rename(hadoop, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as listings show it."""
    hadoop, fs = _path(spark, path)
    return fs.makeQualified(hadoop).toString()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob."""
    hadoop, fs = _path(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(hadoop) or []]


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put a short file in place by one rename; False if there is one already, which is left alone."""
    hadoop, fs = _path(spark, path)
    fresh = spark._jvm.org.apache.hadoop.fs.Path(f"{hadoop.getParent().toString()}/.{hadoop.getName()}-{uuid.uuid4().hex}")
    out = fs.create(fresh)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fresh, hadoop, _no_options(spark))  # fails, rather than replaces, where the name is taken
    except Py4JJavaError as error:
        fs.delete(fresh, False)
        if "FileAlreadyExistsException" in str(error.java_exception.toString()):
            return False
        raise
    return True


def _no_options(spark: SparkSession):
    option = spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    return spark.sparkContext._gateway.jvm.java.lang.reflect.Array.newInstance(option, 0)


def read_short(spark: SparkSession, path: str) -> str:
    """Text of a short file."""
    hadoop, fs = _path(spark, path)
    stream = fs.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    hadoop, fs = _path(spark, path)
    fs.delete(hadoop, True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """New folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
