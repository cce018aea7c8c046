"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution; a cluster sizes shuffle partitions itself, local runs pass a number."""
    builder = SparkSession.builder.appName("terraloom")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SCALE_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for ``DataFrame.checkpoint``: the one the cluster names, or a scratch folder in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="terraloom-checkpoint-")  # one machine, one process: it goes when that ends
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    context.setCheckpointDir(named)
    return named
