"""The folder all executors share, and tables pinned in it."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, local sessions get a temporary folder; a cluster has no folder of its own that
    all its machines see, so there it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def pinned(df: DataFrame) -> DataFrame:
    """df, evaluated once and kept: whatever reads it twice sees the same rows in the same partitions."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
