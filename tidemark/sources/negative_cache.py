"""Ids that are known to have no data: a text table, one id a line, that runs read whole and append to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.stored import exists


def read(spark: SparkSession, path: str) -> DataFrame:
    """id: the lines, trimmed, each once; none where there is no table yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], "id string")
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id <> ''").distinct()


def append(ids: DataFrame, path: str) -> None:
    """Adds ids (id) that the table doesn't have. A run that is repeated adds nothing twice to what is read."""
    known = read(ids.sparkSession, path)
    fresh = ids.select(F.trim(F.col("id").cast("string")).alias("id")).where("id <> ''").distinct().join(known, "id", "left_anti")
    fresh.select(F.col("id").alias("value")).write.mode("append").text(path)


def without_known(ids: DataFrame, path: str, column: str = "id") -> DataFrame:
    """ids that may still have data."""
    known = read(ids.sparkSession, path).select(F.col("id").alias("_known"))
    return ids.join(known, F.col(column).cast("string") == F.col("_known"), "left_anti")
