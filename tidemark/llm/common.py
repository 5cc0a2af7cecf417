"""Shared helpers: the cluster's shared folder, materialised tables, ordered prefix sums."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scratch import shared_dir


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def only_result(make: Callable[[], DataFrame], tag: str) -> DataFrame:
    """make()'s result as a table of its own; all other tables that were written for it are deleted."""
    _scopes.append([])
    try:
        out = materialise(make(), tag)
    finally:
        written = _scopes.pop()
    _delete(out.sparkSession, [p for p in written if p != out._scratch])
    return out


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing reads any more."""
    for df in tables:
        _delete(df.sparkSession, [df._scratch])


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """One struct column, row, with all of df's columns, beside the given ones: working columns never meet df's names.

    A row without columns of its own can't be packed. unpacked() gives df's columns back.
    """
    return df.select(F.struct(*[F.col(_quoted(c)) for c in df.columns]).alias("row"), *[c.alias(k) for k, c in columns.items()])


def unpacked(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns of a packed row, those named in new replaced; new ones that the row doesn't have come last."""
    out = [new[c].alias(c) if c in new else F.col(f"row.{_quoted(c)}").alias(c) for c in columns]
    return df.select(*out, *[c.alias(k) for k, c in new.items() if k not in columns])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_prefix_sum(df: DataFrame, outer: str, inner: list[str], value: str, out: str) -> DataFrame:
    """out = sum of value over all rows before this one, in order of (outer, *inner).

    Two levels: inside each outer group, then over one row per outer group. The number of outer groups must be small
    (partitions, shards); each group's rows are one window partition.
    """
    w = Window.partitionBy(outer).orderBy(*inner).rowsBetween(Window.unboundedPreceding, -1)
    within = df.withColumn("_before", F.coalesce(F.sum(value).over(w), F.lit(0).cast("long")))
    sums = df.groupBy(outer).agg(F.sum(value).alias("_total"))
    across = Window.orderBy(outer).rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col(outer).alias("_outer"), F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_base"))
    return (
        within.join(base, F.col(outer) == F.col("_outer"))
        .withColumn(out, (F.col("_base") + F.col("_before")).cast("long"))
        .drop("_outer", "_base", "_before")
    )
