"""Tables of Parquet partitions that are changed in place: pruned reads, whole-partition replacement, retention, row deletes.

A partition is a calendar day or month, so lists of touched partitions are bounded by the calendar and may pass the driver.
Replacing is Spark's dynamic partition overwrite: files of other partitions are not touched.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import upsert
from tidemark.sources.tables import replace_partitions


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def partitions(spark: SparkSession, path: str, column: str = "day") -> list[str]:
    """Values of the partition column, from the names of the folders alone: no file is read."""
    fs, at = _file_system(spark, path)
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{column}="))


def drop_partitions(spark: SparkSession, path: str, values: list[str], column: str = "day") -> None:
    fs, _ = _file_system(spark, path)
    for v in values:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={v}"), True)


def retain(spark: SparkSession, path: str, first: date, column: str = "day") -> list[str]:
    """Drops the partitions before first, by metadata: their files are deleted unread. Returns what was dropped."""
    gone = [v for v in partitions(spark, path, column) if v != "__HIVE_DEFAULT_PARTITION__" and v < first.isoformat()]
    drop_partitions(spark, path, gone, column)
    return gone


def touched(df: DataFrame, column: str = "day") -> list:
    """The partitions that rows lie in."""
    return sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)


def pruned(spark: SparkSession, path: str, schema: str, values: list, column: str = "day") -> DataFrame:
    """The stored rows of some partitions; none where nothing is stored."""
    if not exists(spark, path) or not values:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).where(F.col(column).isin(values))


def merge_rows(new: DataFrame, path: str, keys: list[str], column: str = "day") -> list:
    """Rows of new replace stored ones of the same keys; only their partitions are read and written. Returns those."""
    values = touched(new, column)
    if values:
        old = pruned(new.sparkSession, path, new.schema, values, column)
        replace_partitions(upsert(old, new, keys), path, column)
    return values


def delete_rows(spark: SparkSession, path: str, doomed: Column, schema: str, column: str = "day", within: Column | None = None) -> list:
    """Deletes rows by rewriting only the partitions that hold any; those that would be left empty are dropped. Returns both.

    within: a condition on the partition column, which prunes the search: rows of other partitions stay.
    """
    rows, doomed = spark.read.schema(schema).parquet(path), F.coalesce(doomed, F.lit(False))
    searched = rows if within is None else rows.where(within)
    held = searched.groupBy(column).agg(F.count_if(doomed).alias("gone"), F.count_if(~doomed).alias("left")).where("gone > 0").collect()
    rewritten = [r[column] for r in held if r["left"]]
    if rewritten:
        replace_partitions(rows.where(F.col(column).isin(rewritten)).where(~doomed), path, column)
    drop_partitions(spark, path, [str(r[column]) for r in held if not r["left"]], column)
    return sorted(r[column] for r in held)


def files(spark: SparkSession, path: str) -> dict[str, set[str]]:
    """partition -> its data files."""
    fs, at = _file_system(spark, path)
    out: dict[str, set[str]] = {}
    for folder in fs.listStatus(at):
        if folder.isDirectory() and "=" in folder.getPath().getName():
            names = {s.getPath().getName() for s in fs.listStatus(folder.getPath())}
            out[folder.getPath().getName().partition("=")[2]] = {n for n in names if n[0] not in "._"}
    return out
