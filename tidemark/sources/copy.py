"""Copying tables: recent rows by whichever time column there is; the pass that writes counts them and keeps some errors."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Names of time columns, the first one there is decides.
TIME_COLUMNS = ("ts", "date", "last_updated", "updated_at", "created_at")
#: Most unparsable times that a summary shows.
SAMPLES = 5
SUMMARY = "rows_read long, rows_kept long, rows_written long, rows_skipped long, unparsable long, samples array<string>"


def _time_of(df: DataFrame, candidates: tuple[str, ...]) -> tuple[str | None, Column]:
    """The deciding column, and its time: null where there is none or a text is none."""
    column = next((c for c in candidates if c in df.columns), None)
    if column is None:
        return None, F.lit(None).cast("timestamp")
    text = df.schema[column].dataType.simpleString() == "string"
    return column, F.try_to_timestamp(F.col(column)) if text else F.col(column)


def recent_rows(df: DataFrame, cutoff: datetime, candidates: tuple[str, ...] = TIME_COLUMNS) -> DataFrame:
    """Rows from cutoff on by the first time column there is; rows without a time, or with a text that is none, pass, as
    do tables without a column."""
    column, at = _time_of(df, candidates)
    return df if column is None else df.where(at.isNull() | (at >= F.lit(cutoff)))


def _samples(bad: Column) -> list[Column]:
    """The smallest unparsable text of each share of them, by their last letter: a few, the same in any order of rows."""
    share = F.coalesce(F.ascii(F.right(bad, F.lit(1))), F.lit(0)) % SAMPLES
    return [F.min(F.when(share == k, bad)).alias(f"sample{k}") for k in range(SAMPLES)]


def copy_table(spark: SparkSession, source: str, target: str, cutoff: datetime | None = None, truncate: bool = False, dry_run: bool = False, candidates: tuple[str, ...] = TIME_COLUMNS) -> DataFrame:
    """Copies a Parquet table in one pass; returns its summary (SUMMARY), observed while it was written. A dry run writes nothing."""
    df = spark.read.parquet(source)
    column, at = _time_of(df, candidates)
    bad = F.when(at.isNull(), F.col(column).cast("string")) if column else F.lit(None).cast("string")
    read, kept = Observation("read"), Observation("kept")
    seen = df.observe(read, F.count(F.lit(1)).alias("n"), F.count(bad).alias("bad"), *_samples(bad))
    rows = (seen if cutoff is None else recent_rows(seen, cutoff, candidates)).observe(kept, F.count(F.lit(1)).alias("n"))
    if dry_run:
        rows.write.format("noop").mode("overwrite").save()
    else:
        rows.write.mode("overwrite" if truncate else "append").parquet(target)
    was, now = read.get, kept.get
    samples = [was[f"sample{k}"] for k in range(SAMPLES) if was[f"sample{k}"] is not None]
    row = (was["n"], now["n"], 0 if dry_run else now["n"], was["n"] - now["n"], was["bad"], sorted(samples))
    return spark.createDataFrame([row], SUMMARY)


def summaries(parts: dict[str, DataFrame]) -> DataFrame:
    """The summaries of several tables, each with its name."""
    return reduce(DataFrame.unionByName, [s.select(F.lit(name).alias("table_name"), "*") for name, s in parts.items()])
