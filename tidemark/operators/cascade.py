"""Candles and category totals stored at three levels, and their recomputation from changed slots upwards.

A change replaces slots. The hours that hold them are made anew from the stored slots, then the days from the stored hours;
each level reads only the partitions and keys that are dirty and overwrites only the partitions they lie in. Totals of a level
are added up anew for the instants at which one of its candles changed, over all entities. What is stored after a change equals
what a full computation over the changed slots gives.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timeutil import floor_hour
from tidemark.operators import bars, rollup
from tidemark.sources import stored

_VALUES = "open double, high double, low double, close double, point_count long, rows_seen long, market_cap double, volume_24h double, last_updated timestamp_ntz, part date"
CANDLES = f"id string, bucket timestamp_ntz, {_VALUES}"
TOTALS = "bucket timestamp_ntz, category string, market_cap double, volume_24h double, last_updated timestamp_ntz, contributors long, part date"


@dataclass(frozen=True)
class Level:
    """One resolution: where its instants start, and the calendar unit that a partition covers."""

    name: str
    floor: Callable[[Column], Column]
    part: Callable[[Column], Column]


def _day(at: Column) -> Column:
    return F.to_date(at)


def _month(at: Column) -> Column:
    return F.trunc(at, "month")


SLOTS = Level("slots", lambda at: at, _day)
HOURS = Level("hours", floor_hour, _day)
DAYS = Level("days", lambda at: F.date_trunc("day", at).cast("timestamp_ntz"), _month)
LEVELS = (SLOTS, HOURS, DAYS)


def _parted(candles: DataFrame, level: Level, schema: str = CANDLES) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    return candles.withColumn("part", level.part(F.col("bucket"))).select(names)


def _totals(candles: DataFrame, categories: DataFrame, level: Level) -> DataFrame:
    named = candles.join(categories.select("id", "category"), "id", "left")
    return _parted(rollup.category_totals(named.withColumnRenamed("bucket", "slot")).withColumnRenamed("slot", "bucket"), level, TOTALS)


def build(slots: DataFrame, categories: DataFrame, path: str) -> None:
    """All levels from all slots. categories: id, category."""
    spark, below = slots.sparkSession, slots
    for level in LEVELS:
        candles = below if level is SLOTS else bars.bars_from_bars(below, level.floor(F.col("bucket")))
        _parted(candles, level).write.mode("overwrite").partitionBy("part").parquet(f"{path}/{level.name}")
        below = spark.read.schema(CANDLES).parquet(f"{path}/{level.name}").drop("part")
        _totals(below, categories, level).write.mode("overwrite").partitionBy("part").parquet(f"{path}/{level.name}_totals")


def recompute(changed: DataFrame, categories: DataFrame, path: str) -> dict[str, list]:
    """changed: slots (the columns of CANDLES but part) that replace the stored ones. Returns the partitions written, by table.

    Each step may be run again: it makes the same rows from what is stored.
    """
    spark, written = changed.sparkSession, {}
    dirty = changed.select("id", "bucket")
    below: Level | None = None
    for level in LEVELS:
        if below is None:
            fresh = _parted(changed, level)
        else:
            dirty = dirty.select("id", level.floor(F.col("bucket")).alias("bucket")).distinct()
            source = stored.pruned(spark, f"{path}/{below.name}", CANDLES, _covering(dirty, level, below), "part").drop("part")
            up = dirty.select(F.col("id").alias("_id"), F.col("bucket").alias("_up"))
            affected = source.join(up, (F.col("id") == F.col("_id")) & (level.floor(F.col("bucket")) == F.col("_up")), "left_semi")
            fresh = _parted(bars.bars_from_bars(affected, level.floor(F.col("bucket"))), level)
        written[level.name] = stored.merge_rows(fresh, f"{path}/{level.name}", ["id", "bucket"], "part")
        instants = dirty.select("bucket").distinct()
        at = stored.pruned(spark, f"{path}/{level.name}", CANDLES, written[level.name], "part").drop("part").join(instants, "bucket", "left_semi")
        old = stored.pruned(spark, f"{path}/{level.name}_totals", TOTALS, written[level.name], "part").join(instants, "bucket", "left_anti")
        totals = old.unionByName(_totals(at, categories, level))
        stored.replace_partitions(totals, f"{path}/{level.name}_totals", "part")
        written[f"{level.name}_totals"] = written[level.name]
        below = level
    return written


def _covering(dirty: DataFrame, level: Level, below: Level) -> list:
    """Partitions of the level below that hold the parts of dirty candles: a candle lies within one of them."""
    return stored.touched(dirty.select(below.part(F.col("bucket")).alias("part")), "part")
