"""Positions and running sums over a whole ordered table, in two levels, so that no task holds all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scratch import pinned


def with_running_sum(df: DataFrame, part: str, order: list[str], value: str, out: str) -> DataFrame:
    """out: sum of value over the rows before, in order of (part, *order). part: the number of a range of rows."""
    before = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumn("_in", F.coalesce(F.sum(value).over(before), F.lit(0)))
    totals = df.groupBy(part).agg(F.sum(value).alias("_t"))
    across = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(F.col(part).alias("_part"), F.coalesce(F.sum("_t").over(across), F.lit(0)).alias("_base"))
    return inner.join(base, F.col(part) == F.col("_part")).withColumn(out, F.col("_base") + F.col("_in")).drop("_in", "_base", "_part")


def with_position(df: DataFrame, part: str, order: list[str], out: str) -> DataFrame:
    """out: place of the row, from 0."""
    return with_running_sum(df.withColumn("_one", F.lit(1).cast("long")), part, order, "_one", out).drop("_one", part)


def ranged(df: DataFrame, order: list[str], part: str) -> DataFrame:
    """df in ranges of the order, numbered by part. The numbers are pinned, as both levels of a running sum read them."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pinned(df.repartitionByRange(width, *order).withColumn(part, F.spark_partition_id()))


def budget_prefix(plans: DataFrame, cost: str, budget: int, order: list[str], tie: str) -> DataFrame:
    """Plans in order while their running cost stays within the budget; ranges of (order, tie), so equal costs spread too."""
    keys = list(dict.fromkeys([*order, tie]))
    out = with_running_sum(ranged(plans, keys, "_range"), "_range", keys, cost, "spent_before").drop("_range")
    return out.where(F.col("spent_before") + F.col(cost) <= budget)
