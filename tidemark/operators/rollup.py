"""Category totals with ALL, ranks, gates and the slot quality decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import category_or_other
from tidemark.operators.fill import asof

ALL = "ALL"


def category_totals(rows: DataFrame, slot: str = "slot") -> DataFrame:
    """Per slot and category, and per slot as ALL: market cap, volume, newest update, contributors. Null caps count as 0."""
    r = rows.withColumn("category", category_or_other(F.col("category")))
    return (
        r.groupingSets([[F.col(slot), F.col("category")], [F.col(slot)]], F.col(slot), F.col("category"))
        .agg(
            F.sum(F.coalesce("market_cap", F.lit(0.0))).alias("market_cap"), F.sum(F.coalesce("volume_24h", F.lit(0.0))).alias("volume_24h"),
            F.max("last_updated").alias("last_updated"), F.count(F.lit(1)).alias("contributors"), F.grouping("category").alias("_all"),
        ).withColumn("category", F.when(F.col("_all") == 1, ALL).otherwise(F.col("category"))).drop("_all")
    )


def rebuild_all(categories: DataFrame, slot: str = "slot") -> DataFrame:
    """ALL strictly as the sum of the slot's categories."""
    return categories.where(F.col("category") != ALL).groupBy(slot).agg(
        F.sum("market_cap").alias("market_cap"), F.sum("volume_24h").alias("volume_24h"), F.max("last_updated").alias("last_updated")
    )


def with_ranks(totals: DataFrame, slot: str = "slot") -> DataFrame:
    """market_cap_rank: ALL is 0, categories by market cap, ties by name."""
    is_all = F.col("category") == ALL
    w = Window.partitionBy(slot, is_all).orderBy(F.desc("market_cap"), "category")
    return totals.withColumn("market_cap_rank", F.when(is_all, 0).otherwise(F.row_number().over(w)).cast("int"))


def min_contributors(top_n: int, share: float = 0.7) -> Column:
    return F.bround(F.lit(share * top_n)).cast("int")


def v_shapes(all_rows: DataFrame, drop: float = 0.07, floor: float = 50e9, slot: str = "slot", *, key: str) -> DataFrame:
    """Slots whose total falls by the share and the amount from the slot before and comes back in the next one, by key."""
    w = Window.partitionBy(key).orderBy(slot)
    prev, nxt, cur = F.lag("market_cap").over(w), F.lead("market_cap").over(w), F.col("market_cap")
    deep = lambda other: (other > 0) & ((other - cur) / other >= drop) & ((other - cur) >= floor)
    return all_rows.withColumn("prev_cap", prev).withColumn("next_cap", nxt).withColumn("v_shape", F.coalesce(deep(prev) & deep(nxt), F.lit(False)))


def _against(rows: DataFrame) -> DataFrame:
    ratio = F.when(F.col("prev_all") > 0, F.col("market_cap") / F.col("prev_all"))
    return rows.withColumn("coverage_ratio", ratio).withColumn("drop_pct", F.greatest(1 - ratio, F.lit(0.0)))


def coverage_against_previous(all_rows: DataFrame, slot: str = "slot", *, key: str) -> DataFrame:
    """Each total against that of the slot before among the rows themselves."""
    return _against(all_rows.withColumn("prev_all", F.lag("market_cap").over(Window.partitionBy(key).orderBy(slot))))


def coverage_against_stored(all_rows: DataFrame, stored: DataFrame, slot: str = "slot", *, key: str = "category") -> DataFrame:
    """Each total against the last one that is stored before its slot, however long ago; decisions on new slots come before any of
    them is stored, so none sees another. A total with none before it, or a zero one, has no ratio."""
    before = stored.select(F.col(key), F.col(slot).alias("_at"), "market_cap")
    seen = asof(all_rows, before, key, slot, "_at", ["market_cap"]).withColumnRenamed("asof_market_cap", "prev_all").withColumnRenamed("asof_time", "prev_slot")
    return _against(seen)


def slot_decision(has_data: Column, required_ok: Column, v_shape: Column, coverage: Column, prev: Column, low_count: Column, min_coverage: float = 0.90, carry_low: bool = False) -> Column:
    """direct, or why the slot is carried or skipped. Quarantine goes before a low count."""
    quarantine = ~required_ok | v_shape | F.coalesce(coverage < min_coverage, F.lit(False))
    return (
        F.when(~has_data, "no_slot_data").when(quarantine & prev.isNotNull(), "quarantine_prev").when(quarantine, "quarantine_skip")
        .when(low_count & F.lit(carry_low) & prev.isNotNull(), "carry_low_coin_count").when(low_count, "skip_low_coin_count").otherwise("direct")
    )


def report_order(category: str = "category") -> list[Column]:
    """ALL first, then by name whatever the case."""
    return [F.when(F.col(category) == "ALL", 0).otherwise(1), F.lower(category)]
