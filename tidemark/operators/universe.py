"""Which assets: ranks, windows, shards, categories. The universe is a dimension, small beside the series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import category_or_other
from tidemark.operators.ordering import ranged, with_position

UNRANKED = 2_000_000_000


def ranked_top(live: DataFrame, n: int, rank: str = "market_cap_rank") -> DataFrame:
    return live.where(F.col(rank) > 0).orderBy(rank, "id").limit(n)


def rank_window(live: DataFrame, low: int, high: int, rank: str = "market_cap_rank") -> DataFrame:
    return live.where(F.col(rank).between(low, high))


def missing_ids(wanted: DataFrame, live: DataFrame) -> DataFrame:
    return wanted.select("id").distinct().join(live, "id", "left_anti")


def shard(ids: DataFrame, shards: int, number: int) -> DataFrame:
    """Every shards-th of the sorted ids. Positions come from per-range counts, so no task sorts all ids."""
    parts = ranged(ids.select("id").distinct(), ["id"], "_p")
    return with_position(parts, "_p", ["id"], "position").where(F.col("position") % shards == number).select("id", "position")


def with_category(live: DataFrame, by_id: DataFrame, by_symbol: DataFrame) -> DataFrame:
    """Category by id, else by symbol, else Other. Both dimensions are left to Spark to broadcast if small."""
    a = by_id.select(F.lower("id").alias("_i"), F.col("category").alias("_ci"))
    b = by_symbol.select(F.upper("symbol").alias("_s"), F.col("category").alias("_cs"))
    j = live.join(a, F.lower(live["id"]) == F.col("_i"), "left").join(b, F.upper(live["symbol"]) == F.col("_s"), "left")
    return j.withColumn("category", category_or_other(F.coalesce("_ci", "_cs"))).drop("_i", "_ci", "_s", "_cs")


def union_ids(*frames: DataFrame) -> DataFrame:
    out = frames[0].select("id")
    for f in frames[1:]:
        out = out.union(f.select("id"))
    return out.distinct()


def unique_ranks(live: DataFrame, rank: str = "market_cap_rank") -> DataFrame:
    """Of assets that share a rank, the latest (then largest, then by id) keeps it; the others lose theirs."""
    w = Window.partitionBy(rank).orderBy(F.desc_nulls_last("last_updated"), F.desc_nulls_last("market_cap"), "id")
    ranks = live.where(F.col(rank).isNotNull()).withColumn("demoted", F.row_number().over(w) > 1)
    # rows without a rank never meet in a window
    return ranks.withColumn(rank, F.when(~F.col("demoted"), F.col(rank))).unionByName(live.where(F.col(rank).isNull()).withColumn("demoted", F.lit(False)))


def first_ids(ids: DataFrame, n: int) -> DataFrame:
    """The first n of the sorted ids."""
    return ids.select("id").where("id is not null").distinct().orderBy("id").limit(n)


def with_meta(ids: DataFrame, live: DataFrame) -> DataFrame:
    """ids with the live row's symbol, name and rank; a stub where there is none: the id in capitals, the id, no rank."""
    meta = live.select(F.col("id").alias("_id"), "symbol", "name", "market_cap_rank")
    j = ids.select("id").distinct().join(meta, F.col("id") == F.col("_id"), "left")
    known = F.col("_id").isNotNull()
    return j.select("id", F.coalesce("symbol", F.upper("id")).alias("symbol"), F.coalesce("name", "id").alias("name"), "market_cap_rank", known.alias("known"))


def complete(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with an id and a time of update; one row: how many there are and how many were dropped)."""
    whole = F.col("id").isNotNull() & (F.trim("id") != "") & F.col("last_updated").isNotNull()
    whole = F.coalesce(whole, F.lit(False))
    return rows.where(whole), rows.agg(F.count_if(whole).alias("kept"), F.count_if(~whole).alias("dropped"))


def unranked_last(rank: Column) -> Column:
    """Rank with a sentinel that sorts unranked assets last."""
    return F.when(rank > 0, rank).otherwise(F.lit(UNRANKED)).cast("int")


def new_entrants(live: DataFrame, first_days: DataFrame, start: str, n: int = 20) -> DataFrame:
    """Assets without history, or whose first day is after start: the n best ranked."""
    j = live.join(first_days, "id", "left")
    return j.where(F.col("first_day").isNull() | (F.col("first_day") > F.to_date(F.lit(start)))).orderBy(F.asc_nulls_last("market_cap_rank"), "id").limit(n)
