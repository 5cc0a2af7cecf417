"""Audits of stored series and the repairs they lead to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ohlc_invalid() -> Column:
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return o.isNull() | h.isNull() | lo.isNull() | c.isNull() | (h < F.greatest(o, c)) | (lo > F.least(o, c)) | (h < lo)


def flat() -> Column:
    return F.greatest("open", "high", "low", "close") == F.least("open", "high", "low", "close")


def longest_equal_run(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    changed = F.coalesce((~F.lag(value).over(w).eqNullSafe(F.col(value))).cast("int"), F.lit(1))
    r = rows.withColumn("_c", changed).withColumn("_g", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return r.groupBy(key, "_g").agg(F.count(F.lit(1)).alias("_n")).groupBy(key).agg(F.max("_n").alias("longest_run"))


def gap_score(missing: DataFrame, slots_per_day: int = 144, key: str = "id") -> DataFrame:
    """missing: one row per missing slot, with its day. Whole days without a slot weigh 1000, other missing slots 1."""
    by_day = missing.groupBy(key, "day").agg(F.count(F.lit(1)).alias("n"))
    whole = F.count_if(F.col("n") >= slots_per_day)
    out = by_day.groupBy(key).agg(whole.alias("missing_days"), F.coalesce(F.sum(F.when(F.col("n") < slots_per_day, F.col("n"))), F.lit(0)).alias("missing_slots"))
    return out.withColumn("gap_score", F.col("missing_days") * 1000 + F.col("missing_slots"))


def bad_day(source: Column, points: Column, last_updated: Column, day: Column) -> Column:
    """A daily row that is there but no good: invalid, older than its day, weak by its label, or without a point."""
    label = F.lower(F.trim(F.coalesce(source, F.lit(""))))
    stale = F.coalesce(F.to_date(last_updated) < day, F.lit(False))
    return F.coalesce(ohlc_invalid(), F.lit(True)) | stale | F.rlike(label, F.lit("carry|interp|partial")) | F.coalesce(points <= 0, F.lit(False))


def worst_first(findings: DataFrame, size: Column, n: int, *ties: str) -> DataFrame:
    """The n largest findings with their place from 1; a missing size counts as 0."""
    ordered = findings.withColumn("_size", F.coalesce(size, F.lit(0.0))).orderBy(F.desc("_size"), *ties).limit(n)
    place = F.row_number().over(Window.orderBy(F.desc("_size"), *ties))  # over n rows
    return ordered.withColumn("place", place).drop("_size")


def drift(raw: DataFrame, stored: DataFrame, relative: float = 0.03, absolute: float = 50e9, min_rows: int = 700, slot: str = "slot") -> DataFrame:
    """raw: slot, raw_cap, contributors. stored: slot, stored_cap. Findings of slots with enough contributors."""
    j = raw.where(F.col("contributors") >= min_rows).join(stored, slot, "left")
    diff = F.abs(F.col("raw_cap") - F.col("stored_cap"))
    kind = F.when(F.col("stored_cap").isNull(), "missing_all").when((diff >= absolute) & (diff / F.nullif(F.col("raw_cap"), F.lit(0.0)) >= relative), "mismatch_all")
    return j.withColumn("abs_diff", F.coalesce(diff, F.lit(0.0))).withColumn("finding", kind).where("finding is not null")


def freshness(rows: DataFrame, now: Column, max_lag_min: int, window_slots: int, slot: Column, max_missing: int = 2, key: str = "id", ts: str = "ts") -> DataFrame:
    """Minutes since the newest row, slots missing of the last window_slots, and the reasons to heal."""
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    recent = us(F.col(ts)) >= us(now) - window_slots * 600_000_000
    out = rows.groupBy(key).agg(F.max(ts).alias("latest"), F.countDistinct(F.when(recent & (F.col(ts) < now), slot)).alias("slots_seen"))
    out = out.withColumn("lag_min", F.floor((us(now) - us(F.col("latest"))) / 60_000_000).cast("long")).withColumn("missing_slots", F.lit(window_slots) - F.col("slots_seen"))
    reasons = F.array_compact(F.array(F.when(F.col("lag_min") > max_lag_min, "stale"), F.when(F.col("missing_slots") > max_missing, "missing_slots")))
    return out.withColumn("reasons", F.array_join(reasons, ","))
