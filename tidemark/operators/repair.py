"""Which stored rows to rebuild, finalise, heal or rewrite, and rows made from coarser ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeutil import plus_minutes
from tidemark.operators.audit import ohlc_invalid
from tidemark.operators.provenance import WEAK_FUTURE, authoritative, weak_future


def _unsound(has: Column, source: Column, ts: Column, last_updated: Column, points: Column, least: int) -> Column:
    stale = F.coalesce(last_updated < plus_minutes(ts, -20), F.lit(False))
    return ~has | F.coalesce(ohlc_invalid(), F.lit(True)) | stale | weak_future(source) | (F.coalesce(points, F.lit(0)) < least)


def stale_slot(last_updated: Column, ts: Column) -> Column:
    return F.coalesce(last_updated < plus_minutes(ts, -20), F.lit(False))


def stale_day(last_updated: Column, day: Column) -> Column:
    return F.coalesce(F.to_date(last_updated) < day, F.lit(False))


def stale_live(last_updated: Column, now: Column, minutes: int = 10) -> Column:
    """Worth a warning, no more."""
    return F.coalesce(last_updated < plus_minutes(now, -minutes), F.lit(False))


def catchup(hours: DataFrame, now: Column, recent: int, bootstrap_hours: int, most_hours: int, final: str = "10m_final") -> DataFrame:
    """hours: id, ts, candle_source. Per id the watermark, its latest final hour if that is among its recent last ones, and the
    hour to start from: the one after it, or bootstrap_hours back, but no more than most_hours back."""
    n = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("ts")))
    last = hours.withColumn("_n", n).where(F.col("_n") <= recent)
    w = last.groupBy("id").agg(F.max(F.when(F.col("candle_source") == final, F.col("ts"))).alias("watermark"))
    start = F.coalesce(plus_minutes(F.col("watermark"), 60), plus_minutes(now, -60 * bootstrap_hours))
    return w.withColumn("catchup_start", F.greatest(start, plus_minutes(now, -60 * most_hours)))


def gap_fill_plan(spine: DataFrame, have: DataFrame, lock: Column) -> DataFrame:
    """Per id and lock bucket its missing slots: how many, the first, and that no aggregates are made."""
    missing = spine.join(have, ["id", "slot"], "left_anti")
    return missing.groupBy("id", lock.alias("lock")).agg(F.count(F.lit(1)).alias("slots"), F.min("slot").alias("first_slot"), F.lit(False).alias("aggregates"))


def rollup_with_sources(candles: DataFrame, at: Column) -> DataFrame:
    """Candles (id, bucket, OHLC, candle_source) to id, at, OHLC, points and the set of their labels' leaves."""
    leaf = F.element_at(F.split("candle_source", ":"), -1)
    return candles.withColumn("at", at).groupBy("id", "at").agg(
        F.min_by("open", "bucket").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "bucket").alias("close"),
        F.count(F.lit(1)).alias("points"), F.array_sort(F.collect_set(leaf)).alias("sources"),
    )


def first_of(kinds: dict[str, DataFrame]) -> DataFrame:
    """Candles of the first kind that has the id and time; via names it."""
    out = None
    for kind, rows in kinds.items():
        rows = rows.withColumn("via", F.lit(kind))
        out = rows if out is None else out.unionByName(rows.join(out.select("id", "at"), ["id", "at"], "left_anti"))
    return out


def needs_rebuild(has: Column, source: Column, points: Column, ts: Column, last_updated: Column, final: tuple[str, ...], least: int = 4) -> Column:
    """A closed candle to be rolled up anew. An authoritative row never is."""
    return ~(has & authoritative(source, final, points)) & _unsound(has, source, ts, last_updated, points, least)


def needs_finalise(has: Column, source: Column, points: Column, ts: Column, last_updated: Column, final: tuple[str, ...], least: int = 4, mode: str = "missing_only") -> Column:
    """A closed candle to be asked for at the API; mode: off, missing_only, always."""
    if mode == "off":
        return F.lit(False)
    wanted = F.lit(True) if mode == "always" else _unsound(has, source, ts, last_updated, points, least)
    return ~(has & authoritative(source, final, points)) & wanted


def needs_heal(has: Column, source: Column, points: Column, least: int = 2) -> Column:
    s = F.lower(F.trim(F.coalesce(source, F.lit(""))))
    return ~has | s.isin("", *WEAK_FUTURE) | (F.coalesce(points, F.lit(0)) < least)


def degenerate_api(source: Column, points: Column, label: str = "cg_daily_final") -> Column:
    """A final API row of one point at most: it is written again."""
    return (F.lower(F.trim(F.coalesce(source, F.lit("")))) == label) & (F.coalesce(points, F.lit(0)) <= 1)


def seed_from_daily(days: DataFrame) -> DataFrame:
    """One ten-minute row a second before midnight for each daily row: close, or else price, or else 0."""
    end = F.col("day").cast("timestamp_ntz") + F.expr("interval 86399 seconds")
    zero = F.lit(0.0)
    return days.select("id", end.alias("ts"), F.coalesce("close", "price_usd", zero).alias("price_usd"), F.coalesce("market_cap", zero).alias("market_cap"), F.coalesce("volume_24h", zero).alias("volume_24h"), "market_cap_rank")


def coverage_ratio(targets: DataFrame, have: DataFrame, keys: list[str], entities: DataFrame | None = None) -> DataFrame:
    """Per id the share of its target slots that are there; 1 for entities without a target."""
    if entities is not None:
        some = coverage_ratio(targets, have, keys)
        j = entities.select("id").distinct().join(some, "id", "left")
        return j.select("id", F.coalesce("coverage", F.lit(1.0)).alias("coverage"), F.coalesce("targets", F.lit(0)).alias("targets"))
    j = targets.join(have.select(*keys).distinct().withColumn("_has", F.lit(1)), keys, "left")
    return j.groupBy("id").agg(F.avg(F.coalesce("_has", F.lit(0)).cast("double")).alias("coverage"), F.count(F.lit(1)).alias("targets"))


def advance_availability(counters: DataFrame, day_rows: DataFrame, target: Column) -> DataFrame:
    """Counters after one more day. counters: id, first_day, last_day, expected_days, have_*, open_range_start; day_rows: the
    target day's rows (id, close, volume_24h, market_cap).

    A day already counted changes nothing; the day after the last extends the run; a later one opens a new run, and the
    days between are expected but not there.
    """
    names = ("any", "price", "volume", "mcap")
    seen = {"any": F.lit(1), "price": F.col("close").isNotNull().cast("int"), "volume": F.col("volume_24h").isNotNull().cast("int"), "mcap": F.col("market_cap").isNotNull().cast("int")}
    d = day_rows.select("id", *[seen[n].alias(f"_{n}") for n in names])
    j = counters.join(d, "id", "full")
    got, old = F.col("_any").isNotNull(), F.col("last_day").isNotNull()
    counted = old & (target >= F.col("first_day")) & (target <= F.col("last_day"))
    follows = target == F.date_add("last_day", 1)
    change = got & ~F.coalesce(counted, F.lit(False))
    first = F.when(change & ~old, target).otherwise(F.col("first_day"))
    last = F.when(change, target).otherwise(F.col("last_day"))
    expected = F.when(~change, F.col("expected_days")).when(~old, 1).when(follows, F.col("expected_days") + 1).otherwise(F.datediff(target, F.col("first_day")) + 1)
    opened = F.when(~change, F.col("open_range_start")).when(follows, F.coalesce("open_range_start", "first_day")).otherwise(target)
    have = {n: F.coalesce(F.col(f"have_{n}"), F.lit(0)) + F.when(change, F.col(f"_{n}")).otherwise(0) for n in names}
    return j.select(
        "id", first.alias("first_day"), last.alias("last_day"), expected.cast("long").alias("expected_days"), *[have[n].cast("long").alias(f"have_{n}") for n in names],
        *[F.greatest(expected - have[n], F.lit(0)).cast("long").alias(f"missing_{n}") for n in names], opened.alias("open_range_start"),
    )
