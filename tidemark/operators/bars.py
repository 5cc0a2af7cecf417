"""OHLC candles from ticks, from candles, and by month; last known metrics; overlay of a live quote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("market_cap", "volume_24h")


def last_known(value: str, order: str) -> Column:
    """The latest value that isn't null."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))


def bars_from_ticks(ticks: DataFrame, bucket: Column, price: str = "price", order: str = "ts", strong: Column | None = None) -> DataFrame:
    """Per id and bucket: OHLC over priced ticks (over the strong ones, if asked), counts, last known metrics of all ticks."""
    counted = F.col(price).isNotNull() if strong is None else F.col(price).isNotNull() & strong
    p, o = F.when(counted, F.col(price)), F.when(counted, F.col(order))
    return (
        ticks.withColumn("bucket", bucket).groupBy("id", "bucket").agg(
            F.min_by(p, o).alias("open"), F.max(p).alias("high"), F.min(p).alias("low"), F.max_by(p, o).alias("close"),
            F.count(p).alias("point_count"), F.count(F.lit(1)).alias("rows_seen"),
            *[last_known(m, order).alias(m) for m in METRICS if m in ticks.columns], F.max(order).alias("last_updated"),
        )
    )


def bars_from_bars(candles: DataFrame, bucket: Column, order: str = "bucket") -> DataFrame:
    """Coarser candles: first price by open, close, high, low; last close; extremes over all four; points added."""
    first = F.coalesce("open", "close", "high", "low")
    last = F.coalesce("close", "open", "high", "low")
    top = F.greatest("high", "open", "close")
    bottom = F.least("low", "open", "close")
    o = F.when(first.isNotNull(), F.col(order))
    return (
        candles.withColumn("_up", bucket).groupBy("id", "_up").agg(
            F.min_by(first, o).alias("open"), F.max(top).alias("high"), F.min(bottom).alias("low"), F.max_by(last, o).alias("close"),
            F.sum("point_count").alias("point_count"), F.count(F.lit(1)).alias("rows_seen"),
            *[last_known(m, order).alias(m) for m in METRICS if m in candles.columns], F.max("last_updated").alias("last_updated"),
        ).withColumnRenamed("_up", "bucket")
    )


def monthly(daily: DataFrame, day: str = "day", volume: str = "volume_24h") -> DataFrame:
    """Monthly candles: first open and last close there is, extremes with fallbacks, volumes added, last known metrics.

    A month without any price gives no row.
    """
    first, last = F.coalesce("open", "close", "price_usd"), F.coalesce("close", "open", "price_usd")
    at = F.when(first.isNotNull(), F.col(day))
    out = daily.groupBy("id", F.date_format(day, "yyyy-MM").alias("year_month")).agg(
        F.min_by(first, at).alias("open"), F.max(F.coalesce("high", "close", "open", "price_usd")).alias("high"),
        F.min(F.coalesce("low", "close", "open", "price_usd")).alias("low"), F.max_by(last, at).alias("close"),
        F.sum(volume).alias("volume"), last_known("market_cap", day).alias("market_cap"),
        last_known("market_cap_rank", day).alias("market_cap_rank"), F.count(F.lit(1)).alias("days"),
    )
    return out.where("open is not null and close is not null")


def overlay_live(candles: DataFrame, live: DataFrame, start: Column, end: Column) -> DataFrame:
    """Open-bucket candles merged with a live quote that is not older than the bucket.

    live: id, price, last_updated and metrics. Open stays, close follows the quote, extremes take it in; points are at least
    one. A quote from after the bucket counts as of its last second. Metrics that the quote has replace the candle's.
    """
    both = [m for m in METRICS if m in live.columns and m in candles.columns]
    q = live.select(F.col("id").alias("_id"), F.col("price").alias("_p"), F.col("last_updated").alias("_lu"), *[F.col(m).alias(f"_{m}") for m in both])
    at = F.when(F.col("_lu") < end, F.col("_lu")).otherwise(end - F.expr("interval 1 second"))
    use = F.col("_p").isNotNull() & (F.col("_lu") >= start)
    pick = lambda new, old: F.when(use, new).otherwise(F.col(old))
    j = candles.join(q, candles["id"] == q["_id"], "left")
    o, h, lo, c, p = (F.col(x) for x in ("open", "high", "low", "close", "_p"))
    out = j.select(
        "id", "bucket", pick(F.coalesce(o, c, p), "open").alias("open"), pick(F.greatest(h, lo, c, o, p), "high").alias("high"),
        pick(F.least(h, lo, c, o, p), "low").alias("low"), pick(p, "close").alias("close"),
        pick(F.greatest(F.lit(1), F.coalesce("point_count", F.lit(0))), "point_count").cast("long").alias("point_count"),
        *[pick(F.coalesce(f"_{m}", m), m).alias(m) for m in both],
        F.greatest(F.col("last_updated"), F.when(use, at)).alias("last_updated"), F.when(use, "live_partial").otherwise("10m_partial").alias("candle_source"),
    )
    return out


def bars_from_points(points: DataFrame, bucket: Column, min_points: int = 2) -> DataFrame:
    """OHLC from API points (id, ts, value): only buckets with enough points."""
    return bars_from_ticks(points, bucket, price="value").where(F.col("point_count") >= min_points)
