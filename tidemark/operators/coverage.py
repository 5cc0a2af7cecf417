"""Coverage: contiguous ranges, availability counters, slot bitmaps, request windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def day_ranges(days: DataFrame, key: str = "id", day: str = "day") -> DataFrame:
    """Contiguous ranges of the days an id has."""
    d = days.select(key, day).distinct()
    n = F.row_number().over(Window.partitionBy(key).orderBy(day))
    return d.withColumn("_g", F.date_sub(F.col(day), n)).groupBy(key, "_g").agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"), F.count(F.lit(1)).alias("days")).drop("_g")


def open_range_start(ranges: DataFrame, target: Column, key: str = "id") -> DataFrame:
    """Per id the start of the range that holds the target day, null if none."""
    held = F.when((F.col("start_date") <= target) & (target <= F.col("end_date")), F.col("start_date"))
    return ranges.groupBy(key).agg(F.max(held).alias("open_range_start"))


def availability(rows: DataFrame, window_days: Column, key: str = "id", day: str = "day") -> DataFrame:
    """Days with any row, a price, a volume, a market cap, against the days of the window."""
    out = rows.groupBy(key).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.countDistinct(day).alias("have_any"),
        *[F.countDistinct(F.when(F.col(c).isNotNull(), F.col(day))).alias(f"have_{n}") for n, c in (("price", "close"), ("volume", "volume_24h"), ("mcap", "market_cap"))],
    ).withColumn("expected_days", window_days.cast("long"))
    for n in ("any", "price", "volume", "mcap"):
        out = out.withColumn(f"missing_{n}", F.col("expected_days") - F.col(f"have_{n}"))
    return out


def slot_sets(rows: DataFrame, slot: Column, day: Column, ts: str = "ts", key: str = "id") -> DataFrame:
    """Per id and day the distinct slots, how many, first and last seen. A day has a bounded number of slots."""
    return rows.withColumn("day", day).withColumn("_slot", slot).groupBy(key, "day").agg(
        F.sort_array(F.collect_set("_slot")).alias("slots"), F.countDistinct("_slot").alias("set_count"), F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen")
    )


def clip_ranges(ranges: DataFrame, low: Column, high: Column, key: str = "id") -> DataFrame:
    """The days of ranges within [low, high]."""
    a, b = F.greatest(F.col("start_date"), low), F.least(F.col("end_date"), high)
    return ranges.where((F.col("start_date") <= high) & (F.col("end_date") >= low)).select(key, F.explode(F.sequence(a, b)).alias("day"))


def padded_windows(ranges: DataFrame, pad: int, low: Column, high: Column, longest: int, key: str = "id") -> DataFrame:
    """Ranges widened by pad days, clamped to [low, high], cut to at most longest days."""
    a, b = F.greatest(F.date_sub("start_date", pad), low), F.least(F.date_add("end_date", pad), high)
    r = ranges.withColumn("_a", a).withColumn("_b", b).where("_a <= _b")
    cut = r.withColumn("window_start", F.explode(F.expr(f"sequence(_a, _b, interval {longest} days)")))
    return cut.withColumn("window_end", F.least(F.col("_b"), F.date_add("window_start", longest - 1))).drop("_a", "_b")


def slot_bitmaps(rows: DataFrame, slot: Column, day: Column, ts: str = "ts", key: str = "id", slots: int = 144) -> DataFrame:
    """Per id and day the bitmap of the slots that have a row (bit slot % 8 of byte slot / 8), and first and last seen.

    The bits are set before the shuffle; a bitmap is cut to the bytes that a day's slots need.
    """
    at = F.bitmap_bit_position((slot + 1).cast("long"))
    maps = rows.withColumn("day", day).groupBy(key, "day").agg(F.bitmap_construct_agg(at).alias("bitmap"), F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))
    return maps.withColumn("bitmap", F.substring("bitmap", 1, -(-slots // 8)))


def merged_bitmaps(stored: DataFrame, keys: list[str], slots: int = 144) -> DataFrame:
    """Stored bitmaps ORed by keys, with the number of set slots, first and last seen; no slot is looked at again."""
    out = stored.groupBy(*keys).agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    return out.withColumn("bitmap", F.substring("bitmap", 1, -(-slots // 8))).withColumn("set_count", F.bitmap_count("bitmap"))
