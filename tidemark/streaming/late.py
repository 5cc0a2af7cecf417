"""Late data: hourly candles of a stream whose rows come up to some hours late, partial until they can't change, then final.

Each run stores its arrivals, computes anew the hours of the days that they lie in from the stored ticks of those days only, and
replaces those days' partitions. An hour is partial while it is open or may still get rows: until the clock (the newest ts seen)
is lookback hours past its end. Then it is final: given out once as such, and never changed again; rows that come for it even
later are set aside.

Tables under path: ticks (by run and day), clock (by run), hours (by day), emitted (what a run has changed) and too_late (by
run). A run that is repeated makes the same rows: hours carry the run that changed them last, and a run takes for given only
what earlier runs left.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.timeutil import floor_hour
from tidemark.operators import bars
from tidemark.sources import stored

TICKS = "id string, ts timestamp_ntz, price double"
HOURS = "id string, bucket timestamp_ntz, open double, high double, low double, close double, point_count long, candle_source string, changed_in long"
FINAL, PARTIAL = "10m_final", "10m_partial"


def apply_arrivals(batch: DataFrame, number: int, path: str, lookback_hours: int = 6) -> None:
    """One run of the stream over batch (id, ts, price)."""
    spark = batch.sparkSession
    fresh = batch.select("id", "ts", "price").where("ts is not null").withColumn("day", F.to_date("ts"))
    fresh.write.mode("overwrite").partitionBy("day").parquet(f"{path}/ticks/batch={number}")
    ticks = spark.read.schema(f"{TICKS}, batch long, day date").parquet(f"{path}/ticks").where(F.col("batch") <= number)
    arrived = ticks.where(F.col("batch") == number)
    newest, before = arrived.agg(F.max("ts")).first()[0], _clock(spark, path, number)
    now = max(filter(None, (newest, before)), default=None)
    spark.createDataFrame([(now,)], "now timestamp_ntz").write.mode("overwrite").parquet(f"{path}/clock/batch={number}")
    if now is None:
        return
    days = set(stored.touched(arrived))
    if before is not None:  # hours that have become final since the run before
        first, last = (t - timedelta(hours=lookback_hours + 1) for t in (before, now))
        days |= {first.date() + timedelta(days=k) for k in range((last.date() - first.date()).days + 1)}
    days = sorted(days)
    known = stored.pruned(spark, f"{path}/hours", f"{HOURS}, day date", days).where(F.col("changed_in") < number)
    kept = known.where(F.col("candle_source") == FINAL)
    candles = bars.bars_from_ticks(ticks.where(F.col("day").isin(days)), floor_hour(F.col("ts"))).where("point_count > 0")
    final = F.col("bucket") + F.expr(f"interval {lookback_hours + 1} hours") <= F.lit(now)
    open_ = candles.join(kept.select("id", "bucket"), ["id", "bucket"], "left_anti").withColumn("candle_source", F.when(final, FINAL).otherwise(PARTIAL))
    values = [c.split()[0] for c in HOURS.split(", ")][:-1]
    old = known.select(F.col("id").alias("_id"), F.col("bucket").alias("_bucket"), F.struct(*values).alias("_old"), "changed_in")
    j = open_.join(old, (F.col("id") == F.col("_id")) & (F.col("bucket") == F.col("_bucket")), "left")
    changed_in = F.when(F.struct(*values) == F.col("_old"), F.col("changed_in")).otherwise(number).cast("long")
    made = j.select(*values, changed_in.alias("changed_in"), F.to_date("bucket").alias("day"))
    late = arrived.join(kept.select(F.col("id").alias("_id"), F.col("bucket").alias("_b")), (F.col("id") == F.col("_id")) & (floor_hour(F.col("ts")) == F.col("_b")), "left_semi")
    late.select("id", "ts", "price").write.mode("overwrite").parquet(f"{path}/too_late/batch={number}")
    made.where(F.col("changed_in") == number).drop("day").write.mode("overwrite").parquet(f"{path}/emitted/batch={number}")
    stored.replace_partitions(kept.select(*values, "changed_in", "day").unionByName(made), f"{path}/hours", "day")


def _clock(spark: SparkSession, path: str, number: int):
    if not stored.exists(spark, f"{path}/clock"):
        return None
    rows = spark.read.schema("now timestamp_ntz, batch long").parquet(f"{path}/clock").where(F.col("batch") < number)
    return rows.agg(F.max("now")).first()[0]


def late_hours(stream: DataFrame, path: str, checkpoint: str, lookback_hours: int = 6) -> StreamingQuery:
    """Starts the stream over what there is now (id, ts, price)."""
    writer = stream.writeStream.foreachBatch(lambda batch, number: apply_arrivals(batch, number, path, lookback_hours))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def in_runs(rows: DataFrame, part: Column, runs: int, path: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """rows as they would arrive in so many runs (part: the number of a row's run), each over what has come by then."""
    for n in range(runs):
        rows.where(part == n).write.mode("append").parquet(path)
        q = start(rows.sparkSession.readStream.schema(rows.schema).parquet(path))
        q.awaitTermination()
        if q.exception():
            raise q.exception()


def equal_spans(rows: DataFrame, at: Column, runs: int) -> Column:
    """The number of the span, of so many equally long ones, in which an instant lies."""
    us = F.unix_micros(at.cast("timestamp"))
    first, last = rows.agg(F.min(us), F.max(us)).first()
    return F.lit(0) if first is None else F.floor((us - first) / ((last - first) // runs + 1))
