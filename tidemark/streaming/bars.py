"""Structured Streaming façade: watermarked tumbling candles, upserted into a table batch by batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scratch import shared_dir
from tidemark.sources.stored import merge_rows


def tumbling(stream: DataFrame, slot: str = "10 minutes", delay: str = "2 minutes", key: str = "event_type", value: str = "value") -> DataFrame:
    """Candles per key and slot of an event stream (ts, key, value); a slot closes once the watermark has passed it."""
    s = stream.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", delay)
    return s.groupBy(F.col(key).alias("id"), F.window("at", slot).alias("w")).agg(
        F.min_by(value, "at").alias("open"), F.max(value).alias("high"), F.min(value).alias("low"), F.max_by(value, "at").alias("close"), F.count(F.lit(1)).alias("point_count")
    ).select("id", F.col("w.start").cast("timestamp_ntz").alias("bucket"), "open", "high", "low", "close", "point_count")


def _events(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the table at path: a folder of part files, or a single file, which its folder is filtered for."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return stream.parquet(path)
    folder, _, name = path.rpartition("/")
    return stream.option("pathGlobFilter", name).parquet(folder)


def tumbling_once(spark: SparkSession, path: str) -> DataFrame:
    """All that is there now, run through the stream: each candle as it was last, those of slots still open too."""
    out = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    values = ["open", "high", "low", "close", "point_count"]
    schema = "id string, bucket timestamp_ntz, open double, high double, low double, close double, point_count long"
    spark.createDataFrame([], schema).write.parquet(f"{out}/rows/batch=-1")  # an empty table has no batch

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

    q = tumbling(_events(spark, path)).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    rows = spark.read.schema(f"{schema}, batch long").parquet(f"{out}/rows")
    return rows.groupBy("id", "bucket").agg(F.max_by(F.struct(*values), "batch").alias("_last")).select("id", "bucket", *[f"_last.{v}" for v in values])


def upsert_batches(stream: DataFrame, path: str, keys: list[str], checkpoint: str):
    """Starts a stream whose batches replace the partitions (by day) that they touch, merged by key with what is stored there; no
    other partition is read. A batch that is repeated makes the same rows."""

    def write(batch: DataFrame, number: int) -> None:
        merge_rows(batch.withColumn("day", F.to_date("bucket")), f"{path}/rows", keys)

    return stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).start()
