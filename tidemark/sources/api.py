"""Market API payloads: parallel [epoch_ms, value] series as rows; listing pages; request chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES = {"prices": "price", "market_caps": "market_cap", "total_volumes": "volume_24h"}


def chart_points(payloads: DataFrame, column: str = "json") -> DataFrame:
    """id, metric, ts, value from {"prices": [[ms, v], ...], "market_caps": ..., "total_volumes": ...}."""
    parsed = payloads.select("id", F.from_json(column, ", ".join(f"{k} array<array<double>>" for k in SERIES)).alias("p"))
    parts = [parsed.select("id", F.lit(name).alias("metric"), F.explode(f"p.{key}").alias("x")) for key, name in SERIES.items()]
    out = parts[0].union(parts[1]).union(parts[2])
    ts = F.timestamp_micros((F.get("x", F.lit(0)) * 1000).cast("long")).cast("timestamp_ntz")
    return out.select("id", "metric", ts.alias("ts"), F.get("x", F.lit(1)).alias("value"))


def chart_rows(points: DataFrame) -> DataFrame:
    """One row per id and instant with the three metrics beside each other."""
    return points.groupBy("id", "ts").agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in SERIES.values()])


def listing(pages: DataFrame, first_seen: bool = True) -> DataFrame:
    """Assets of listing pages (page, place, id, ...), each once: by its first page, or its last."""
    order = [F.col("page"), F.col("place")] if first_seen else [F.desc("page"), F.desc("place")]
    n = F.row_number().over(Window.partitionBy("id").orderBy(*order))
    return pages.where("id is not null").withColumn("_n", n).where("_n = 1").drop("_n")


def request_chunks(spans: DataFrame, hours: int) -> DataFrame:
    """Spans (id, start, end) cut into chunks of at most so many hours; a chunk ends a second before the next."""
    chunk: Column = F.explode(F.expr(f"sequence(start, end - interval 1 second, interval {hours} hours)"))
    return spans.where("start < end").withColumn("chunk_start", chunk).withColumn("chunk_end", F.least(F.col("end"), F.expr(f"chunk_start + interval {hours} hours")) - F.expr("interval 1 second"))
