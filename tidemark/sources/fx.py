"""FX rates: payloads to rows, and incremental publication behind a watermark."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.merge import upsert
from tidemark.sources.stored import exists, merge_rows


def latest_payload(json: Column) -> Column:
    """{"date": d, "rates": {symbol: rate}} as a struct."""
    return F.from_json(json, "date date, rates map<string,double>")


def range_payload(payloads: DataFrame, column: str = "json") -> DataFrame:
    """{"rates": {day: {symbol: rate}}} as rows: asof_date, symbol, rate."""
    days = payloads.select(F.explode(F.from_json(column, "rates map<string,map<string,double>>")["rates"]).alias("day", "r"))
    return days.select(F.to_date("day").alias("asof_date"), F.explode("r").alias("symbol", "rate"))


def new_rates(rates: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Rates after their symbol's watermark, with latest: the symbol's newest, which the live table takes."""
    fresh = rates.join(watermarks, "symbol").where(F.col("asof_date") > F.col("watermark"))
    newest = F.max("asof_date").over(Window.partitionBy("symbol"))
    return fresh.withColumn("asof_year", F.year("asof_date")).withColumn("latest", F.col("asof_date") == newest)


def next_watermark(old: Column, latest: Column, range_failed: Column) -> Column:
    """A failed range keeps the watermark, an empty one moves it to the provider's latest date."""
    return F.when(range_failed, old).otherwise(F.greatest(old, latest))


STATUS = "mode string, latest_date date, live int"
RATES = "symbol string, asof_date date, rate double"


def status_of(spark: SparkSession, path: str, before: int | None = None) -> tuple:
    """(mode, latest_date, live) of the newest run, or of the newest before a number; nulls if there is none."""
    if not exists(spark, f"{path}/status"):
        return None, None, None
    rows = spark.read.schema(f"{STATUS}, run int").parquet(f"{path}/status")
    rows = rows if before is None else rows.where(F.col("run") < before)
    return tuple(rows.agg(F.max_by(F.struct("mode", "latest_date", "live"), "run").alias("s")).select("s.*").first())


def live_rates(spark: SparkSession, path: str) -> DataFrame:
    """The live table that the newest status names; none before the first run."""
    version = status_of(spark, path)[2]
    if version is None:
        return spark.createDataFrame([], RATES)
    return spark.read.schema(RATES).parquet(f"{path}/live/version={version}")


def publish(spark: SparkSession, path: str, run: int, today: date, latest: DataFrame | None, span: DataFrame | None, stale_days: int = 3) -> str:
    """One run of the rate loader: history (by year), the live table and the status, in an order that can be repeated.

    latest: the provider's newest day (RATES), none if it could not be fetched; span: its days since the watermark, none if that
    failed. Days after the watermark go to the history and, in order of time, to the live table; the watermark moves to the last
    of them. A failed span publishes the latest day and keeps the watermark (degraded), an empty one moves it. Without the latest
    day, a watermark at most stale_days old is good enough; otherwise the run fails. Readers follow the status row, which is
    written last and names the live table; a run that is repeated sees only what earlier runs left.
    """
    _, mark, live = status_of(spark, path, run)
    if latest is None:
        if mark is None or max(0, (today - mark).days) > stale_days:
            raise RuntimeError(f"no rates: the latest fetch failed, and the watermark is {mark}")
        return _finish(spark, path, run, "stale", mark, live)
    newest = latest.agg(F.max("asof_date")).first()[0]
    if newest is None:
        raise RuntimeError("no rates: the latest payload has no date")
    if mark is None:
        mode, rows, moved = "first", latest, newest
    elif mark >= newest:
        mode, rows, moved = "refresh", latest, mark
    elif span is None:
        mode, rows, moved = "degraded", latest, mark
    else:
        last = span.agg(F.max("asof_date")).first()[0]
        if last is None:
            mode, rows, moved = "empty", latest, newest
        else:
            fresh = span.where(F.col("asof_date") > F.lit(mark))
            has_newest = bool(span.where(F.col("asof_date") == F.lit(newest)).limit(1).count())
            extra = not has_newest and newest > (last if last > mark else date.min)
            rows = fresh.unionByName(latest) if extra else fresh
            mode, moved = "span", max(newest if extra else mark, last if last > mark else mark)
    rows = rows.select("symbol", "asof_date", "rate")
    merge_rows(rows.withColumn("asof_year", F.year("asof_date")), f"{path}/history", ["symbol", "asof_date"], "asof_year")
    before = spark.createDataFrame([], RATES) if live is None else spark.read.schema(RATES).parquet(f"{path}/live/version={live}")
    newest_of = rows.groupBy("symbol").agg(F.max_by(F.struct("asof_date", "rate"), "asof_date").alias("r")).select("symbol", "r.*")
    upsert(before, newest_of, ["symbol"]).write.mode("overwrite").parquet(f"{path}/live/version={run}")
    return _finish(spark, path, run, mode, moved, run)


def _finish(spark: SparkSession, path: str, run: int, mode: str, mark: date, live: int | None) -> str:
    spark.createDataFrame([(mode, mark, live)], STATUS).coalesce(1).write.mode("overwrite").parquet(f"{path}/status/run={run}")
    return mode
