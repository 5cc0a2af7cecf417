"""Stored tables: catalogue, schemas, guarded refresh, partition replacement, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CANDLE = "symbol string, name string, open double, high double, low double, close double, price_usd double, market_cap double, volume_24h double, market_cap_rank int, circulating_supply double, total_supply double, candle_source string, last_updated timestamp_ntz, point_count int"
#: The stored tables' columns.
SCHEMAS = {
    "candles_10m": f"id string, ts timestamp_ntz, {_CANDLE}, volume_interval_est double",
    "candles_hourly": f"id string, ts timestamp_ntz, {_CANDLE}",
    "candles_daily": f"id string, day date, {_CANDLE}",
    "candles_monthly": "id string, year_month string, symbol string, name string, open double, high double, low double, close double, volume double, market_cap double, market_cap_rank int, circulating_supply double, total_supply double, candle_source string, last_updated timestamp_ntz",
    "category_totals": "category string, ts timestamp_ntz, last_updated timestamp_ntz, market_cap double, market_cap_rank int, volume_24h double",
    "slot_quality": "day date, ts timestamp_ntz, run_mode string, source string, note string, coin_count int, required_ids_ok boolean, missing_required_ids string, raw_all double, written_all double, prev_all double, coverage_ratio double, drop_pct double, is_quarantined boolean, is_carried boolean, last_updated timestamp_ntz",
    "coverage_ranges": "id string, start_date date, end_date date, detected_at timestamp_ntz",
    "intraday_coverage": "id string, granularity tinyint, day date, bitmap binary, set_count int, first_seen timestamp_ntz, last_seen timestamp_ntz",
    "fx_daily": "provider string, base string, symbol string, asof_year int, asof_date date, rate double, source string",
    "pipeline_runs": "script string, started_at timestamp_ntz, run_id string, workflow string, trigger_source string, scope string, rank_start int, rank_end int, status string, ended_at timestamp_ntz, duration_sec int, metrics_json string, error string, host string, updated_at timestamp_ntz",
}


def create(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """An empty table of a known kind, if the path holds none."""
    try:
        return spark.read.schema(SCHEMAS[kind]).parquet(path)
    except Exception as e:  # noqa: BLE001  Spark's own exception for a missing path
        if "PATH_NOT_FOUND" not in str(e):
            raise
    spark.createDataFrame([], SCHEMAS[kind]).write.parquet(path)
    return spark.read.schema(SCHEMAS[kind]).parquet(path)


def refresh_if_enough(df: DataFrame, path: str, least: int) -> bool:
    """Replaces a snapshot only if the new one has enough rows."""
    if df.limit(least).count() < least:
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def replace_partitions(df: DataFrame, path: str, *keys: str) -> None:
    """Overwrites the partitions that df has rows for, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def retained(df: DataFrame, column: str, now: Column, days: int) -> DataFrame:
    """Rows younger than a time to live."""
    return df.where(F.col(column) >= now - F.make_dt_interval(days=F.lit(days)))


def describe(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def record_runs(runs: DataFrame, path: str, key: str = "script", at: str = "updated_at") -> tuple[DataFrame, DataFrame]:
    """Run-health rows appended to path/history and merged into path/latest (one row a key, the newest); returns both tables.

    The latest table is written beside the old one and named by a number, so that a lost run leaves the old one whole.
    """
    spark = runs.sparkSession
    runs.write.mode("append").parquet(f"{path}/history")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/latest")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    numbers = sorted(int(s.getPath().getName()) for s in fs.listStatus(folder)) if fs.exists(folder) else []
    rows = runs if not numbers else runs.unionByName(spark.read.schema(runs.schema).parquet(f"{path}/latest/{numbers[-1]}"))
    latest = rows.groupBy(key).agg(F.max_by(F.struct(*runs.columns), F.col(at)).alias("m")).select("m.*")
    now = f"{path}/latest/{numbers[-1] + 1 if numbers else 0}"
    latest.write.parquet(now)
    return spark.read.schema(runs.schema).parquet(f"{path}/history"), spark.read.schema(latest.schema).parquet(now)
