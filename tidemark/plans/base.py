"""Projections of the given tables onto the engine's data model, in Spark and as SQL fragments, and the query registry."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timeutil import floor_slot
from tidemark.operators import bars

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query with its oracle; {TICKS} and the like in the oracle stand for the fragments below."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = reduce(lambda text, kv: text.replace("{" + kv[0] + "}", kv[1]), FRAGMENTS.items(), sql)
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def source_label(event_id: Column) -> Column:
    """A provenance label that varies over rows."""
    names = ("rolling_carry", "bf_10m_from_hourly:10m_final", "", "repair_rolling_interp", "live_points", "repair_api_points")
    out = F.lit("rolling_direct")
    for k, n in enumerate(names):
        out = F.when(event_id % 10 == k, n).otherwise(out)
    return F.when(event_id % 10 == 6, F.lit(None)).otherwise(out)


def ticks(spark: SparkSession, d: str, key: str = "event_type") -> DataFrame:
    """The event stream as quotes: id, ts, price, market_cap (null for every eleventh), volume_24h, point_count, candle_source."""
    e = table(spark, d, "events")
    return e.select(
        F.col(key).cast("string").alias("id"), "ts", F.col("value").alias("price"), F.when(F.col("event_id") % 11 != 0, F.col("value") * 1000).alias("market_cap"),
        F.col("value").alias("volume_24h"), (F.get_json_object("props", "$.k").cast("int") % 4).alias("point_count"), source_label(F.col("event_id")).alias("candle_source"), "event_id",
    )


def bars_10m(spark: SparkSession, d: str, key: str = "event_type") -> DataFrame:
    return bars.bars_from_ticks(ticks(spark, d, key), floor_slot(F.col("ts")))


def live(spark: SparkSession, d: str) -> DataFrame:
    """Customers as the live snapshot. Every third has no rank; ranks are account balances in ten steps, so they repeat."""
    c = table(spark, d, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("id"), F.upper("c_name").alias("symbol"), F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).when(F.col("c_custkey") % 7 == 1, "  ").otherwise(F.col("c_mktsegment")).alias("category"),
        F.when(F.col("c_custkey") % 3 != 0, F.floor(F.abs("c_acctbal") * 100) % 997 + 1).cast("int").alias("market_cap_rank"), F.col("c_acctbal").alias("market_cap"),
        (F.col("c_acctbal") / 10).alias("volume_24h"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(c_custkey % 1440 as int))").alias("last_updated"), F.col("c_custkey").alias("key"),
    )


def daily(spark: SparkSession, d: str) -> DataFrame:
    """Ship dates as daily rows of parts: OHLC of extended prices in order of order and line."""
    li = table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("id"), F.to_date("l_shipdate").alias("day"), "l_extendedprice", "l_quantity", F.struct("l_orderkey", "l_linenumber").alias("o"))
    return li.groupBy("id", "day").agg(
        F.min_by("l_extendedprice", "o").alias("open"), F.max("l_extendedprice").alias("high"), F.min("l_extendedprice").alias("low"), F.max_by("l_extendedprice", "o").alias("close"),
        F.sum("l_quantity").alias("volume_24h"), F.count(F.lit(1)).alias("point_count"), F.max("l_quantity").cast("int").alias("q"),
    ).select("id", "day", F.when(F.col("q") % 5 != 0, F.col("open")).alias("open"), "high", "low", F.when(F.col("q") % 7 != 0, F.col("close")).alias("close"), F.col("close").alias("price_usd"),
        F.when(F.col("q") % 3 != 0, F.col("volume_24h")).alias("volume_24h"), F.when(F.col("q") % 2 == 0, F.col("close") * 10).alias("market_cap"), F.when(F.col("q") % 4 != 0, F.col("q")).alias("market_cap_rank"), "point_count")


FRAGMENTS = {
    "TICKS": """ticks AS (SELECT event_type AS id, ts, value AS price, CASE WHEN event_id % 11 <> 0 THEN value * 1000 END AS market_cap, value AS volume_24h,
        CAST(json_extract_string(props, '$.k') AS INT) % 4 AS point_count, event_id,
        CASE event_id % 10 WHEN 0 THEN 'rolling_carry' WHEN 1 THEN 'bf_10m_from_hourly:10m_final' WHEN 2 THEN '' WHEN 3 THEN 'repair_rolling_interp'
            WHEN 4 THEN 'live_points' WHEN 5 THEN 'repair_api_points' WHEN 6 THEN NULL ELSE 'rolling_direct' END AS candle_source FROM events)""",
    "USER_TICKS": """ticks AS (SELECT CAST(user_id AS VARCHAR) AS id, ts, value AS price, CASE WHEN event_id % 11 <> 0 THEN value * 1000 END AS market_cap, value AS volume_24h, event_id FROM events)""",
    "BARS": """bars AS (SELECT id, time_bucket(INTERVAL '10 minutes', ts) AS bucket, arg_min(price, ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, ts) AS close,
        count(*) AS point_count, count(*) AS rows_seen, arg_max(market_cap, ts) FILTER (WHERE market_cap IS NOT NULL) AS market_cap, arg_max(volume_24h, ts) AS volume_24h, max(ts) AS last_updated FROM ticks GROUP BY 1, 2)""",
    "LIVE": """live AS (SELECT CAST(c_custkey AS VARCHAR) AS id, upper(c_name) AS symbol, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN '  ' ELSE c_mktsegment END AS category,
        CASE WHEN c_custkey % 3 <> 0 THEN CAST(floor(abs(c_acctbal) * 100) AS BIGINT) % 997 + 1 END AS market_cap_rank, c_acctbal AS market_cap, c_acctbal / 10 AS volume_24h,
        TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 MINUTE * CAST(c_custkey % 1440 AS INT) AS last_updated, c_custkey AS key FROM customer)""",
    "DAILY": """d0 AS (SELECT CAST(l_partkey AS VARCHAR) AS id, CAST(l_shipdate AS DATE) AS day, first(l_extendedprice ORDER BY l_orderkey, l_linenumber) AS open, max(l_extendedprice) AS high,
        min(l_extendedprice) AS low, last(l_extendedprice ORDER BY l_orderkey, l_linenumber) AS close, sum(l_quantity) AS volume_24h, count(*) AS point_count, CAST(max(l_quantity) AS INT) AS q FROM lineitem GROUP BY 1, 2),
        daily AS (SELECT id, day, CASE WHEN q % 5 <> 0 THEN open END AS open, high, low, CASE WHEN q % 7 <> 0 THEN close END AS close, close AS price_usd, CASE WHEN q % 3 <> 0 THEN volume_24h END AS volume_24h,
        CASE WHEN q % 2 = 0 THEN close * 10 END AS market_cap, CASE WHEN q % 4 <> 0 THEN q END AS market_cap_rank, point_count FROM d0)""",
}
