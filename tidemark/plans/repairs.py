"""Queries on decisions: rebuild, finalise, heal, seed, advance; and lookups, caches and top lists."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import rounded
from tidemark.functions.timeutil import floor_hour
from tidemark.operators import coverage, fill, repair
from tidemark.operators.provenance import FINAL_HOURLY
from tidemark.plans.base import bars_10m, daily, query, source_label, table, ticks
from tidemark.plans.series import INTERP, SPINE, _interp_input, _spine, missing_slots

HOURS = """hrs AS (SELECT id, date_trunc('hour', bucket) AS ts, arg_min(open, bucket) AS open, max(high) AS high, min(low) AS low, arg_max(close, bucket) AS close, CAST(sum(point_count) AS BIGINT) AS points, max(last_updated) AS last_updated, CAST(extract(hour FROM min(bucket)) AS INT) AS h FROM bars GROUP BY 1, 2),
    st AS (SELECT *, h % 7 <> 6 AS has, CASE h % 7 WHEN 0 THEN 'cg_hourly_final' WHEN 1 THEN '10m_partial' WHEN 2 THEN '' WHEN 3 THEN 'repair_carry' ELSE '10m_final' END AS src FROM hrs),
    f AS (SELECT *, src = 'cg_hourly_final' AND points >= 2 AND has AS auth, NOT has OR src = '' OR src LIKE '%carry%' OR src LIKE '%partial%' OR points < 4 AS unsound FROM st)"""


def _stored_hours(spark: SparkSession, d: str) -> DataFrame:
    b = bars_10m(spark, d).withColumn("ts", floor_hour(F.col("bucket")))
    hrs = b.groupBy("id", "ts").agg(F.min_by("open", "bucket").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "bucket").alias("close"), F.sum("point_count").alias("points"), F.max("last_updated").alias("last_updated"))
    h = F.hour("ts") % 7
    src = F.when(h == 0, "cg_hourly_final").when(h == 1, "10m_partial").when(h == 2, "").when(h == 3, "repair_carry").otherwise("10m_final")
    return hrs.withColumn("has", h != 6).withColumn("src", src)


@query("rebuild_finalize_decision", "WITH {TICKS}, {BARS}, " + HOURS + """ SELECT id, ts, NOT auth AND unsound AS rebuild, NOT auth AND unsound AS finalise, NOT auth AS finalise_always, NOT has OR src IN ('', 'carry_prev', 'repair_carry', 'repair_api_interp', 'live_partial', '10m_partial') OR points < 2 AS heal FROM f""")
def rebuild_finalize_decision(spark: SparkSession, d: str) -> DataFrame:
    args = (F.col("has"), F.col("src"), F.col("points"), F.col("ts"), F.col("last_updated"), FINAL_HOURLY)
    return _stored_hours(spark, d).select(
        "id", "ts", repair.needs_rebuild(*args).alias("rebuild"), repair.needs_finalise(*args).alias("finalise"), repair.needs_finalise(*args, mode="always").alias("finalise_always"),
        repair.needs_heal(F.col("has"), F.col("src"), F.col("points")).alias("heal"),
    )


@query("degenerate_api_days", "WITH {DAILY} SELECT id, day FROM daily WHERE point_count <= 1 AND extract(day FROM day) % 2 = 0")
def degenerate_api_days(spark: SparkSession, d: str) -> DataFrame:
    src = F.when(F.day("day") % 2 == 0, "cg_daily_final").otherwise("10m_final")
    return daily(spark, d).where(repair.degenerate_api(src, F.col("point_count"))).select("id", "day")


@query("seed_10m_from_daily", "WITH {DAILY} SELECT id, CAST(day AS TIMESTAMP) + INTERVAL 86399 SECOND AS ts, coalesce(close, price_usd, 0.0) AS price_usd, coalesce(market_cap, 0.0) AS market_cap, coalesce(volume_24h, 0.0) AS volume_24h, market_cap_rank FROM daily")
def seed_10m_from_daily(spark: SparkSession, d: str) -> DataFrame:
    return repair.seed_from_daily(daily(spark, d))


@query("target_coverage_ratio", f"WITH {SPINE}, {{TICKS}}, {{BARS}} SELECT s.id, round(avg(CASE WHEN b.id IS NULL THEN 0.0 ELSE 1.0 END), 9) AS coverage, count(*) AS targets FROM spine s LEFT JOIN bars b ON b.id = s.id AND b.bucket = s.slot GROUP BY 1")
def target_coverage_ratio(spark: SparkSession, d: str) -> DataFrame:
    have = bars_10m(spark, d).select("id", F.col("bucket").alias("slot"))
    return repair.coverage_ratio(_spine(spark, d), have, ["id", "slot"]).withColumn("coverage", F.round("coverage", 9))


ADVANCE = """, c AS (SELECT id, min(day) AS first_day, max(day) AS last_day, count(DISTINCT day) AS have_any, count(DISTINCT CASE WHEN close IS NOT NULL THEN day END) AS have_price, count(DISTINCT CASE WHEN volume_24h IS NOT NULL THEN day END) AS have_volume,
    count(DISTINCT CASE WHEN market_cap IS NOT NULL THEN day END) AS have_mcap FROM daily WHERE day < DATE '1998-07-02' GROUP BY 1),
    k AS (SELECT *, CAST(last_day - first_day + 1 AS BIGINT) AS expected_days, last_day AS open_range_start FROM c), t AS (SELECT * FROM daily WHERE day = DATE '1998-07-02'),
    j AS (SELECT coalesce(k.id, t.id) AS id, k.* EXCLUDE (id), t.id IS NOT NULL AND coalesce(last_day < DATE '1998-07-02', true) AS change, t.close AS tc, t.volume_24h AS tv, t.market_cap AS tm FROM k FULL JOIN t ON t.id = k.id),
    n AS (SELECT id, CASE WHEN change AND first_day IS NULL THEN DATE '1998-07-02' ELSE first_day END AS first_day, CASE WHEN change THEN DATE '1998-07-02' ELSE last_day END AS last_day,
        CAST(CASE WHEN NOT change THEN expected_days WHEN last_day IS NULL THEN 1 WHEN last_day + 1 = DATE '1998-07-02' THEN expected_days + 1 ELSE DATE '1998-07-02' - first_day + 1 END AS BIGINT) AS expected_days,
        coalesce(have_any, 0) + CASE WHEN change THEN 1 ELSE 0 END AS have_any, coalesce(have_price, 0) + CASE WHEN change AND tc IS NOT NULL THEN 1 ELSE 0 END AS have_price,
        coalesce(have_volume, 0) + CASE WHEN change AND tv IS NOT NULL THEN 1 ELSE 0 END AS have_volume, coalesce(have_mcap, 0) + CASE WHEN change AND tm IS NOT NULL THEN 1 ELSE 0 END AS have_mcap,
        CASE WHEN NOT change THEN open_range_start WHEN last_day + 1 = DATE '1998-07-02' THEN coalesce(open_range_start, first_day) ELSE DATE '1998-07-02' END AS open_range_start FROM j)"""


@query("availability_incremental", "WITH {DAILY}" + ADVANCE + """ SELECT *, greatest(expected_days - have_any, 0) AS missing_any, greatest(expected_days - have_price, 0) AS missing_price, greatest(expected_days - have_volume, 0) AS missing_volume, greatest(expected_days - have_mcap, 0) AS missing_mcap FROM n""")
def availability_incremental(spark: SparkSession, d: str) -> DataFrame:
    target = F.lit(date(1998, 7, 2))
    days = daily(spark, d)
    past = days.where(F.col("day") < target)
    span = F.datediff(F.max("day"), F.min("day")) + 1
    counters = coverage.availability(past, F.lit(0)).drop("expected_days", *[f"missing_{n}" for n in ("any", "price", "volume", "mcap")])
    counters = counters.join(past.groupBy("id").agg(span.cast("long").alias("expected_days"), F.max("day").alias("open_range_start")), "id")
    return repair.advance_availability(counters, days.where(F.col("day") == target), target)


@query("daily_repaired_from_10m", """WITH {TICKS}, {BARS} SELECT id, CAST(bucket AS DATE) AS day, arg_min(close, bucket) AS open, max(close) AS high, min(close) AS low, arg_max(close, bucket) AS close, arg_max(market_cap, bucket) FILTER (WHERE market_cap IS NOT NULL) AS market_cap FROM bars GROUP BY 1, 2""")
def daily_repaired_from_10m(spark: SparkSession, d: str) -> DataFrame:
    """Days from ten-minute closes in order of time, weak ones too, with the last known metrics."""
    from tidemark.operators.bars import last_known

    return bars_10m(spark, d).groupBy("id", F.to_date("bucket").alias("day")).agg(
        F.min_by("close", "bucket").alias("open"), F.max("close").alias("high"), F.min("close").alias("low"), F.max_by("close", "bucket").alias("close"), last_known("market_cap", "bucket").alias("market_cap")
    )


@query("interp_flat_edges", INTERP + " SELECT id, slot, round(coalesce(value, inner_value, lv, rv), 6) AS filled FROM m")
def interp_flat_edges(spark: SparkSession, d: str) -> DataFrame:
    """Interpolated at the instant, flat beyond both ends, whatever the gap."""
    return fill.interpolate(_interp_input(spark, d), edges=True).select("id", "slot", rounded(F.col("filled"), 6).alias("filled"))


@query("negative_cache_filter", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error')")
def negative_cache_filter(spark: SparkSession, d: str) -> DataFrame:
    """Ids without those that are known to have no data."""
    none = table(spark, d, "events").where("event_type = 'error'").select(F.col("user_id").alias("o_custkey"))
    return table(spark, d, "orders").select("o_custkey").distinct().join(none, "o_custkey", "left_anti")


@query("point_lookup_bulk", "WITH {DAILY} SELECT l_orderkey, l_linenumber, close FROM lineitem JOIN daily ON daily.id = CAST(l_partkey AS VARCHAR) AND daily.day = CAST(l_shipdate AS DATE)")
def point_lookup_bulk(spark: SparkSession, d: str) -> DataFrame:
    """Point lookups by id and day as one equi-join."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("id"), F.to_date("l_shipdate").alias("day"))
    return li.join(daily(spark, d).select("id", "day", "close"), ["id", "day"]).select("l_orderkey", "l_linenumber", "close")


@query("worst_gap_offenders", f"WITH {SPINE}, {{TICKS}}, {{BARS}}, m AS (SELECT id, slot FROM spine EXCEPT SELECT id, bucket FROM bars) SELECT id, count(*) AS missing FROM m GROUP BY 1 ORDER BY missing DESC, id LIMIT 5")
def worst_gap_offenders(spark: SparkSession, d: str) -> DataFrame:
    return missing_slots(spark, d).groupBy("id").agg(F.count(F.lit(1)).alias("missing")).orderBy(F.desc("missing"), "id").limit(5)


@query("stored_observed_intersection", """WITH {TICKS}, s AS (SELECT DISTINCT id, time_bucket(INTERVAL '10 minutes', ts) AS slot FROM ticks WHERE event_id % 2 = 0), r AS (SELECT DISTINCT id, time_bucket(INTERVAL '10 minutes', ts) AS slot FROM ticks WHERE event_id % 3 = 0) SELECT id, slot FROM s INTERSECT SELECT id, slot FROM r""")
def stored_observed_intersection(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.functions.timeutil import floor_slot

    t = ticks(spark, d).withColumn("slot", floor_slot(F.col("ts")))
    return t.where("event_id % 2 = 0").select("id", "slot").intersect(t.where("event_id % 3 = 0").select("id", "slot"))


@query("bad_hours_scan", "WITH {TICKS}, {BARS}, h AS (SELECT id, date_trunc('hour', bucket) AS ts, arg_max(market_cap, bucket) FILTER (WHERE market_cap IS NOT NULL) AS cap, CAST(extract(hour FROM min(bucket)) AS INT) AS h FROM bars GROUP BY 1, 2) SELECT id, ts, cap IS NULL OR cap <= 0 AS no_cap, h % 10 = 3 AS interpolated FROM h WHERE cap IS NULL OR cap <= 0 OR h % 10 = 3")
def bad_hours_scan(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.operators.bars import last_known

    h = bars_10m(spark, d).withColumn("ts", floor_hour(F.col("bucket"))).groupBy("id", "ts").agg(last_known("market_cap", "bucket").alias("cap"))
    no_cap = F.col("cap").isNull() | (F.col("cap") <= 0)
    interpolated = F.coalesce(F.contains(source_label(F.hour("ts")), F.lit("interp")), F.lit(False))
    return h.where(no_cap | interpolated).select("id", "ts", no_cap.alias("no_cap"), interpolated.alias("interpolated"))
