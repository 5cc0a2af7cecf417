"""Queries over candles: bars, fills, coverage, audits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import bitmap, popcount, rounded, with_bits
from tidemark.functions.timeutil import floor_hour, floor_slot, minutes_between, plus_minutes, slot_index
from tidemark.operators import audit, bars, coverage, fill, provenance
from tidemark.plans.base import bars_10m, daily, query, table, ticks

START, END = datetime(2024, 1, 10), datetime(2024, 1, 12)
BAR_COLUMNS = "id, bucket, open, high, low, close, point_count, rows_seen, market_cap, volume_24h, last_updated"


@query("ohlc_10m", "WITH {TICKS}, {BARS} SELECT " + BAR_COLUMNS + " FROM bars")
def ohlc_10m(spark: SparkSession, d: str) -> DataFrame:
    return bars_10m(spark, d)


FROM_BARS = """SELECT id, {B} AS bucket, arg_min(open, bucket) AS open, max(high) AS high, min(low) AS low, arg_max(close, bucket) AS close, CAST(sum(point_count) AS BIGINT) AS point_count,
    count(*) AS rows_seen, arg_max(market_cap, bucket) FILTER (WHERE market_cap IS NOT NULL) AS market_cap, arg_max(volume_24h, bucket) AS volume_24h, max(last_updated) AS last_updated FROM bars GROUP BY 1, 2"""


@query("ohlc_hourly_from_10m", "WITH {TICKS}, {BARS} " + FROM_BARS.replace("{B}", "date_trunc('hour', bucket)"))
def ohlc_hourly_from_10m(spark: SparkSession, d: str) -> DataFrame:
    return bars.bars_from_bars(bars_10m(spark, d), floor_hour(F.col("bucket")))


@query("ohlc_daily_from_10m", "WITH {TICKS}, {BARS} " + FROM_BARS.replace("{B}", "CAST(date_trunc('day', bucket) AS DATE)"))
def ohlc_daily_from_10m(spark: SparkSession, d: str) -> DataFrame:
    return bars.bars_from_bars(bars_10m(spark, d), F.to_date("bucket"))


WEAK_DAY = """(coalesce(candle_source, '') LIKE '%carry%' OR coalesce(candle_source, '') LIKE '%from_daily%' OR coalesce(candle_source, '') LIKE '%from_hourly%'
    OR coalesce(candle_source, '') LIKE '%interp%' OR coalesce(point_count <= 0, false))"""


@query("ohlc_daily_strong_only", f"""WITH {{TICKS}}, t AS (SELECT *, CASE WHEN NOT {WEAK_DAY} THEN price END AS p FROM ticks)
    SELECT id, CAST(ts AS DATE) AS bucket, arg_min(p, ts) FILTER (WHERE p IS NOT NULL) AS open, max(p) AS high, min(p) AS low, arg_max(p, ts) FILTER (WHERE p IS NOT NULL) AS close, count(p) AS point_count, count(*) AS rows_seen,
    arg_max(market_cap, ts) FILTER (WHERE market_cap IS NOT NULL) AS market_cap, arg_max(volume_24h, ts) AS volume_24h, max(ts) AS last_updated FROM t GROUP BY 1, 2""")  # fmt: skip
def ohlc_daily_strong_only(spark: SparkSession, d: str) -> DataFrame:
    weak = provenance.weak_for_day(F.col("candle_source"), F.col("point_count"), F.col("ts"), F.col("ts"))
    return bars.bars_from_ticks(ticks(spark, d), F.to_date("ts"), strong=~weak)


@query("ohlc_monthly_from_daily", """WITH {DAILY} SELECT id, strftime(day, '%Y-%m') AS year_month, arg_min(coalesce(open, close, price_usd), day) AS open, max(coalesce(high, close, open, price_usd)) AS high,
    min(coalesce(low, close, open, price_usd)) AS low, arg_max(coalesce(close, open, price_usd), day) AS close, sum(volume_24h) AS volume, arg_max(market_cap, day) FILTER (WHERE market_cap IS NOT NULL) AS market_cap,
    arg_max(market_cap_rank, day) FILTER (WHERE market_cap_rank IS NOT NULL) AS market_cap_rank, count(*) AS days FROM daily GROUP BY 1, 2""")
def ohlc_monthly_from_daily(spark: SparkSession, d: str) -> DataFrame:
    return bars.monthly(daily(spark, d))


@query("monthly_last_row_metrics", """WITH {DAILY} SELECT id, strftime(day, '%Y-%m') AS year_month, arg_max_null(market_cap, day) AS market_cap, arg_max_null(volume_24h, day) AS volume_24h, max(day) AS last_day FROM daily GROUP BY 1, 2""")
def monthly_last_row_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Month metrics from the last row, known or not."""
    last = F.max_by(F.struct("market_cap", "volume_24h"), F.col("day"))
    return daily(spark, d).groupBy("id", F.date_format("day", "yyyy-MM").alias("year_month")).agg(last.alias("m"), F.max("day").alias("last_day")).select("id", "year_month", "m.market_cap", "m.volume_24h", "last_day")


@query("last_non_null_metrics", """WITH {USER_TICKS} SELECT id, arg_max(market_cap, ts) FILTER (WHERE market_cap IS NOT NULL) AS market_cap, arg_max(volume_24h, ts) AS volume_24h, max(ts) AS last_updated, count(*) AS n FROM ticks GROUP BY 1""")
def last_non_null_metrics(spark: SparkSession, d: str) -> DataFrame:
    return ticks(spark, d, "user_id").groupBy("id").agg(bars.last_known("market_cap", "ts").alias("market_cap"), bars.last_known("volume_24h", "ts").alias("volume_24h"), F.max("ts").alias("last_updated"), F.count(F.lit(1)).alias("n"))


@query("api_points_min2_daily", """WITH {USER_TICKS} SELECT id, CAST(ts AS DATE) AS bucket, arg_min(price, ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, ts) AS close, count(price) AS point_count FROM ticks GROUP BY 1, 2 HAVING count(price) >= 2""")
def api_points_min2_daily(spark: SparkSession, d: str) -> DataFrame:
    points = ticks(spark, d, "user_id").select("id", "ts", F.col("price").alias("value"))
    return bars.bars_from_points(points, F.to_date("ts")).select("id", "bucket", "open", "high", "low", "close", "point_count")


@query("live_overlay_partial", """WITH {TICKS}, {BARS}, last_bar AS (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY id ORDER BY bucket DESC) = 1),
    q AS (SELECT event_type AS id, max(value) AS price, max(ts) - INTERVAL 1 HOUR * CAST(length(event_type) % 2 AS INT) AS t FROM events GROUP BY 1)
    SELECT b.id, bucket, open, CASE WHEN t >= bucket THEN greatest(high, low, close, open, price) ELSE high END AS high, CASE WHEN t >= bucket THEN least(high, low, close, open, price) ELSE low END AS low,
    CASE WHEN t >= bucket THEN price ELSE close END AS close, point_count, CASE WHEN t >= bucket THEN greatest(last_updated, CASE WHEN t < bucket + INTERVAL 10 MINUTE THEN t ELSE bucket + INTERVAL 599 SECOND END) ELSE last_updated END AS last_updated,
    CASE WHEN t >= bucket THEN 'live_partial' ELSE '10m_partial' END AS candle_source FROM last_bar b LEFT JOIN q ON b.id = q.id""")
def live_overlay_partial(spark: SparkSession, d: str) -> DataFrame:
    b = bars_10m(spark, d)
    last = b.groupBy("id").agg(F.max_by(F.struct(*b.columns), F.col("bucket")).alias("m")).select("m.*")
    late = F.make_dt_interval(hours=F.length("event_type") % 2)  # the quotes of some ids are an hour old
    quotes = table(spark, d, "events").groupBy("event_type").agg(F.max("value").alias("price"), F.max("ts").alias("t")).select(F.col("event_type").alias("id"), "price", (F.col("t") - late).alias("last_updated"))
    end = F.col("bucket") + F.expr("interval 10 minutes")
    return bars.overlay_live(last, quotes, F.col("bucket"), end).drop(*bars.METRICS)


@query("last_n_rows", """WITH {USER_TICKS} SELECT id, ts, price, CAST(row_number() OVER (PARTITION BY id ORDER BY ts DESC) AS INT) AS n FROM ticks QUALIFY n <= 12""")
def last_n_rows(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("ts")))
    return ticks(spark, d, "user_id").select("id", "ts", "price", n.alias("n")).where("n <= 12")


@query("range_scan", "WITH {USER_TICKS} SELECT id, ts, price FROM ticks WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'")
def range_scan(spark: SparkSession, d: str) -> DataFrame:
    """Half-open time range on the raw column, so that the filter reaches the scan."""
    return ticks(spark, d, "user_id").where((F.col("ts") >= F.lit(START)) & (F.col("ts") < F.lit(END))).select("id", "ts", "price")


@query("first_last_key", "WITH {USER_TICKS} SELECT id, min(ts) AS first_ts, max(ts) AS last_ts FROM ticks GROUP BY 1")
def first_last_key(spark: SparkSession, d: str) -> DataFrame:
    return ticks(spark, d, "user_id").groupBy("id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


#: Every id at every slot of all days that the table covers.
SPINE = """slots AS (SELECT unnest(generate_series(CAST(date_trunc('day', min(ts)) AS TIMESTAMP), CAST(date_trunc('day', max(ts)) AS TIMESTAMP) + INTERVAL '23 hours 50 minutes', INTERVAL '10 minutes')) AS slot FROM events), ids AS (SELECT DISTINCT event_type AS id FROM events), spine AS (SELECT id, slot FROM ids, slots)"""


def _spine(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    return fill.spine(events.select(F.col("event_type").alias("id")).distinct(), fill.whole_days(events))


@query("slot_spine", f"WITH {SPINE} SELECT id, slot FROM spine")
def slot_spine(spark: SparkSession, d: str) -> DataFrame:
    return _spine(spark, d)


@query("missing_slots", f"WITH {SPINE}, {{TICKS}}, {{BARS}} SELECT id, slot FROM spine EXCEPT SELECT id, bucket FROM bars")
def missing_slots(spark: SparkSession, d: str) -> DataFrame:
    have = bars_10m(spark, d).select("id", F.col("bucket").alias("slot"))
    return _spine(spark, d).join(have, ["id", "slot"], "left_anti")


@query("asof_prev_strict", f"WITH {SPINE}, {{TICKS}} SELECT s.id, s.slot, t.ts AS asof_time, t.price AS asof_price FROM spine s ASOF LEFT JOIN ticks t ON s.id = t.id AND s.slot > t.ts")
def asof_prev_strict(spark: SparkSession, d: str) -> DataFrame:
    return fill.asof(_spine(spark, d), ticks(spark, d).select("id", "ts", "price"), "id", "slot", "ts", ["price"])


@query("locf_max_age", f"""WITH {SPINE}, {{TICKS}}, {{BARS}}, j AS (SELECT s.id, s.slot, b.bucket AS asof_time, b.close FROM spine s ASOF LEFT JOIN bars b ON s.id = b.id AND s.slot >= b.bucket)
    SELECT id, slot, CASE WHEN date_diff('minute', asof_time, slot) <= 30 THEN asof_time END AS asof_time, CASE WHEN date_diff('minute', asof_time, slot) <= 30 THEN close END AS asof_close FROM j""")  # fmt: skip
def locf_max_age(spark: SparkSession, d: str) -> DataFrame:
    b = bars_10m(spark, d).select("id", "bucket", "close")
    return fill.asof(_spine(spark, d), b, "id", "slot", "bucket", ["close"], strict=False, max_age_min=30)


def _with_stored(spark: SparkSession, d: str) -> DataFrame:
    """The spine with what was observed and what is stored: by the slot's place in five, one stored strong, one stored weak."""
    b = bars_10m(spark, d).select("id", F.col("bucket").alias("slot"), "close", "point_count")
    spine = _spine(spark, d)
    kind = F.pmod(F.hour("slot") + F.minute("slot") / 10, F.lit(5)).cast("int")
    j = spine.join(b, ["id", "slot"], "left").withColumn("k", kind)
    return j.select(
        "id", "slot", F.when(F.col("k") > 1, F.col("close")).alias("point"), F.when(F.col("k") <= 1, F.col("close")).alias("stored"),
        ((F.col("k") == 0) & F.col("close").isNotNull()).alias("stored_strong"), ((F.col("k") <= 1) & F.col("close").isNotNull()).alias("has_stored"), F.lit(50.0).alias("prior"),
    )


STORED = """b AS (SELECT s.id, s.slot, close, CAST(floor((extract(hour FROM slot) + extract(minute FROM slot) / 10) % 5) AS INT) AS k FROM spine s LEFT JOIN bars ON bars.id = s.id AND bars.bucket = s.slot),
    st AS (SELECT id, slot, CASE WHEN k > 1 THEN close END AS point, CASE WHEN k <= 1 THEN close END AS stored, k = 0 AND close IS NOT NULL AS stored_strong, k <= 1 AND close IS NOT NULL AS has_stored FROM b)"""


@query("locf_capped", f"""WITH {SPINE}, {{TICKS}}, {{BARS}}, {STORED},
    r AS (SELECT *, (stored_strong OR point IS NOT NULL) AS reset FROM st),
    g AS (SELECT *, sum(CAST(reset AS INT)) OVER (PARTITION BY id ORDER BY slot) AS grp, last_value(CASE WHEN stored_strong THEN stored ELSE point END IGNORE NULLS) OVER (PARTITION BY id ORDER BY slot) AS a FROM r),
    n AS (SELECT *, coalesce(a, 50.0) AS anchor, sum(CASE WHEN NOT reset AND (NOT has_stored OR stored IS NOT NULL) THEN 1 ELSE 0 END) OVER (PARTITION BY id, grp ORDER BY slot) AS c FROM g),
    x AS (SELECT *, CASE WHEN stored_strong THEN 'existing' WHEN point IS NOT NULL THEN 'direct' WHEN has_stored THEN 'existing' WHEN c <= 4 THEN 'carry' ELSE 'skip' END AS action FROM n)
    SELECT id, slot, action, CASE action WHEN 'existing' THEN stored WHEN 'direct' THEN point WHEN 'carry' THEN anchor END AS value FROM x""")  # fmt: skip
def locf_capped(spark: SparkSession, d: str) -> DataFrame:
    return fill.carry_capped(_with_stored(spark, d)).select("id", "slot", "action", "value")


INTERP = f"""WITH {SPINE}, {{TICKS}}, {{BARS}}, v AS (SELECT s.id, s.slot, close AS value FROM spine s LEFT JOIN bars b ON b.id = s.id AND b.bucket = s.slot),
    n AS (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN slot END IGNORE NULLS) OVER p AS lt, last_value(value IGNORE NULLS) OVER p AS lv,
        first_value(CASE WHEN value IS NOT NULL THEN slot END IGNORE NULLS) OVER f AS rt, first_value(value IGNORE NULLS) OVER f AS rv FROM v
        WINDOW p AS (PARTITION BY id ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY id ORDER BY slot ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    m AS (SELECT *, date_diff('minute', lt, rt) AS span, lv + (rv - lv) * (CAST(date_diff('minute', lt, slot) AS DOUBLE) / nullif(date_diff('minute', lt, rt), 0)) AS inner_value FROM n)"""


def _interp_input(spark: SparkSession, d: str) -> DataFrame:
    b = bars_10m(spark, d).select("id", F.col("bucket").alias("slot"), F.col("close").alias("value"))
    return _spine(spark, d).join(b, ["id", "slot"], "left")


@query("interp_linear_edges", INTERP + " SELECT id, slot, round(coalesce(value, CASE WHEN lv IS NOT NULL AND rv IS NOT NULL THEN CASE WHEN span <= 60 THEN inner_value ELSE lv END END, lv, rv), 6) AS filled FROM m")
def interp_linear_edges(spark: SparkSession, d: str) -> DataFrame:
    out = fill.interpolate(_interp_input(spark, d), edges=True, max_gap_min=60, wide="left")
    return out.select("id", "slot", rounded(F.col("filled"), 6).alias("filled"))


@query("interp_interior_maxgap", INTERP + """ SELECT id, slot, round(coalesce(value, CASE WHEN span <= 40 THEN inner_value END), 6) AS close, round(lv, 6) AS open, round(greatest(lv, coalesce(value, CASE WHEN span <= 40 THEN inner_value END)), 6) AS high,
    round(least(lv, coalesce(value, CASE WHEN span <= 40 THEN inner_value END)), 6) AS low FROM m WHERE coalesce(value, CASE WHEN span <= 40 THEN inner_value END) IS NOT NULL""")
def interp_interior_maxgap(spark: SparkSession, d: str) -> DataFrame:
    out = fill.interpolate(_interp_input(spark, d), max_gap_min=40).where("filled is not null")
    high, low = F.greatest("left_value", "filled"), F.least("left_value", "filled")
    named = {"close": F.col("filled"), "open": F.col("left_value"), "high": high, "low": low}
    return out.select("id", "slot", *[rounded(c, 6).alias(n) for n, c in named.items()])


@query("donor_cascade_10m", f"""WITH {SPINE}, {{TICKS}}, {{BARS}}, own AS (SELECT s.id, s.slot, b.close AS own, b.bucket IS NOT NULL AND extract(minute FROM s.slot) >= 20 AS has_own FROM spine s LEFT JOIN bars b ON b.id = s.id AND b.bucket = s.slot),
    h AS (SELECT id, date_trunc('hour', bucket) AS hr, arg_max(close, bucket) AS hour FROM bars WHERE extract(hour FROM bucket) % 3 = 0 GROUP BY 1, 2),
    x AS (SELECT o.id, o.slot, CASE WHEN has_own THEN own END AS own, has_own, hour FROM own o LEFT JOIN h ON h.id = o.id AND h.hr = date_trunc('hour', o.slot)),
    y AS (SELECT *, coalesce(own, CASE WHEN NOT has_own THEN hour END) AS x FROM x),
    z AS (SELECT *, last_value(x IGNORE NULLS) OVER (PARTITION BY id ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS carry FROM y)
    SELECT id, slot, coalesce(x, carry) AS close, CASE WHEN has_own THEN 'rolling_direct' WHEN hour IS NOT NULL THEN 'bf_10m_from_hourly:10m_final' WHEN carry IS NOT NULL THEN 'bf_10m_carry_10m' END AS candle_source FROM z""")  # fmt: skip
def donor_cascade_10m(spark: SparkSession, d: str) -> DataFrame:
    b = bars_10m(spark, d)
    hours = b.where(F.hour("bucket") % 3 == 0).groupBy("id", floor_hour(F.col("bucket")).alias("hr")).agg(F.max_by("close", "bucket").alias("hour"))
    s = _spine(spark, d).join(b.select("id", F.col("bucket").alias("slot"), F.col("close").alias("own")), ["id", "slot"], "left")
    s = s.withColumn("has_own", F.col("own").isNotNull() & (F.minute("slot") >= 20)).withColumn("own", F.when(F.col("has_own"), F.col("own")))
    s = s.withColumn("hr", floor_hour(F.col("slot"))).join(hours, ["id", "hr"], "left")
    none = F.lit(None)
    s = s.select("id", "slot", "own", F.lit("rolling_direct").alias("own_source"), "has_own", "hour", F.lit("10m_final").alias("hour_source"), none.cast("double").alias("day"), none.cast("string").alias("day_source"), none.cast("double").alias("prev_hour"), none.cast("double").alias("prev_day"))
    return fill.donor_cascade(s).select("id", "slot", "close", "candle_source")


@query("prev_close_open", """WITH {TICKS}, {BARS}, p AS (SELECT *, coalesce(lag(close) OVER (PARTITION BY id ORDER BY bucket), open) AS o FROM bars)
    SELECT id, bucket, o AS open, greatest(high, o, close) AS high, least(low, o, close) AS low, close FROM p""")
def prev_close_open(spark: SparkSession, d: str) -> DataFrame:
    return fill.previous_close_open(bars_10m(spark, d)).select("id", "bucket", "open", "high", "low", "close")


@query("chained_open_repaired", """WITH {TICKS}, {BARS}, rep AS (SELECT id, bucket, close FROM bars WHERE bucket >= TIMESTAMP '2024-01-10' AND point_count = 1),
    seed AS (SELECT id, arg_max(close, bucket) AS s FROM bars WHERE bucket < TIMESTAMP '2024-01-10' GROUP BY 1), p AS (SELECT r.id, bucket, close, coalesce(lag(close) OVER (PARTITION BY r.id ORDER BY bucket), s, close) AS o FROM rep r LEFT JOIN seed ON seed.id = r.id)
    SELECT id, bucket, o AS open, greatest(o, close) AS high, least(o, close) AS low, close FROM p""")
def chained_open_repaired(spark: SparkSession, d: str) -> DataFrame:
    b = bars_10m(spark, d)
    rep = b.where((F.col("bucket") >= F.lit(START)) & (F.col("point_count") == 1)).select("id", "bucket", "close")
    seed = b.where(F.col("bucket") < F.lit(START)).groupBy("id").agg(F.max_by("close", "bucket").alias("close"))
    return fill.chained_open(rep, seed).select("id", "bucket", "open", "high", "low", "close")


RANGES = """u AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS id, CAST(ts AS DATE) AS day FROM events), g AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY id ORDER BY day) AS INT) AS g FROM u),
    ranges AS (SELECT id, min(day) AS start_date, max(day) AS end_date, count(*) AS days FROM g GROUP BY id, g)"""


def _ranges(spark: SparkSession, d: str) -> DataFrame:
    return coverage.day_ranges(ticks(spark, d, "user_id").select("id", F.to_date("ts").alias("day")))


@query("coverage_ranges_islands", f"WITH {RANGES} SELECT id, start_date, end_date, days FROM ranges")
def coverage_ranges_islands(spark: SparkSession, d: str) -> DataFrame:
    return _ranges(spark, d)


@query("open_range_start", f"WITH {RANGES} SELECT id, max(CASE WHEN start_date <= DATE '2024-01-15' AND end_date >= DATE '2024-01-15' THEN start_date END) AS open_range_start FROM ranges GROUP BY 1")
def open_range_start(spark: SparkSession, d: str) -> DataFrame:
    return coverage.open_range_start(_ranges(spark, d), F.to_date(F.lit("2024-01-15")))


@query("range_clip_days", f"WITH {RANGES} SELECT id, CAST(unnest(generate_series(greatest(start_date, DATE '2024-01-10'), least(end_date, DATE '2024-01-20'), INTERVAL 1 DAY)) AS DATE) AS day FROM ranges WHERE start_date <= DATE '2024-01-20' AND end_date >= DATE '2024-01-10'")
def range_clip_days(spark: SparkSession, d: str) -> DataFrame:
    return coverage.clip_ranges(_ranges(spark, d), F.to_date(F.lit("2024-01-10")), F.to_date(F.lit("2024-01-20")))


PADDED = f"""{RANGES}, pad AS (SELECT id, greatest(start_date - 1, DATE '2024-01-05') AS a, least(end_date + 1, DATE '2024-01-25') AS b FROM ranges),
    win AS (SELECT id, CAST(w AS DATE) AS window_start, least(b, CAST(w AS DATE) + 2) AS window_end FROM (SELECT id, b, unnest(generate_series(a, b, INTERVAL 3 DAY)) AS w FROM pad WHERE a <= b))"""


def _padded(spark: SparkSession, d: str) -> DataFrame:
    low, high = F.to_date(F.lit("2024-01-05")), F.to_date(F.lit("2024-01-25"))
    return coverage.padded_windows(_ranges(spark, d), 1, low, high, 3).select("id", "window_start", "window_end")


@query("padded_api_windows", f"WITH {PADDED} SELECT id, window_start, window_end FROM win")
def padded_api_windows(spark: SparkSession, d: str) -> DataFrame:
    return _padded(spark, d)


@query("budget_prefix", f"""WITH {PADDED}, c AS (SELECT id, count(*) AS requests FROM win GROUP BY 1), s AS (SELECT id, requests, CAST(sum(requests) OVER (ORDER BY requests, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - requests AS spent_before FROM c)
    SELECT id, requests, spent_before FROM s WHERE spent_before + requests <= 150""")  # fmt: skip
def budget_prefix(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.operators.ordering import budget_prefix as prefix

    plans = _padded(spark, d).groupBy("id").agg(F.count(F.lit(1)).alias("requests"))
    return prefix(plans, "requests", 150, ["requests"], "id").select("id", "requests", F.col("spent_before").cast("long").alias("spent_before"))


@query("availability_counters", """WITH {DAILY} SELECT id, min(day) AS first_day, max(day) AS last_day, count(DISTINCT day) AS have_any, count(DISTINCT CASE WHEN close IS NOT NULL THEN day END) AS have_price,
    count(DISTINCT CASE WHEN volume_24h IS NOT NULL THEN day END) AS have_volume, count(DISTINCT CASE WHEN market_cap IS NOT NULL THEN day END) AS have_mcap, CAST(365 AS BIGINT) AS expected_days,
    365 - count(DISTINCT day) AS missing_any, 365 - count(DISTINCT CASE WHEN close IS NOT NULL THEN day END) AS missing_price, 365 - count(DISTINCT CASE WHEN volume_24h IS NOT NULL THEN day END) AS missing_volume,
    365 - count(DISTINCT CASE WHEN market_cap IS NOT NULL THEN day END) AS missing_mcap FROM daily WHERE day >= DATE '1998-01-01' AND day < DATE '1999-01-01' GROUP BY 1""")
def availability_counters(spark: SparkSession, d: str) -> DataFrame:
    window = daily(spark, d).where("day >= date'1998-01-01' and day < date'1999-01-01'")
    return coverage.availability(window, F.lit(365))


@query("intraday_slot_counts", """WITH {TICKS} SELECT id, CAST(ts AS DATE) AS day, count(DISTINCT extract(hour FROM ts) * 6 + extract(minute FROM ts) // 10) AS set_count, min(ts) AS first_seen, max(ts) AS last_seen FROM ticks GROUP BY 1, 2""")
def intraday_slot_counts(spark: SparkSession, d: str) -> DataFrame:
    return coverage.slot_sets(ticks(spark, d), slot_index(F.col("ts")), F.to_date("ts")).drop("slots")


@query("bitmap_or_popcount", """WITH {TICKS}, s AS (SELECT DISTINCT id, CAST(ts AS DATE) AS day, CAST(extract(hour FROM ts) * 6 + extract(minute FROM ts) // 10 AS INT) AS slot FROM ticks),
    b AS (SELECT id, day, slot // 8 AS byte, CAST(sum(1 << (slot % 8)) AS INT) AS v FROM s GROUP BY 1, 2, 3), k AS (SELECT DISTINCT id, day, unnest(generate_series(0, 17)) AS byte FROM s),
    f AS (SELECT k.id, k.day, k.byte, coalesce(v, 0) AS v FROM k LEFT JOIN b USING (id, day, byte)), seen AS (SELECT id, CAST(ts AS DATE) AS day, min(ts) AS first_seen, max(ts) AS last_seen FROM ticks GROUP BY 1, 2)
    SELECT id, day, string_agg(printf('%02X', v), '' ORDER BY byte) AS bitmap_hex, CAST(sum(bit_count(v)) AS BIGINT) AS set_count, min(first_seen) AS first_seen, max(last_seen) AS last_seen FROM f JOIN seen USING (id, day) GROUP BY 1, 2""")
def bitmap_or_popcount(spark: SparkSession, d: str) -> DataFrame:
    """18-byte bitmaps of a day's ten-minute slots: what is stored (mornings) ORed with what is new (afternoons), as one side
    or both have it; first seen stays, last seen moves on."""
    t = ticks(spark, d)

    def maps(rows: DataFrame, p: str) -> DataFrame:
        sets = coverage.slot_sets(rows, slot_index(F.col("ts")), F.to_date("ts"))
        return sets.select("id", "day", F.hex(bitmap(F.col("slots"), 18)).alias(f"{p}_bits"), F.col("first_seen").alias(f"{p}_first"), F.col("last_seen").alias(f"{p}_last"))

    j = maps(t.where(F.hour("ts") < 12), "old").join(maps(t.where(F.hour("ts") >= 12), "new"), ["id", "day"], "full")
    bits = with_bits(F.col("old_bits"), F.col("new_bits"))
    return j.select(
        "id", "day", bits.alias("bitmap_hex"), popcount(bits).alias("set_count"), F.coalesce("old_first", "new_first").alias("first_seen"), F.coalesce("new_last", "old_last").alias("last_seen"),
    )


@query("audit_day_gaps", """WITH {DAILY}, n AS (SELECT id, day, lead(day) OVER (PARTITION BY id ORDER BY day) AS nxt FROM daily) SELECT id, day + 1 AS gap_start, nxt - 1 AS gap_end, CAST(nxt - day - 1 AS BIGINT) AS gap_days FROM n WHERE nxt - day > 30""")
def audit_day_gaps(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    nxt = F.lead("day").over(Window.partitionBy("id").orderBy("day"))
    g = daily(spark, d).select("id", "day", nxt.alias("nxt")).where(F.datediff("nxt", "day") > 30)
    return g.select("id", F.date_add("day", 1).alias("gap_start"), F.date_sub("nxt", 1).alias("gap_end"), (F.datediff("nxt", "day") - 1).cast("long").alias("gap_days"))


@query("audit_slot_gap_score", f"""WITH {SPINE}, {{TICKS}}, {{BARS}}, m AS (SELECT id, slot FROM spine EXCEPT SELECT id, bucket FROM bars), dd AS (SELECT id, CAST(slot AS DATE) AS day, count(*) AS n FROM m GROUP BY 1, 2)
    SELECT id, count(*) FILTER (WHERE n >= 144) AS missing_days, CAST(coalesce(sum(n) FILTER (WHERE n < 144), 0) AS BIGINT) AS missing_slots, CAST(count(*) FILTER (WHERE n >= 144) * 1000 + coalesce(sum(n) FILTER (WHERE n < 144), 0) AS BIGINT) AS gap_score FROM dd GROUP BY 1""")
def audit_slot_gap_score(spark: SparkSession, d: str) -> DataFrame:
    return audit.gap_score(missing_slots(spark, d).withColumn("day", F.to_date("slot")))


@query("audit_ohlc_validity", """WITH {DAILY} SELECT id, day, open IS NULL OR close IS NULL OR high < greatest(open, close) OR low > least(open, close) AS invalid,
    coalesce(greatest(open, high, low, close) = least(open, high, low, close), false) AS flat, coalesce(greatest(open, high, low, close) = least(open, high, low, close), false) AND point_count < 2 AS unverified FROM daily""")
def audit_ohlc_validity(spark: SparkSession, d: str) -> DataFrame:
    is_flat = F.coalesce(audit.flat(), F.lit(False))
    return daily(spark, d).select("id", "day", F.coalesce(audit.ohlc_invalid(), F.lit(True)).alias("invalid"), is_flat.alias("flat"), (is_flat & (F.col("point_count") < 2)).alias("unverified"))


@query("audit_intraday_quality", """WITH {TICKS} SELECT id, count(*) AS n, count(DISTINCT price) AS distinct_prices, round(avg(CASE WHEN coalesce(trim(candle_source), '') = '' THEN 1.0 ELSE 0.0 END), 6) AS null_source_ratio,
    round(avg(CASE WHEN market_cap IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_ratio FROM ticks GROUP BY 1""")
def audit_intraday_quality(spark: SparkSession, d: str) -> DataFrame:
    blank = F.coalesce(F.trim("candle_source"), F.lit("")) == ""
    share = lambda c: F.round(F.avg(c.cast("double")), 6)
    return ticks(spark, d).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("price").alias("distinct_prices"), share(blank).alias("null_source_ratio"), share(F.col("market_cap").isNull()).alias("missing_ratio"))


@query("source_histogram", "WITH {TICKS} SELECT id, candle_source, count(*) AS n FROM ticks GROUP BY 1, 2")
def source_histogram(spark: SparkSession, d: str) -> DataFrame:
    return ticks(spark, d).groupBy("id", "candle_source").agg(F.count(F.lit(1)).alias("n"))


@query("longest_equal_run", """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS id, ts, CAST(floor(value / 20) AS BIGINT) AS v FROM events), c AS (SELECT *, CASE WHEN lag(v) OVER (PARTITION BY id ORDER BY ts) = v THEN 0 ELSE 1 END AS ch FROM e),
    g AS (SELECT *, sum(ch) OVER (PARTITION BY id ORDER BY ts) AS g FROM c), n AS (SELECT id, g, count(*) AS n FROM g GROUP BY 1, 2) SELECT id, max(n) AS longest_run FROM n GROUP BY 1""")
def longest_equal_run(spark: SparkSession, d: str) -> DataFrame:
    rows = ticks(spark, d, "user_id").withColumn("v", F.floor(F.col("price") / 20))
    return audit.longest_equal_run(rows, "id", "ts", "v")


@query("freshness_lag", """WITH {USER_TICKS}, w AS (SELECT id, max(ts) AS latest, count(DISTINCT CASE WHEN ts >= TIMESTAMP '2024-01-29 18:00:00' AND ts < TIMESTAMP '2024-01-30' THEN time_bucket(INTERVAL '10 minutes', ts) END) AS slots_seen FROM ticks WHERE ts < TIMESTAMP '2024-01-30' GROUP BY 1),
    x AS (SELECT *, CAST(floor(epoch(TIMESTAMP '2024-01-30' - latest) / 60) AS BIGINT) AS lag_min, 36 - slots_seen AS missing_slots FROM w)
    SELECT id, latest, slots_seen, lag_min, missing_slots, concat_ws(',', CASE WHEN lag_min > 45 THEN 'stale' END, CASE WHEN missing_slots > 2 THEN 'missing_slots' END) AS reasons FROM x""")
def freshness_lag(spark: SparkSession, d: str) -> DataFrame:
    now = F.lit(datetime(2024, 1, 30)).cast("timestamp_ntz")
    rows = ticks(spark, d, "user_id").where(F.col("ts") < now)
    return audit.freshness(rows, now, 45, 36, floor_slot(F.col("ts")))


@query("watermark_catchup", """WITH {USER_TICKS} SELECT id, max(ts) AS watermark, greatest(max(date_trunc('hour', ts)) + INTERVAL 1 HOUR, TIMESTAMP '2024-01-29 00:00:00' - INTERVAL 48 HOUR) AS catchup_start FROM ticks WHERE ts < TIMESTAMP '2024-01-29' GROUP BY 1""")
def watermark_catchup(spark: SparkSession, d: str) -> DataFrame:
    """Per asset the hour after its last one, no earlier than the clamp."""
    now = F.lit(datetime(2024, 1, 29)).cast("timestamp_ntz")
    t = ticks(spark, d, "user_id").where(F.col("ts") < now).groupBy("id").agg(F.max("ts").alias("watermark"))
    return t.withColumn("catchup_start", F.greatest(plus_minutes(floor_hour(F.col("watermark")), 60), plus_minutes(now, -48 * 60)))


@query("latest_snapshot_three_sources", """WITH {TICKS}, {BARS}, a AS (SELECT id, max(bucket) AS "at", arg_max(close, bucket) AS close, 0 AS p FROM bars WHERE point_count > 1 GROUP BY 1),
    h AS (SELECT id, max(date_trunc('hour', bucket)) AS "at", arg_max(close, bucket) AS close, 1 AS p FROM bars GROUP BY 1), dd AS (SELECT id, CAST(max(CAST(bucket AS DATE)) AS TIMESTAMP) + INTERVAL '23 hours 59 minutes' AS "at", arg_max(close, bucket) AS close, 2 AS p FROM bars WHERE extract(day FROM bucket) % 2 = length(id) % 2 GROUP BY 1),
    u AS (SELECT * FROM a UNION ALL SELECT * FROM h UNION ALL SELECT * FROM dd) SELECT id, "at", close, p AS priority FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY "at" DESC, p) = 1""")
def latest_snapshot_three_sources(spark: SparkSession, d: str) -> DataFrame:
    b = bars_10m(spark, d)
    one = lambda rows, at, p: rows.groupBy("id").agg(F.max(at).alias("at"), F.max_by("close", "bucket").alias("close")).withColumn("priority", F.lit(p))
    end = (F.to_date("bucket").cast("timestamp_ntz") + F.expr("interval 1439 minutes"))
    u = one(b.where("point_count > 1"), F.col("bucket"), 0).unionByName(one(b, floor_hour(F.col("bucket")), 1)).unionByName(one(b.where(F.dayofmonth("bucket") % 2 == F.length("id") % 2), end, 2))
    return u.groupBy("id").agg(F.max_by(F.struct("at", "close", "priority"), F.struct("at", -F.col("priority"))).alias("m")).select("id", "m.*")


@query("rolling_vs_stored_mismatch", """WITH {TICKS}, {BARS}, r AS (SELECT id, time_bucket(INTERVAL '10 minutes', ts) AS bucket, arg_max(CASE WHEN event_id % 3 = 0 THEN price * 1.001 ELSE price END, ts) AS price FROM ticks GROUP BY 1, 2)
    SELECT b.id, count(*) AS overlap, count(*) FILTER (WHERE abs(b.close - r.price) > 1e-10 * greatest(abs(b.close), abs(r.price))) AS mismatches FROM bars b JOIN r USING (id, bucket) GROUP BY 1""")
def rolling_vs_stored_mismatch(spark: SparkSession, d: str) -> DataFrame:
    rolling = F.when(F.col("event_id") % 3 == 0, F.col("price") * 1.001).otherwise(F.col("price"))  # what was seen live differs in places
    r = ticks(spark, d).groupBy("id", floor_slot(F.col("ts")).alias("bucket")).agg(F.max_by(rolling, "ts").alias("price"))
    j = bars_10m(spark, d).join(r, ["id", "bucket"])
    apart = F.abs(F.col("close") - F.col("price")) > 1e-10 * F.greatest(F.abs("close"), F.abs("price"))
    return j.groupBy("id").agg(F.count(F.lit(1)).alias("overlap"), F.count_if(apart).alias("mismatches"))


@query("stale_rows", "WITH {TICKS} SELECT id, ts, event_id FROM ticks WHERE date_diff('minute', time_bucket(INTERVAL '10 minutes', ts), ts) >= 5 AND point_count = 0")
def stale_rows(spark: SparkSession, d: str) -> DataFrame:
    return ticks(spark, d).where((minutes_between(F.col("ts"), floor_slot(F.col("ts"))) >= 5) & (F.col("point_count") == 0)).select("id", "ts", "event_id")
