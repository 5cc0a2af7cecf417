"""Queries on upkeep: donors, overlays, watermarks, healing, staleness, dimension loads, run health, ordered reports."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.functions.scratch import shared_dir
from tidemark.functions.timeutil import end_of, floor_hour, floor_slot, lock_bucket, minutes_between, month_bounds, plus_minutes
from tidemark.operators import audit, bars, fill, merge, provenance, repair, rollup, universe
from tidemark.plans.base import bars_10m, daily, live, query, source_label, table, ticks
from tidemark.plans.market import HOURLY_ROWS, _totals
from tidemark.plans.series import INTERP, SPINE, _interp_input, _spine

# ---- scans and projections


@query("range_scan_inclusive", "WITH {DAILY} SELECT id, day, close FROM daily WHERE day BETWEEN DATE '1995-03-01' AND DATE '1995-03-31'")
def range_scan_inclusive(spark: SparkSession, d: str) -> DataFrame:
    """An inclusive range of days."""
    return daily(spark, d).where("day between date'1995-03-01' and date'1995-03-31'").select("id", "day", "close")


@query("live_snapshot_projection", "WITH {LIVE} SELECT id, symbol, CAST(market_cap_rank AS INT) AS market_cap_rank, market_cap, last_updated FROM live")
def live_snapshot_projection(spark: SparkSession, d: str) -> DataFrame:
    return live(spark, d).select("id", "symbol", "market_cap_rank", "market_cap", "last_updated")


@query("first_n_ids", "WITH {LIVE} SELECT DISTINCT id FROM live ORDER BY id LIMIT 50")
def first_n_ids(spark: SparkSession, d: str) -> DataFrame:
    return universe.first_ids(live(spark, d), 50)


RAW_LIVE = """raw AS (SELECT CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 13 = 1 THEN ' ' ELSE CAST(c_custkey AS VARCHAR) END AS id, CASE WHEN c_custkey % 17 <> 0 THEN c_acctbal END AS last_updated FROM customer)"""


def _raw_live(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    id_ = F.when(k % 13 == 0, F.lit(None)).when(k % 13 == 1, " ").otherwise(k.cast("string"))
    return table(spark, d, "customer").select(id_.alias("id"), F.when(k % 17 != 0, F.col("c_acctbal")).alias("last_updated"))


@query("drop_incomplete_rows", f"WITH {RAW_LIVE} SELECT id, last_updated FROM raw WHERE id IS NOT NULL AND trim(id) <> '' AND last_updated IS NOT NULL")
def drop_incomplete_rows(spark: SparkSession, d: str) -> DataFrame:
    return universe.complete(_raw_live(spark, d))[0]


@query("incomplete_row_counts", f"WITH {RAW_LIVE}, c AS (SELECT coalesce(trim(id) <> '' AND last_updated IS NOT NULL, false) AS ok FROM raw) SELECT count(*) FILTER (WHERE ok) AS kept, count(*) FILTER (WHERE NOT ok) AS dropped FROM c")
def incomplete_row_counts(spark: SparkSession, d: str) -> DataFrame:
    return universe.complete(_raw_live(spark, d))[1]


@query("entities_with_live_meta", """WITH {LIVE}, u AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS id FROM lineitem)
    SELECT u.id, coalesce(symbol, upper(u.id)) AS symbol, coalesce(lower(symbol), u.id) AS name, CAST(market_cap_rank AS INT) AS market_cap_rank, l.id IS NOT NULL AS known FROM u LEFT JOIN live l ON l.id = u.id""")
def entities_with_live_meta(spark: SparkSession, d: str) -> DataFrame:
    """The listed ids with the live row's meta, a stub where there is none."""
    ids = table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("id"))
    return universe.with_meta(ids, live(spark, d).withColumn("name", F.lower("symbol")))


# ---- staleness and decisions


@query("staleness_flags", """WITH {TICKS}, {BARS}, h AS (SELECT id, date_trunc('hour', bucket) AS ts, max(last_updated) - INTERVAL 1 MINUTE * CAST(extract(hour FROM min(bucket)) * 60 AS INT) AS lu FROM bars GROUP BY 1, 2)
    SELECT id, ts, lu < ts - INTERVAL 20 MINUTE AS stale_slot, CAST(lu AS DATE) < CAST(ts AS DATE) AS stale_day, lu < TIMESTAMP '2024-01-15' - INTERVAL 10 MINUTE AS stale_live FROM h""")
def staleness_flags(spark: SparkSession, d: str) -> DataFrame:
    """Three kinds of stale: against the slot, the day and the clock. Here updates lag by as many hours as the day is old."""
    hours = bars_10m(spark, d).groupBy("id", floor_hour(F.col("bucket")).alias("ts")).agg(F.max("last_updated").alias("lu"), F.min("bucket").alias("first"))
    lu = plus_minutes(F.col("lu"), -60 * F.hour("first"))
    now = F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz")
    return hours.withColumn("lu", lu).select("id", "ts", repair.stale_slot(F.col("lu"), F.col("ts")).alias("stale_slot"), repair.stale_day(F.col("lu"), F.to_date("ts")).alias("stale_day"), repair.stale_live(F.col("lu"), now).alias("stale_live"))


@query("weak_day_stale_rows", """WITH {TICKS}, s AS (SELECT *, lower(trim(coalesce(candle_source, ''))) AS s, ts - INTERVAL 1 MINUTE * (event_id % 40) AS lu FROM ticks)
    SELECT event_id, s LIKE '%carry%' OR s LIKE '%from_daily%' OR s LIKE '%from_hourly%' OR s LIKE '%interp%' OR coalesce(point_count <= 0, false) OR lu < time_bucket(INTERVAL '10 minutes', ts) - INTERVAL 20 MINUTE AS weak FROM s""")
def weak_day_stale_rows(spark: SparkSession, d: str) -> DataFrame:
    """A day's weak rows where updates really lag: by up to 39 minutes."""
    lu = plus_minutes(F.col("ts"), -(F.col("event_id") % 40))
    return ticks(spark, d).select("event_id", provenance.weak_for_day(F.col("candle_source"), F.col("point_count"), lu, floor_slot(F.col("ts"))).alias("weak"))


@query("daily_rebuild_decision", """WITH {DAILY}, s AS (SELECT *, CASE extract(day FROM day) % 5 WHEN 0 THEN 'cg_daily_final' WHEN 1 THEN '10m_partial' WHEN 2 THEN 'repair_carry' ELSE '10m_final' END AS src, point_count * 50 AS pts FROM daily),
    f AS (SELECT *, src = 'cg_daily_final' AND pts >= 2 AS auth, coalesce(open IS NULL OR close IS NULL OR high < greatest(open, close) OR low > least(open, close), true) OR src LIKE '%carry%' OR src LIKE '%partial%' OR pts < 72 AS unsound FROM s)
    SELECT id, day, NOT auth AND unsound AS rebuild, NOT auth AND unsound AS finalise FROM f""")
def daily_rebuild_decision(spark: SparkSession, d: str) -> DataFrame:
    """Days ask for 72 points."""
    k = F.day("day") % 5
    src = F.when(k == 0, "cg_daily_final").when(k == 1, "10m_partial").when(k == 2, "repair_carry").otherwise("10m_final")
    rows = daily(spark, d).withColumn("src", src).withColumn("pts", F.col("point_count") * 50).withColumn("ts", F.col("day").cast("timestamp_ntz"))
    args = (F.lit(True), F.col("src"), F.col("pts"), F.col("ts"), F.col("ts"), provenance.FINAL_DAILY, 72)
    return rows.select("id", "day", repair.needs_rebuild(*args).alias("rebuild"), repair.needs_finalise(*args).alias("finalise"))


@query("bad_days_scan", """WITH {DAILY}, s AS (SELECT *, CASE extract(day FROM day) % 10 WHEN 0 THEN 'rolling_carry' WHEN 3 THEN 'repair_rolling_interp' WHEN 4 THEN '10m_partial' ELSE '10m_final' END AS src, CASE WHEN point_count = 3 THEN 0 ELSE point_count END AS pts,
    CASE WHEN extract(day FROM day) = 17 THEN day - 1 ELSE day END AS lu FROM daily) SELECT id, day FROM s WHERE coalesce(open IS NULL OR close IS NULL OR high < greatest(open, close) OR low > least(open, close), true) OR lu < day OR src LIKE '%carry%' OR src LIKE '%interp%' OR src LIKE '%partial%' OR pts <= 0""")
def bad_days_scan(spark: SparkSession, d: str) -> DataFrame:
    n = F.day("day")
    src = F.when(n % 10 == 0, "rolling_carry").when(n % 10 == 3, "repair_rolling_interp").when(n % 10 == 4, "10m_partial").otherwise("10m_final")
    pts = F.when(F.col("point_count") == 3, 0).otherwise(F.col("point_count"))
    updated = F.when(n == 17, F.date_sub("day", 1)).otherwise(F.col("day"))
    return daily(spark, d).where(audit.bad_day(src, pts, updated, F.col("day"))).select("id", "day")


SLOT_WEAK = """sl AS (SELECT id, time_bucket(INTERVAL '10 minutes', ts) AS slot, arg_max_null(candle_source, ts) AS src, arg_max_null(point_count, ts) AS pts FROM ticks GROUP BY 1, 2),
    w AS (SELECT id, date_trunc('hour', slot) AS hour, count(*) AS present, count(*) FILTER (WHERE coalesce(pts <= 0, true) OR s = '' OR s LIKE 'bf\\_%' ESCAPE '\\' OR s LIKE '%carry%' OR s LIKE '%interp%' OR s IN ('repair_unknown', 'unknown')) AS weak
        FROM (SELECT *, lower(trim(coalesce(src, ''))) AS s FROM sl) GROUP BY 1, 2)"""


def _slot_weakness(spark: SparkSession, d: str) -> DataFrame:
    """Per id and hour the slots that are there and those of them that are weak."""
    slots = ticks(spark, d).groupBy("id", floor_slot(F.col("ts")).alias("slot")).agg(F.max_by(F.struct("candle_source", "point_count"), "ts").alias("m"))
    weak = provenance.weak_for_hour(F.col("m.candle_source"), F.col("m.point_count"))
    return slots.groupBy("id", floor_hour(F.col("slot")).alias("hour")).agg(F.count(F.lit(1)).alias("present"), F.count_if(weak).alias("weak"))


@query("hourly_weak_counts", f"WITH {{TICKS}}, {SLOT_WEAK} SELECT id, hour, present, weak, 6 - present AS missing FROM w")
def hourly_weak_counts(spark: SparkSession, d: str) -> DataFrame:
    return _slot_weakness(spark, d).withColumn("missing", 6 - F.col("present"))


@query("protect_hours_by_share", f"""WITH {{TICKS}}, {SLOT_WEAK}, p AS (SELECT *, CAST(weak + greatest(6 - present, 0) AS DOUBLE) / 6 AS share, extract(hour FROM hour) % 3 = 0 AS auth FROM w)
    SELECT id, hour, round(share, 6) AS share, auth AND share > 0 AS protected, auth AND share > 0.5 AS protected_half FROM p""")
def protect_hours_by_share(spark: SparkSession, d: str) -> DataFrame:
    """Authoritative stored hours (every third) stay while too many of the candidate's six slots are weak or missing."""
    w = _slot_weakness(spark, d)
    share = merge.weak_share(F.col("weak"), F.col("present"), F.lit(6))
    auth = provenance.authoritative(F.when(F.hour("hour") % 3 == 0, "manual_api").otherwise("10m_final"), provenance.AUTHORITATIVE_HOURLY)
    return w.select("id", "hour", F.round(share, 6).alias("share"), merge.protects(auth, share).alias("protected"), merge.protects(auth, share, 0.5).alias("protected_half"))


@query("canonical_api_label", """WITH {TICKS} SELECT event_id, CASE WHEN lower(trim(coalesce(candle_source, ''))) LIKE '%repair_api%' THEN 'api_daily_final' WHEN ts >= TIMESTAMP '2024-01-20' THEN candle_source ELSE 'legacy_non_api' END AS candle_source FROM ticks""")
def canonical_api_label(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("candle_source")
    label = merge.canonical(s, provenance.api_label(s), F.col("ts") < F.lit(datetime(2024, 1, 20)))
    return ticks(spark, d).select("event_id", label.alias("candle_source"))


# ---- merges


@query("fill_all_from_existing", """WITH {DAILY}, o AS (SELECT id, day, price_usd * 10 AS market_cap, volume_24h, CAST(point_count AS INT) AS market_cap_rank, price_usd / 2 AS supply FROM daily WHERE point_count <= 2)
    SELECT n.id, n.day, coalesce(n.market_cap, o.market_cap, 0.0) AS market_cap, coalesce(n.volume_24h, o.volume_24h, 0.0) AS volume_24h, coalesce(n.market_cap_rank, o.market_cap_rank) AS market_cap_rank, o.supply AS circulating_supply FROM daily n LEFT JOIN o USING (id, day)""")
def fill_all_from_existing(spark: SparkSession, d: str) -> DataFrame:
    """Metrics, rank and supply from the stored row; only cap and volume end as 0."""
    new = daily(spark, d).withColumn("circulating_supply", F.lit(None).cast("double"))
    old = new.where("point_count <= 2").select("id", "day", (F.col("price_usd") * 10).alias("market_cap"), "volume_24h", F.col("point_count").cast("int").alias("market_cap_rank"), (F.col("price_usd") / 2).alias("circulating_supply"))
    columns = ["market_cap", "volume_24h", "market_cap_rank", "circulating_supply"]
    return merge.fill_missing(merge.with_stored(new, old, ["id", "day"], columns), columns).select("id", "day", *columns)


@query("replace_ohlc_keep_metrics", """WITH {DAILY}, o AS (SELECT id, day, CASE WHEN point_count = 1 THEN price_usd * 7 END AS market_cap, CASE WHEN extract(day FROM day) % 2 = 0 THEN 1.0 END AS volume_24h FROM daily WHERE point_count <= 2)
    SELECT n.id, n.day, n.open, n.high, n.low, n.close, coalesce(o.market_cap, n.market_cap) AS market_cap, coalesce(o.volume_24h, n.volume_24h) AS volume_24h FROM daily n LEFT JOIN o USING (id, day)""")
def replace_ohlc_keep_metrics(spark: SparkSession, d: str) -> DataFrame:
    new = daily(spark, d)
    old = new.where("point_count <= 2").select("id", "day", F.when(F.col("point_count") == 1, F.col("price_usd") * 7).alias("market_cap"), F.when(F.day("day") % 2 == 0, 1.0).alias("volume_24h"))
    columns = ["market_cap", "volume_24h"]
    return merge.keep_stored(merge.with_stored(new, old, ["id", "day"], columns), columns).select("id", "day", "open", "high", "low", "close", *columns)


@query("live_overlay_clamped", """WITH {TICKS}, {BARS}, c AS (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY id, CAST(bucket AS DATE) ORDER BY bucket DESC) = 1),
    q AS (SELECT id, arg_max(price, ts) AS p, arg_max(market_cap, ts) FILTER (WHERE market_cap IS NOT NULL) AS cap, arg_max(volume_24h, ts) AS vol, max(ts) AS t FROM ticks WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1)
    SELECT c.id, bucket, open, CASE WHEN t >= bucket THEN greatest(high, p) ELSE high END AS high, CASE WHEN t >= bucket THEN least(low, p) ELSE low END AS low, CASE WHEN t >= bucket THEN p ELSE close END AS close, point_count,
    CASE WHEN t >= bucket THEN coalesce(cap, market_cap) ELSE market_cap END AS market_cap, CASE WHEN t >= bucket THEN coalesce(vol, volume_24h) ELSE volume_24h END AS volume_24h,
    CASE WHEN t >= bucket THEN greatest(last_updated, CASE WHEN t < bucket + INTERVAL 10 MINUTE THEN t ELSE bucket + INTERVAL 599 SECOND END) ELSE last_updated END AS last_updated, CASE WHEN t >= bucket THEN 'live_partial' ELSE '10m_partial' END AS candle_source
    FROM c LEFT JOIN q ON q.id = c.id""")
def live_overlay_clamped(spark: SparkSession, d: str) -> DataFrame:
    """Each day's last candle under one quote: days before it see a quote past their end, days after it none."""
    b = bars_10m(spark, d)
    last = b.groupBy("id", F.to_date("bucket")).agg(F.max_by(F.struct(*b.columns), F.col("bucket")).alias("m")).select("m.*")
    t = ticks(spark, d).where(F.col("ts") < F.lit(datetime(2024, 1, 15)))
    quotes = t.groupBy("id").agg(F.max_by("price", "ts").alias("price"), *[bars.last_known(m, "ts").alias(m) for m in bars.METRICS], F.max("ts").alias("last_updated"))
    return bars.overlay_live(last, quotes, F.col("bucket"), F.col("bucket") + F.expr("interval 10 minutes"))


@query("partial_merge_skips_final", """WITH {TICKS}, {BARS}, s AS (SELECT *, CASE WHEN point_count >= 2 THEN 'cg_hourly_final' ELSE '10m_partial' END AS candle_source FROM bars), q AS (SELECT id, bucket, close * 2 AS p, last_updated + INTERVAL 1 MINUTE AS t FROM bars WHERE extract(minute FROM bucket) < 30),
    j AS (SELECT s.*, p, t, p IS NOT NULL AND candle_source = '10m_partial' AS u FROM s LEFT JOIN q USING (id, bucket)) SELECT id, bucket, open, CASE WHEN u THEN greatest(high, p) ELSE high END AS high, CASE WHEN u THEN least(low, p) ELSE low END AS low,
    CASE WHEN u THEN p ELSE close END AS close, point_count, CASE WHEN u THEN t ELSE last_updated END AS last_updated FROM j""")
def partial_merge_skips_final(spark: SparkSession, d: str) -> DataFrame:
    b = bars_10m(spark, d).withColumn("candle_source", F.when(F.col("point_count") >= 2, "cg_hourly_final").otherwise("10m_partial"))
    q = b.where(F.minute("bucket") < 30).select("id", "bucket", (F.col("close") * 2).alias("price"), F.expr("last_updated + interval 1 minute").alias("at"))
    return merge.fold_quote(b, q, ["id", "bucket"]).select("id", "bucket", "open", "high", "low", "close", "point_count", "last_updated")


@query("heal_last_slots", """WITH {TICKS}, st AS (SELECT id, time_bucket(INTERVAL '10 minutes', ts) AS bucket, arg_max_null(candle_source, ts) AS candle_source, arg_max_null(point_count, ts) AS point_count FROM ticks GROUP BY 1, 2),
    pts AS (SELECT id, time_bucket(INTERVAL '10 minutes', ts) AS bucket, arg_min(price, ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, ts) AS close, count(*) AS n FROM ticks GROUP BY 1, 2),
    last3 AS (SELECT * FROM pts QUALIFY row_number() OVER (PARTITION BY id, CAST(bucket AS DATE) ORDER BY bucket DESC) <= 3),
    j AS (SELECT l.*, s.candle_source AS old, s.point_count AS op, s.id IS NOT NULL AS has FROM last3 l LEFT JOIN st s USING (id, bucket))
    SELECT id, bucket, open, high, low, close, n AS point_count, NOT has OR 400 + n >= CASE WHEN lower(trim(coalesce(old, ''))) = 'repair_api_points' THEN 400 + coalesce(op, 0) WHEN coalesce(op, 0) > 0 THEN 300 + op WHEN old LIKE '%interp%' THEN 220 WHEN old LIKE '%carry%' THEN 120 ELSE 0 END AS healed FROM j""")
def heal_last_slots(spark: SparkSession, d: str) -> DataFrame:
    """The last three slots of each day from API points, written where the stored row isn't better."""
    t = ticks(spark, d)
    stored = t.groupBy("id", floor_slot(F.col("ts")).alias("bucket")).agg(F.max_by(F.struct("candle_source", "point_count"), "ts").alias("m")).select("id", "bucket", "m.*")
    points = bars.bars_from_points(t.select("id", "ts", F.col("price").alias("value")), floor_slot(F.col("ts")), min_points=1)
    turn = F.row_number().over(Window.partitionBy("id", F.to_date("bucket")).orderBy(F.desc("bucket")))
    last = points.withColumn("turn", turn).where("turn <= 3").drop("turn")
    return merge.heal(stored, last, ["id", "bucket"]).select("id", "bucket", "open", "high", "low", "close", "point_count", "healed")


# ---- donors and interpolation


@query("interp_interior", INTERP + " SELECT id, slot, round(coalesce(value, inner_value), 6) AS filled FROM m")
def interp_interior(spark: SparkSession, d: str) -> DataFrame:
    """Linear between known values, null outside."""
    return fill.interpolate(_interp_input(spark, d)).select("id", "slot", scalars.rounded(F.col("filled"), 6).alias("filled"))


@query("donor_cascade_all", f"""WITH {SPINE}, {{TICKS}}, {{BARS}}, own AS (SELECT s.id, s.slot, b.close AS own, b.bucket IS NOT NULL AND extract(minute FROM s.slot) >= 40 AS has_own FROM spine s LEFT JOIN bars b ON b.id = s.id AND b.bucket = s.slot),
    h AS (SELECT id, date_trunc('hour', bucket) AS hr, arg_max(close, bucket) AS hour FROM bars WHERE extract(hour FROM bucket) % 6 = 5 GROUP BY 1, 2), dd AS (SELECT id, CAST(bucket AS DATE) AS day_, arg_max(close, bucket) AS day FROM bars WHERE extract(day FROM bucket) % 3 = 0 GROUP BY 1, 2),
    x AS (SELECT o.id, o.slot, CASE WHEN has_own THEN own END AS own, has_own, CASE WHEN NOT has_own THEN hour END AS hour, CASE WHEN NOT has_own AND hour IS NULL THEN day END AS day FROM own o LEFT JOIN h ON h.id = o.id AND h.hr = date_trunc('hour', o.slot) LEFT JOIN dd ON dd.id = o.id AND dd.day_ = CAST(o.slot AS DATE)),
    z AS (SELECT *, coalesce(own, hour, day) AS x, last_value(coalesce(own, hour, day) IGNORE NULLS) OVER (PARTITION BY id ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS carry FROM x)
    SELECT id, slot, coalesce(x, carry, CASE WHEN id < 'm' THEN 5.0 END, 7.0) AS close, CASE WHEN has_own THEN 'rolling_direct' WHEN hour IS NOT NULL THEN 'bf_10m_from_hourly:10m_final' WHEN day IS NOT NULL THEN 'bf_10m_from_daily:daily_final'
        WHEN carry IS NOT NULL THEN 'bf_10m_carry_10m' WHEN id < 'm' THEN 'bf_10m_carry_hourly' ELSE 'bf_10m_carry_daily' END AS candle_source FROM z""")
def donor_cascade_all(spark: SparkSession, d: str) -> DataFrame:
    """All five donors: own hour, own day, the slot before, the hour and the day before the window (known for some ids)."""
    b = bars_10m(spark, d)
    hours = b.where(F.hour("bucket") % 6 == 5).groupBy("id", floor_hour(F.col("bucket")).alias("hr")).agg(F.max_by("close", "bucket").alias("hour"))
    days = b.where(F.day("bucket") % 3 == 0).groupBy("id", F.to_date("bucket").alias("dd")).agg(F.max_by("close", "bucket").alias("day"))
    s = _spine(spark, d).join(b.select("id", F.col("bucket").alias("slot"), F.col("close").alias("own")), ["id", "slot"], "left")
    s = s.withColumn("has_own", F.col("own").isNotNull() & (F.minute("slot") >= 40)).withColumn("own", F.when(F.col("has_own"), F.col("own")))
    s = s.withColumn("hr", floor_hour(F.col("slot"))).withColumn("dd", F.to_date("slot")).join(hours, ["id", "hr"], "left").join(days, ["id", "dd"], "left")
    s = s.withColumns({"own_source": F.lit("rolling_direct"), "hour_source": F.lit("10m_final"), "day_source": F.lit("daily_final"), "prev_hour": F.when(F.col("id") < "m", 5.0), "prev_day": F.lit(7.0)})
    return fill.donor_cascade(s).select("id", "slot", "close", "candle_source")


HOUR_SPINE = """hs AS (SELECT DISTINCT id, date_trunc('hour', slot) AS "at" FROM spine), st AS (SELECT id, date_trunc('hour', bucket) AS "at", arg_max(close, bucket) AS own_close FROM bars WHERE extract(hour FROM bucket) % 4 = 0 GROUP BY 1, 2)"""


@query("donor_cascade_hourly", f"""WITH {SPINE}, {{TICKS}}, {{BARS}}, {HOUR_SPINE}, fine AS (SELECT id, date_trunc('hour', bucket) AS "at", arg_min(open, bucket) AS o, max(high) AS h, min(low) AS l, arg_max(close, bucket) AS c, count(*) AS n, count(DISTINCT candle_source) AS k, max(candle_source) AS one
        FROM (SELECT *, CASE WHEN extract(minute FROM bucket) < 30 THEN 'rolling_direct' ELSE 'live_points' END AS candle_source FROM bars) WHERE extract(hour FROM bucket) % 4 = 1 GROUP BY 1, 2),
    coarse AS (SELECT id, CAST(bucket AS DATE) AS day, arg_max(close, bucket) AS dc FROM bars WHERE extract(day FROM bucket) % 5 = 0 GROUP BY 1, 2),
    j AS (SELECT hs.id, hs."at", st.id IS NOT NULL AS has, own_close, st.id IS NULL AND f.id IS NOT NULL AS fine, st.id IS NULL AND f.id IS NULL AND dc IS NOT NULL AS coarse, o, h, l, c, n, k, one, dc FROM hs LEFT JOIN st USING (id, "at") LEFT JOIN fine f USING (id, "at") LEFT JOIN coarse d ON d.id = hs.id AND d.day = CAST(hs."at" AS DATE)),
    m AS (SELECT *, CASE WHEN has THEN own_close WHEN fine THEN c WHEN coarse THEN dc END AS made FROM j), p AS (SELECT *, last_value(made IGNORE NULLS) OVER (PARTITION BY id ORDER BY "at" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM m)
    SELECT id, "at", CASE WHEN fine THEN o ELSE coalesce(made, prev) END AS open, CASE WHEN fine THEN h ELSE coalesce(made, prev) END AS high, CASE WHEN fine THEN l ELSE coalesce(made, prev) END AS low, coalesce(made, prev) AS close, CASE WHEN fine THEN n WHEN has THEN NULL ELSE 1 END AS point_count,
    CASE WHEN has THEN '10m_final' WHEN fine THEN 'bf_hourly_from_10m:' || CASE WHEN k = 1 THEN one ELSE 'mixed' END WHEN coarse THEN 'bf_hourly_from_daily:daily_final' ELSE 'bf_hourly_carry_hourly' END AS candle_source FROM p WHERE has OR fine OR coarse OR prev IS NOT NULL""")
def donor_cascade_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Missing hours: the own ten-minute rollup, the own day, the hour before."""
    b = bars_10m(spark, d).withColumn("candle_source", F.when(F.minute("bucket") < 30, "rolling_direct").otherwise("live_points"))
    hours = _spine(spark, d).select("id", floor_hour(F.col("slot")).alias("at")).distinct()
    stored = b.where(F.hour("bucket") % 4 == 0).groupBy("id", floor_hour(F.col("bucket")).alias("at")).agg(F.max_by("close", "bucket").alias("own_close"))
    targets = hours.join(stored.withColumn("has", F.lit(True)), ["id", "at"], "left").withColumn("has", F.coalesce("has", F.lit(False))).withColumn("own_source", F.lit("10m_final"))
    fine = repair.rollup_with_sources(b.where(F.hour("bucket") % 4 == 1), floor_hour(F.col("bucket")))
    days = b.where(F.day("bucket") % 5 == 0).groupBy("id", F.to_date("bucket").alias("day")).agg(F.max_by("close", "bucket").alias("close"))
    coarse = hours.withColumn("day", F.to_date("at")).join(days, ["id", "day"]).select("id", "at", "close", F.lit("daily_final").alias("source"))
    return fill.rollup_cascade(targets, fine, coarse, "hourly")


DAY_FINE = """f10 AS (SELECT id, CAST(bucket AS DATE) AS "at", arg_min(open, bucket) AS o, max(high) AS h, min(low) AS l, arg_max(close, bucket) AS c, count(*) AS n FROM bars WHERE extract(day FROM bucket) % 3 = 1 GROUP BY 1, 2),
    fh AS (SELECT id, CAST("at" AS DATE) AS "at", arg_min(o, "at") AS o, max(h) AS h, min(l) AS l, arg_max(c, "at") AS c, count(*) AS n FROM (SELECT id, date_trunc('hour', bucket) AS "at", arg_min(open, bucket) AS o, max(high) AS h, min(low) AS l, arg_max(close, bucket) AS c FROM bars WHERE extract(day FROM bucket) % 3 = 2 AND extract(day FROM bucket) < 20 GROUP BY 1, 2) GROUP BY 1, 2)"""


@query("donor_cascade_daily", f"""WITH {SPINE}, {{TICKS}}, {{BARS}}, {DAY_FINE}, ds AS (SELECT DISTINCT id, CAST(slot AS DATE) AS "at" FROM spine), st AS (SELECT id, CAST(bucket AS DATE) AS "at", arg_max(close, bucket) AS own_close FROM bars WHERE extract(day FROM bucket) % 6 = 0 GROUP BY 1, 2),
    j AS (SELECT ds.id, ds."at", st.id IS NOT NULL AS has, own_close, coalesce(a.o, b.o) AS o, coalesce(a.h, b.h) AS h, coalesce(a.l, b.l) AS l, coalesce(a.c, b.c) AS c, coalesce(a.n, b.n) AS n, CASE WHEN a.id IS NOT NULL THEN '10m' WHEN b.id IS NOT NULL THEN 'hourly' END AS via FROM ds LEFT JOIN st USING (id, "at") LEFT JOIN f10 a USING (id, "at") LEFT JOIN fh b USING (id, "at")),
    m AS (SELECT *, CASE WHEN has THEN own_close ELSE c END AS made FROM j), p AS (SELECT *, last_value(made IGNORE NULLS) OVER (PARTITION BY id ORDER BY "at" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM m)
    SELECT id, "at", CASE WHEN has OR via IS NULL THEN coalesce(made, prev) ELSE o END AS open, CASE WHEN has OR via IS NULL THEN coalesce(made, prev) ELSE h END AS high, CASE WHEN has OR via IS NULL THEN coalesce(made, prev) ELSE l END AS low, coalesce(made, prev) AS close,
    CASE WHEN has THEN NULL WHEN via IS NOT NULL THEN n ELSE 1 END AS point_count, CASE WHEN has THEN 'daily_final' WHEN via IS NOT NULL THEN 'bf_daily_from_' || via || ':rolling_direct' ELSE 'bf_daily_carry_daily' END AS candle_source FROM p WHERE made IS NOT NULL OR prev IS NOT NULL""")
def donor_cascade_daily(spark: SparkSession, d: str) -> DataFrame:
    """Missing days: observed ten-minute candles, observed hours, the day before."""
    b = bars_10m(spark, d).withColumn("candle_source", F.lit("rolling_direct"))
    days = _spine(spark, d).select("id", F.to_date("slot").alias("at")).distinct()
    stored = b.where(F.day("bucket") % 6 == 0).groupBy("id", F.to_date("bucket").alias("at")).agg(F.max_by("close", "bucket").alias("own_close"))
    targets = days.join(stored.withColumn("has", F.lit(True)), ["id", "at"], "left").withColumn("has", F.coalesce("has", F.lit(False))).withColumn("own_source", F.lit("daily_final"))
    ten = repair.rollup_with_sources(b.where(F.day("bucket") % 3 == 1), F.to_date("bucket"))
    hours = repair.rollup_with_sources(b.where((F.day("bucket") % 3 == 2) & (F.day("bucket") < 20)), floor_hour(F.col("bucket"))).withColumnRenamed("at", "bucket")
    hourly = repair.rollup_with_sources(hours.withColumn("candle_source", F.get("sources", F.lit(0))).drop("sources"), F.to_date("bucket"))
    return fill.rollup_cascade(targets, repair.first_of({"10m": ten, "hourly": hourly}), None, "daily")


# ---- watermarks and plans


@query("watermark_10m_final", """WITH {TICKS}, {BARS}, h AS (SELECT id, date_trunc('hour', bucket) AS ts, CASE WHEN (extract(hour FROM min(bucket)) * 7 + extract(day FROM min(bucket))) % 5 = 0 THEN '10m_final' ELSE '10m_partial' END AS src FROM bars WHERE bucket < TIMESTAMP '2024-01-29' GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC) AS n FROM h), w AS (SELECT id, max(CASE WHEN n <= 12 AND src = '10m_final' THEN ts END) AS watermark FROM r GROUP BY 1)
    SELECT id, watermark, greatest(coalesce(watermark + INTERVAL 1 HOUR, TIMESTAMP '2024-01-29' - INTERVAL 72 HOUR), TIMESTAMP '2024-01-29' - INTERVAL 48 HOUR) AS catchup_start FROM w""")
def watermark_10m_final(spark: SparkSession, d: str) -> DataFrame:
    """Per asset the latest final hour among its last 12; from the hour after it, or from further back, but clamped."""
    now = F.lit(datetime(2024, 1, 29)).cast("timestamp_ntz")
    b = bars_10m(spark, d).where(F.col("bucket") < now)
    hours = b.groupBy("id", floor_hour(F.col("bucket")).alias("ts")).agg(F.min("bucket").alias("first"))
    final = (F.hour("first") * 7 + F.day("first")) % 5 == 0
    hours = hours.withColumn("candle_source", F.when(final, "10m_final").otherwise("10m_partial"))
    return repair.catchup(hours, now, recent=12, bootstrap_hours=72, most_hours=48)


@query("gap_fill_plan", f"""WITH {SPINE}, {{TICKS}}, {{BARS}}, m AS (SELECT id, slot FROM spine EXCEPT SELECT id, bucket FROM bars)
    SELECT id, strftime(date_trunc('hour', slot) - INTERVAL 1 HOUR * CAST(extract(hour FROM slot) % 2 AS INT), '%Y%m%d%H') AS lock, count(*) AS slots, min(slot) AS first_slot, false AS aggregates FROM m GROUP BY 1, 2""")
def gap_fill_plan(spark: SparkSession, d: str) -> DataFrame:
    """Gap-fill mode: each two-hour bucket once, all its missing slots, no aggregates."""
    have = bars_10m(spark, d).select("id", F.col("bucket").alias("slot"))
    return repair.gap_fill_plan(_spine(spark, d), have, lock_bucket(F.col("slot")))


@query("replan_last_slots", f"""WITH {SPINE}, n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY slot DESC) AS k FROM spine) SELECT id, slot, k = 1 AS partial FROM n WHERE k <= 4""")
def replan_last_slots(spark: SparkSession, d: str) -> DataFrame:
    """The last four slots are planned again in every run; the last one is still open and comes out as partial."""
    end = fill.whole_days(table(spark, d, "events")).select((F.col("end") - F.expr("interval 40 minutes")).alias("start"), "end")
    ids = table(spark, d, "events").select(F.col("event_type").alias("id")).distinct()
    last = fill.spine(ids, end)
    return last.withColumn("partial", F.col("slot") == F.max("slot").over(Window.partitionBy("id"))).select("id", "slot", "partial")


@query("coverage_of_targets_or_one", """WITH {LIVE}, t AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS id, time_bucket(INTERVAL '10 minutes', ts) AS slot FROM events), h AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS id, time_bucket(INTERVAL '10 minutes', ts) AS slot FROM events WHERE event_id % 3 = 0),
    c AS (SELECT t.id, avg(CASE WHEN h.id IS NULL THEN 0.0 ELSE 1.0 END) AS coverage, count(*) AS targets FROM t LEFT JOIN h USING (id, slot) GROUP BY 1) SELECT live.id, round(coalesce(coverage, 1.0), 9) AS coverage, coalesce(targets, 0) AS targets FROM live LEFT JOIN c ON c.id = live.id""")
def coverage_of_targets_or_one(spark: SparkSession, d: str) -> DataFrame:
    t = ticks(spark, d, "user_id").select("id", floor_slot(F.col("ts")).alias("slot"), "event_id")
    out = repair.coverage_ratio(t.select("id", "slot").distinct(), t.where("event_id % 3 = 0"), ["id", "slot"], entities=live(spark, d))
    return out.withColumn("coverage", F.round("coverage", 9))


# ---- category totals, reports, dimensions and run health


@query("all_rebuilt_without_carried", "WITH {LIVE}, " + HOURLY_ROWS + """ SELECT slot, round(sum(market_cap), 3) AS market_cap, max(last_updated) AS last_updated FROM totals WHERE category <> 'ALL' AND extract(hour FROM slot) % 5 <> 0 GROUP BY 1""")
def all_rebuilt_without_carried(spark: SparkSession, d: str) -> DataFrame:
    """ALL from the categories, carried slots (every fifth hour) passed over."""
    t = _totals(spark, d).withColumn("is_carried", F.hour("slot") % 5 == 0)
    return rollup.rebuild_all(t.where(~F.col("is_carried"))).select("slot", F.round("market_cap", 3).alias("market_cap"), "last_updated")


@query("category_report_order", "WITH {LIVE}, " + HOURLY_ROWS + """ SELECT slot, category, CAST(row_number() OVER (PARTITION BY slot ORDER BY CASE WHEN category = 'ALL' THEN 0 ELSE 1 END, lower(category)) AS INT) AS place FROM totals""")
def category_report_order(spark: SparkSession, d: str) -> DataFrame:
    """ALL first, then by name whatever the case; a slot has few categories."""
    place = F.row_number().over(Window.partitionBy("slot").orderBy(*rollup.report_order()))
    return _totals(spark, d).select("slot", "category", place.alias("place"))


@query("drift_worst_first", "WITH {LIVE}, " + HOURLY_ROWS + """, raw AS (SELECT slot, round(market_cap, 2) AS cap, round(market_cap * CASE WHEN extract(hour FROM slot) % 4 = 1 THEN 0.9 ELSE 0.99 END, 2) AS st FROM totals WHERE category = 'ALL'), f AS (SELECT slot, CASE WHEN extract(hour FROM slot) % 6 <> 0 THEN round(abs(cap - st), 2) END AS abs_diff FROM raw)
    SELECT slot, abs_diff, CAST(row_number() OVER (ORDER BY coalesce(abs_diff, 0) DESC, slot) AS INT) AS place FROM f QUALIFY place <= 25""")
def drift_worst_first(spark: SparkSession, d: str) -> DataFrame:
    """Findings by size, those without a stored total as 0: the 25 that are repaired first."""
    cap = F.round("market_cap", 2)
    stored = F.round(F.col("market_cap") * F.when(F.hour("slot") % 4 == 1, 0.9).otherwise(0.99), 2)
    diff = F.when(F.hour("slot") % 6 != 0, F.round(F.abs(cap - stored), 2))
    f = _totals(spark, d).where("category = 'ALL'").select("slot", diff.alias("abs_diff"))
    return audit.worst_first(f, F.col("abs_diff"), 25, "slot")


@query("category_dimension_load", """WITH {LIVE} SELECT l.id, symbol, coalesce(nullif(trim(c.category), ''), 'Other') AS category, CASE WHEN c.id IS NOT NULL THEN 'manual_csv' ELSE 'default_other' END AS source FROM live l
    LEFT JOIN (SELECT CAST(p_partkey AS VARCHAR) AS id, p_type AS category FROM part WHERE p_partkey % 2 = 0) c ON c.id = l.id""")
def category_dimension_load(spark: SparkSession, d: str) -> DataFrame:
    """The dimension replaced as a whole, with where each category comes from, and read back."""
    from tidemark.sources import categories

    manual = table(spark, d, "part").where("p_partkey % 2 = 0").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_type").alias("category"))
    path = f"{shared_dir(spark)}/categories-{uuid.uuid4().hex}"
    return categories.load_dimension(live(spark, d), manual, path)


RUNS = "runs AS (SELECT event_type AS script, event_id AS run_id, ts AS updated_at, CASE WHEN value > 100 THEN 'failed' WHEN value > 60 THEN 'warn' ELSE 'ok' END AS status FROM events)"


def _runs(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    return table(spark, d, "events").select(F.col("event_type").alias("script"), F.col("event_id").alias("run_id"), F.col("ts").alias("updated_at"), F.when(v > 100, "failed").when(v > 60, "warn").otherwise("ok").alias("status"))


@query("run_health_upsert", f"WITH {RUNS} SELECT script, arg_max(run_id, updated_at) AS run_id, arg_max(status, updated_at) AS status, max(updated_at) AS updated_at, count(*) AS history FROM runs GROUP BY 1")
def run_health_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Runs of two batches appended to a history and merged into the latest row of each script; both tables are read back."""
    from tidemark.sources.tables import record_runs

    runs, path = _runs(spark, d), f"{shared_dir(spark)}/runs-{uuid.uuid4().hex}"
    for batch in (runs.where("run_id % 2 = 0"), runs.where("run_id % 2 = 1")):
        history, latest = record_runs(batch, path)
    counts = history.groupBy("script").agg(F.count(F.lit(1)).alias("history"))
    return latest.join(counts, "script").select("script", "run_id", "status", "updated_at", "history")


@query("run_status_counts", f"WITH {RUNS} SELECT script, status, count(*) AS n FROM runs GROUP BY 1, 2")
def run_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d).groupBy("script", "status").agg(F.count(F.lit(1)).alias("n"))


@query("health_rows_by_time", f"WITH {RUNS}, l AS (SELECT script, arg_max(status, updated_at) AS status, max(updated_at) AS updated_at FROM runs GROUP BY 1) SELECT script, status, updated_at, CAST(row_number() OVER (ORDER BY updated_at DESC, script) AS INT) AS place FROM l")
def health_rows_by_time(spark: SparkSession, d: str) -> DataFrame:
    """One row a script, the newest first."""
    last = _runs(spark, d).groupBy("script").agg(F.max_by("status", "updated_at").alias("status"), F.max("updated_at").alias("updated_at"))
    return last.withColumn("place", F.row_number().over(Window.orderBy(F.desc("updated_at"), "script")))  # one row a script


# ---- scalars


@query("month_and_end_scalars", """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS first_day, last_day(CAST(o_orderdate AS DATE)) AS last_day, extract(day FROM o_orderdate) <= 3 AS grace,
    CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 1 AS TIMESTAMP) ELSE date_trunc('second', o_orderdate) END AS end_ts FROM orders""")
def month_and_end_scalars(spark: SparkSession, d: str) -> DataFrame:
    first, last, grace = month_bounds(F.to_date("o_orderdate"))
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, d, "orders").select("o_orderkey", first.alias("first_day"), last.alias("last_day"), grace.alias("grace"), end_of(text).alias("end_ts"))


@query("text_scalars", """SELECT p_partkey, CAST(len(list_filter(list_transform(string_split(replace(p_type, ' ', ' , '), ','), lambda x: trim(x)), lambda x: x <> '')) AS INT) AS items, CASE WHEN length(p_brand) <= 8 THEN '***' ELSE p_brand[1:4] || '...' || p_brand[-4:] END AS masked_brand,
    CASE WHEN length(p_name) <= 8 THEN '***' ELSE p_name[1:4] || '...' || right(p_name, 4) END AS masked_name, left(trim(regexp_replace(p_name || '   ' || p_type, '\\s+', ' ', 'g')), 18) AS short FROM part""".replace("p_brand[-4:]", "right(p_brand, 4)"))
def text_scalars(spark: SparkSession, d: str) -> DataFrame:
    listed = scalars.csv_list(F.replace("p_type", F.lit(" "), F.lit(" , ")))
    both = F.concat("p_name", F.lit("   "), "p_type")
    return table(spark, d, "part").select("p_partkey", F.size(listed).alias("items"), scalars.masked(F.col("p_brand")).alias("masked_brand"), scalars.masked(F.col("p_name")).alias("masked_name"), scalars.shortened(both, 18).alias("short"))


@query("minutes_to_slot_end", "SELECT event_id, CAST(10 - extract(minute FROM ts) % 10 AS BIGINT) AS left_min FROM events")
def minutes_to_slot_end(spark: SparkSession, d: str) -> DataFrame:
    """Whole minutes until the slot's end, the running one included."""
    end = plus_minutes(floor_slot(F.col("ts")), 10)
    return table(spark, d, "events").select("event_id", minutes_between(end, F.date_trunc("minute", "ts")).alias("left_min"))
