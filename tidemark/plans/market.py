"""Queries over the universe, category totals, merges, sources and sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.functions.timeutil import floor_hour, floor_slot, lock_bucket, next_month_start, parse_time, slot_index, year_month
from tidemark.operators import audit, merge, provenance, rollup, universe
from tidemark.operators.ordering import ranged, with_position
from tidemark.plans.base import bars_10m, daily, live, query, table, ticks

LIVE_OUT = ("id", "market_cap_rank", "market_cap")


@query("ranked_top_n", "WITH {LIVE} SELECT id, CAST(market_cap_rank AS INT) AS market_cap_rank, market_cap FROM live WHERE market_cap_rank > 0 ORDER BY market_cap_rank, id LIMIT 100")
def ranked_top_n(spark: SparkSession, d: str) -> DataFrame:
    return universe.ranked_top(live(spark, d), 100).select(*LIVE_OUT)


@query("rank_window", "WITH {LIVE} SELECT id, CAST(market_cap_rank AS INT) AS market_cap_rank, market_cap FROM live WHERE market_cap_rank BETWEEN 101 AND 300")
def rank_window(spark: SparkSession, d: str) -> DataFrame:
    return universe.rank_window(live(spark, d), 101, 300).select(*LIVE_OUT)


@query("missing_universe_ids", "WITH {LIVE} SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders WHERE CAST(o_custkey AS VARCHAR) NOT IN (SELECT id FROM live WHERE market_cap_rank BETWEEN 1 AND 500)")
def missing_universe_ids(spark: SparkSession, d: str) -> DataFrame:
    wanted = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("id"))
    return universe.missing_ids(wanted, universe.rank_window(live(spark, d), 1, 500))


@query("shard_modulo", "WITH {LIVE}, p AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS position FROM live) SELECT id, position FROM p WHERE position % 4 = 1")
def shard_modulo(spark: SparkSession, d: str) -> DataFrame:
    return universe.shard(live(spark, d), 4, 1).withColumn("position", F.col("position").cast("long"))


@query("category_lookup_fallback", """WITH {LIVE} SELECT l.id, coalesce(nullif(trim(CASE WHEN l.key % 5 <> 0 THEN n.n_name END), ''), nullif(trim(p.p_type), ''), 'Other') AS category FROM live l
    LEFT JOIN customer c ON c.c_custkey = l.key LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN part p ON p.p_partkey = l.key AND l.key % 3 = 0""")
def category_lookup_fallback(spark: SparkSession, d: str) -> DataFrame:
    base = live(spark, d)
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    by_id = c.join(n, c["c_nationkey"] == n["n_nationkey"]).where("c_custkey % 5 <> 0").select(F.col("c_custkey").cast("string").alias("id"), F.col("n_name").alias("category"))
    by_symbol = table(spark, d, "part").where("p_partkey % 3 = 0").select(F.concat(F.lit("Customer#"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("symbol"), F.col("p_type").alias("category"))
    return universe.with_category(base.drop("category"), by_id, by_symbol).select("id", "category")


@query("universe_union", "WITH {LIVE} SELECT id FROM live UNION SELECT CAST(user_id AS VARCHAR) FROM events UNION SELECT CAST(l_partkey AS VARCHAR) FROM lineitem")
def universe_union(spark: SparkSession, d: str) -> DataFrame:
    return universe.union_ids(live(spark, d), ticks(spark, d, "user_id"), table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("id")))


@query("rank_dedupe_keep_latest", """WITH {LIVE}, t AS (SELECT *, CASE WHEN market_cap_rank IS NOT NULL THEN row_number() OVER (PARTITION BY market_cap_rank ORDER BY last_updated DESC, market_cap DESC, id) END AS n FROM live)
    SELECT id, CAST(CASE WHEN n = 1 THEN market_cap_rank END AS INT) AS market_cap_rank, coalesce(n > 1, false) AS demoted FROM t""")
def rank_dedupe_keep_latest(spark: SparkSession, d: str) -> DataFrame:
    return universe.unique_ranks(live(spark, d)).select("id", "market_cap_rank", "demoted")


@query("unranked_sentinel_sort", """WITH {LIVE}, s AS (SELECT id, key, CAST(CASE WHEN market_cap_rank > 0 THEN market_cap_rank ELSE 2000000000 END AS INT) AS sort_rank FROM live)
    SELECT id, sort_rank, row_number() OVER (ORDER BY sort_rank, key) - 1 AS position FROM s""")
def unranked_sentinel_sort(spark: SparkSession, d: str) -> DataFrame:
    """Assets in order of rank, unranked ones last, with their place in it; the order is cut into ranges."""
    rows = live(spark, d).select("id", "key", universe.unranked_last(F.col("market_cap_rank")).alias("sort_rank"))
    order = ["sort_rank", "key"]
    return with_position(ranged(rows, order, "_range"), "_range", order, "position").select("id", "sort_rank", "position")


@query("new_entrants", """WITH {LIVE}, f AS (SELECT CAST(user_id AS VARCHAR) AS id, CAST(min(ts) AS DATE) AS first_day FROM events GROUP BY 1)
    SELECT l.id, CAST(market_cap_rank AS INT) AS market_cap_rank, first_day FROM live l LEFT JOIN f ON f.id = l.id WHERE first_day IS NULL OR first_day > DATE '2024-01-02' ORDER BY market_cap_rank ASC NULLS LAST, l.id LIMIT 20""")
def new_entrants(spark: SparkSession, d: str) -> DataFrame:
    first = ticks(spark, d, "user_id").groupBy("id").agg(F.to_date(F.min("ts")).alias("first_day"))
    return universe.new_entrants(live(spark, d), first, "2024-01-02").select("id", "market_cap_rank", "first_day")


@query("prune_unranked", "WITH {LIVE} SELECT id FROM live WHERE market_cap_rank IS NULL AND last_updated < TIMESTAMP '2024-01-04 10:00:00' - INTERVAL 72 HOUR")
def prune_unranked(spark: SparkSession, d: str) -> DataFrame:
    cutoff = F.expr("timestamp_ntz'2024-01-04 10:00:00' - interval 72 hours")
    return live(spark, d).where(F.col("market_cap_rank").isNull() & (F.col("last_updated") < cutoff)).select("id")


HOURLY_ROWS = """hr AS (SELECT CAST(user_id AS VARCHAR) AS id, date_trunc('hour', ts) AS slot, arg_max(CASE WHEN event_id % 11 <> 0 THEN value * 1000 END, ts) FILTER (WHERE event_id % 11 <> 0) AS market_cap, arg_max(value, ts) AS volume_24h, max(ts) AS last_updated FROM events GROUP BY 1, 2),
    rows_ AS (SELECT hr.id, slot, coalesce(nullif(trim(category), ''), 'Other') AS category, hr.market_cap, hr.volume_24h, hr.last_updated FROM hr LEFT JOIN live ON live.id = hr.id),
    totals AS (SELECT slot, CASE WHEN grouping(category) = 1 THEN 'ALL' ELSE category END AS category, sum(coalesce(market_cap, 0)) AS market_cap, sum(volume_24h) AS volume_24h, max(last_updated) AS last_updated, count(*) AS contributors
    FROM rows_ GROUP BY GROUPING SETS ((slot, category), (slot)))"""


def _hourly_rows(spark: SparkSession, d: str) -> DataFrame:
    t = ticks(spark, d, "user_id").groupBy("id", floor_hour(F.col("ts")).alias("slot")).agg(
        F.max_by("market_cap", F.when(F.col("market_cap").isNotNull(), F.col("ts"))).alias("market_cap"), F.max_by("volume_24h", "ts").alias("volume_24h"), F.max("ts").alias("last_updated")
    )
    return t.join(live(spark, d).select("id", "category"), "id", "left")


def _totals(spark: SparkSession, d: str) -> DataFrame:
    return rollup.category_totals(_hourly_rows(spark, d))


@query("category_totals_all", "WITH {LIVE}, " + HOURLY_ROWS + " SELECT slot, category, round(market_cap, 4) AS market_cap, round(volume_24h, 4) AS volume_24h, last_updated, contributors FROM totals")
def category_totals_all(spark: SparkSession, d: str) -> DataFrame:
    return _totals(spark, d).select("slot", "category", F.round("market_cap", 4).alias("market_cap"), F.round("volume_24h", 4).alias("volume_24h"), "last_updated", "contributors")


@query("category_ranks", "WITH {LIVE}, " + HOURLY_ROWS + """ SELECT slot, category, CAST(CASE WHEN category = 'ALL' THEN 0 ELSE row_number() OVER (PARTITION BY slot, category = 'ALL' ORDER BY round(market_cap, 4) DESC, category) END AS INT) AS market_cap_rank FROM totals""")
def category_ranks(spark: SparkSession, d: str) -> DataFrame:
    totals = _totals(spark, d).withColumn("market_cap", F.round("market_cap", 4))
    return rollup.with_ranks(totals).select("slot", "category", "market_cap_rank")


@query("all_equals_sum_check", "WITH {LIVE}, " + HOURLY_ROWS + """, c AS (SELECT slot, round(sum(market_cap), 3) AS sum_cap, max(last_updated) AS last_updated FROM totals WHERE category <> 'ALL' GROUP BY 1)
    SELECT c.slot, sum_cap, c.last_updated, abs(sum_cap - t.market_cap) <= 0.01 AS equal FROM c JOIN totals t ON t.slot = c.slot AND t.category = 'ALL'""")
def all_equals_sum_check(spark: SparkSession, d: str) -> DataFrame:
    t = _totals(spark, d)
    sums = rollup.rebuild_all(t).select("slot", F.round("market_cap", 3).alias("sum_cap"), "last_updated")
    stored = t.where("category = 'ALL'").select("slot", F.col("market_cap").alias("stored"))
    return sums.join(stored, "slot").select("slot", "sum_cap", "last_updated", (F.abs(F.col("sum_cap") - F.col("stored")) <= 0.01).alias("equal"))


@query("min_coin_gate", "WITH {LIVE}, " + HOURLY_ROWS + " SELECT slot, contributors, contributors >= 10 AS passes FROM totals WHERE category = 'ALL'")
def min_coin_gate(spark: SparkSession, d: str) -> DataFrame:
    t = _totals(spark, d).where("category = 'ALL'")
    return t.select("slot", "contributors", (F.col("contributors") >= rollup.min_contributors(15)).alias("passes"))  # round(10.5) is 10: half to even


V = "WITH {LIVE}, " + HOURLY_ROWS + """, a AS (SELECT category, slot, round(market_cap, 4) AS market_cap, lag(round(market_cap, 4)) OVER w AS prev_cap, lead(round(market_cap, 4)) OVER w AS next_cap FROM totals WINDOW w AS (PARTITION BY category ORDER BY slot)),
    v AS (SELECT *, coalesce(prev_cap > 0 AND (prev_cap - market_cap) / prev_cap >= 0.07 AND prev_cap - market_cap >= 50000 AND next_cap > 0 AND (next_cap - market_cap) / next_cap >= 0.07 AND next_cap - market_cap >= 50000, false) AS v_shape FROM a)"""


def _v_shapes(spark: SparkSession, d: str) -> DataFrame:
    t = _totals(spark, d).withColumn("market_cap", F.round("market_cap", 4))
    return rollup.v_shapes(t, floor=50e3, key="category")


@query("vshape_anomaly", V + " SELECT category, slot, prev_cap, next_cap, v_shape FROM v")
def vshape_anomaly(spark: SparkSession, d: str) -> DataFrame:
    return _v_shapes(spark, d).select("category", "slot", "prev_cap", "next_cap", "v_shape")


@query("prev_slot_coverage", V + " SELECT category, slot, prev_cap AS prev_all, round(CASE WHEN prev_cap > 0 THEN market_cap / prev_cap END, 6) AS coverage_ratio, round(greatest(1 - CASE WHEN prev_cap > 0 THEN market_cap / prev_cap END, 0.0), 6) AS drop_pct FROM v")
def prev_slot_coverage(spark: SparkSession, d: str) -> DataFrame:
    t = _totals(spark, d).withColumn("market_cap", F.round("market_cap", 4))
    out = rollup.coverage_against_previous(t, key="category")
    drop = F.when(F.col("prev_all") > 0, F.col("drop_pct")).otherwise(F.lit(0.0))
    return out.select("category", "slot", "prev_all", F.round("coverage_ratio", 6).alias("coverage_ratio"), F.round(drop, 6).alias("drop_pct"))


@query("stored_all_coverage", "WITH {LIVE}, " + HOURLY_ROWS + """, a AS (SELECT slot, round(market_cap, 4) AS market_cap, contributors FROM totals WHERE category = 'ALL'), st AS (SELECT slot, market_cap FROM a WHERE contributors % 3 <> 0),
    j AS (SELECT a.slot, a.market_cap, st.slot AS prev_slot, st.market_cap AS prev_all FROM a ASOF LEFT JOIN st ON a.slot > st.slot) SELECT slot, prev_slot, prev_all, round(CASE WHEN prev_all > 0 THEN market_cap / prev_all END, 6) AS coverage_ratio,
    round(greatest(1 - CASE WHEN prev_all > 0 THEN market_cap / prev_all END, 0.0), 6) AS drop_pct FROM j""")
def stored_all_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Each hour's grand total against the last one that was stored before it; hours whose number of contributors is a multiple of
    three were not stored."""
    t = _totals(spark, d).where("category = 'ALL'").select("slot", "category", F.round("market_cap", 4).alias("market_cap"), "contributors")
    out = rollup.coverage_against_stored(t, t.where("contributors % 3 <> 0"))
    drop = F.when(F.col("prev_all") > 0, F.col("drop_pct"))
    return out.select("slot", "prev_slot", "prev_all", F.round("coverage_ratio", 6).alias("coverage_ratio"), F.round(F.when(F.col("prev_all").isNotNull(), F.coalesce(drop, F.lit(0.0))).otherwise(0.0), 6).alias("drop_pct"))


REQUIRED = "req AS (SELECT slot, bool_or(id = '1') AND bool_or(id = '2') AS ok FROM rows_ GROUP BY 1)"


@query("required_id_check", "WITH {LIVE}, " + HOURLY_ROWS + " SELECT slot, concat_ws(',', CASE WHEN NOT bool_or(id = '1') THEN '1' END, CASE WHEN NOT bool_or(id = '2') THEN '2' END) AS missing_required_ids FROM rows_ GROUP BY 1")
def required_id_check(spark: SparkSession, d: str) -> DataFrame:
    rows = _hourly_rows(spark, d)
    held = rows.groupBy("slot").agg(F.collect_set(F.when(F.col("id").isin("1", "2"), F.col("id"))).alias("held"))
    return held.select("slot", F.array_join(F.array_except(F.array(F.lit("1"), F.lit("2")), "held"), ",").alias("missing_required_ids"))


@query("slot_quality_decision", V + ", " + REQUIRED + """, n AS (SELECT slot, contributors FROM totals WHERE category = 'ALL')
    SELECT v.slot, CASE WHEN (v_shape OR coalesce(market_cap / nullif(prev_cap, 0) < 0.5, false) OR NOT ok AND extract(hour FROM v.slot) = 12) AND prev_cap IS NOT NULL THEN 'quarantine_prev'
        WHEN v_shape OR coalesce(market_cap / nullif(prev_cap, 0) < 0.5, false) OR NOT ok AND extract(hour FROM v.slot) = 12 THEN 'quarantine_skip' WHEN contributors < 10 THEN 'skip_low_coin_count' ELSE 'direct' END AS decision
    FROM v JOIN req ON req.slot = v.slot JOIN n ON n.slot = v.slot WHERE category = 'ALL'""")
def slot_quality_decision(spark: SparkSession, d: str) -> DataFrame:
    """Required ids are asked for at noon only here, as few hours hold them all."""
    v = rollup.coverage_against_previous(_v_shapes(spark, d), key="category").where("category = 'ALL'")
    req = _hourly_rows(spark, d).groupBy("slot").agg((F.bool_or(F.col("id") == "1") & F.bool_or(F.col("id") == "2")).alias("ok"))
    j = v.join(req, "slot")
    decision = rollup.slot_decision(F.lit(True), F.col("ok") | (F.hour("slot") != 12), F.col("v_shape"), F.col("coverage_ratio"), F.col("prev_all"), F.col("contributors") < 10, min_coverage=0.5)
    return j.select("slot", decision.alias("decision"))


@query("incremental_recompute", "WITH {LIVE}, " + HOURLY_ROWS + " SELECT slot, category, round(market_cap, 4) AS market_cap, contributors FROM totals WHERE slot IN (SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'error' AND value > 100)")
def incremental_recompute(spark: SparkSession, d: str) -> DataFrame:
    """Totals of affected hours only: rows are reduced to those hours before they are added up."""
    affected = table(spark, d, "events").where("event_type = 'error' and value > 100").select(floor_hour(F.col("ts")).alias("slot")).distinct()
    out = rollup.category_totals(_hourly_rows(spark, d).join(affected, "slot", "left_semi"))
    return out.select("slot", "category", F.round("market_cap", 4).alias("market_cap"), "contributors")


@query("audit_aggregate_drift", "WITH {LIVE}, " + HOURLY_ROWS + """, raw AS (SELECT slot, round(market_cap, 4) AS raw_cap, contributors FROM totals WHERE category = 'ALL'), st AS (SELECT slot, raw_cap * CASE WHEN extract(hour FROM slot) % 4 = 1 THEN 0.9 ELSE 0.99 END AS stored_cap FROM raw WHERE extract(hour FROM slot) % 6 <> 0)
    SELECT r.slot, round(raw_cap, 2) AS raw_cap, round(coalesce(abs(raw_cap - stored_cap), 0.0), 2) AS abs_diff, CASE WHEN stored_cap IS NULL THEN 'missing_all' ELSE 'mismatch_all' END AS finding FROM raw r LEFT JOIN st ON st.slot = r.slot
    WHERE contributors >= 5 AND (stored_cap IS NULL OR abs(raw_cap - stored_cap) >= 1000 AND abs(raw_cap - stored_cap) / nullif(raw_cap, 0) >= 0.03)""")
def audit_aggregate_drift(spark: SparkSession, d: str) -> DataFrame:
    raw = _totals(spark, d).where("category = 'ALL'").select("slot", F.round("market_cap", 4).alias("raw_cap"), "contributors")
    stored = raw.where(F.hour("slot") % 6 != 0).select("slot", (F.col("raw_cap") * F.when(F.hour("slot") % 4 == 1, 0.9).otherwise(0.99)).alias("stored_cap"))
    out = audit.drift(raw, stored, absolute=1000, min_rows=5)
    return out.select("slot", F.round("raw_cap", 2).alias("raw_cap"), F.round("abs_diff", 2).alias("abs_diff"), "finding")


@query("weak_source_flags", """WITH {TICKS}, s AS (SELECT *, lower(trim(coalesce(candle_source, ''))) AS s FROM ticks) SELECT event_id, s = '' OR s LIKE 'bf\\_%' ESCAPE '\\' OR s IN ('hist-carry', 'rolling_carry', 'repair_unknown', 'hourly_interp') AS weak_append,
    coalesce(point_count <= 0, true) OR s = '' OR s LIKE 'bf\\_%' ESCAPE '\\' OR s LIKE '%carry%' OR s LIKE '%interp%' OR s IN ('repair_unknown', 'unknown') AS weak_hour,
    s LIKE '%carry%' OR s LIKE '%from_daily%' OR s LIKE '%from_hourly%' OR s LIKE '%interp%' OR coalesce(point_count <= 0, false) AS weak_day,
    s = '' OR s LIKE '%carry%' OR s LIKE '%interp%' OR s LIKE '%partial%' AS weak_future, s LIKE '%repair_api%' OR s LIKE 'cg\\_pro%' ESCAPE '\\' OR s LIKE 'cg\\_daily%' ESCAPE '\\' AS api_label FROM s""")
def weak_source_flags(spark: SparkSession, d: str) -> DataFrame:
    s, n = F.col("candle_source"), F.col("point_count")
    return ticks(spark, d).select(
        "event_id", provenance.weak_for_append(s).alias("weak_append"), provenance.weak_for_hour(s, n).alias("weak_hour"), provenance.weak_for_day(s, n, F.col("ts"), F.col("ts")).alias("weak_day"),
        provenance.weak_future(s).alias("weak_future"), provenance.api_label(s).alias("api_label"),
    )


SCORE = """CASE WHEN lower(trim(coalesce({s}, ''))) = 'repair_api_points' THEN 400 + coalesce({n}, 0) WHEN coalesce({n}, 0) > 0 THEN 300 + {n} WHEN {s} LIKE '%interp%' THEN 220 WHEN {s} LIKE '%carry%' THEN 120 ELSE 0 END"""


@query("source_quality_score", "WITH {TICKS} SELECT event_id, CAST(" + SCORE.replace("{s}", "candle_source").replace("{n}", "point_count") + " AS INT) AS score FROM ticks")
def source_quality_score(spark: SparkSession, d: str) -> DataFrame:
    return ticks(spark, d).select("event_id", provenance.precedence(F.col("candle_source"), F.col("point_count")).alias("score"))


@query("upgrade_weak_existing", "WITH {TICKS}, s AS (SELECT id, time_bucket(INTERVAL '10 minutes', ts) AS slot, price, candle_source, " + SCORE.replace("{s}", "candle_source").replace("{n}", "point_count") + """ AS score, ts FROM ticks)
    SELECT id, slot, arg_max(price, score * 100000000000 + (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1000) AS price, CAST(max(score) AS INT) AS score FROM s GROUP BY 1, 2""")
def upgrade_weak_existing(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a slot arrive in order; each overwrites if its score is not lower: the last of the best stays."""
    t = ticks(spark, d).withColumn("slot", floor_slot(F.col("ts"))).withColumn("score", provenance.precedence(F.col("candle_source"), F.col("point_count")))
    return t.groupBy("id", "slot").agg(F.max_by("price", F.struct("score", "ts")).alias("price"), F.max("score").alias("score"))


STORED_DAILY = """old AS (SELECT id, day, CASE WHEN hash_ = 0 THEN close + 1 ELSE close END AS close, market_cap, volume_24h, CASE WHEN hash_ = 1 THEN 'api_daily_final' ELSE '10m_final' END AS candle_source
    FROM (SELECT *, (point_count + extract(day FROM day)) % 4 AS hash_ FROM daily) WHERE hash_ < 3)"""


def _candidate(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    new = daily(spark, d)
    h = ((F.col("point_count") + F.day("day")) % 4).alias("h")
    old = new.select("*", h).where("h < 3").select("id", "day", F.when(F.col("h") == 0, F.col("close") + 1).otherwise(F.col("close")).alias("close"), "market_cap", "volume_24h", F.when(F.col("h") == 1, "api_daily_final").otherwise("10m_final").alias("candle_source"))
    return new, old


@query("protect_authoritative", "WITH {DAILY}, " + STORED_DAILY + """, j AS (SELECT n.id, n.day, coalesce(o.candle_source = 'api_daily_final', false) AS auth, (n.point_count + greatest(2 - n.point_count, 0)) AS w FROM daily n LEFT JOIN old o USING (id, day))
    SELECT id, day, auth AND w > 0 AS protected FROM j""")
def protect_authoritative(spark: SparkSession, d: str) -> DataFrame:
    new, old = _candidate(spark, d)
    j = merge.with_stored(new, old, ["id", "day"], ["candle_source"])
    auth = provenance.authoritative(F.col("old_candle_source"), provenance.AUTHORITATIVE_DAILY)
    share = merge.weak_share(F.col("point_count"), F.col("point_count"), F.lit(2))
    return j.select("id", "day", merge.protects(auth, share).alias("protected"))


SAME_FIELDS = ("open", "high", "low", "close", "price_usd", "market_cap", "volume_24h")
FULL_STORED = """fs AS (SELECT id, day, CASE WHEN k = 1 THEN open + 1 ELSE open END AS open, CASE WHEN k = 2 THEN high + 1 ELSE high END AS high, low, CASE WHEN k = 3 THEN close + 5e-13 ELSE close END AS close, price_usd,
    CASE WHEN k = 4 THEN NULL ELSE market_cap END AS market_cap, volume_24h, CASE WHEN k = 5 THEN coalesce(market_cap_rank, 0) + 1 ELSE market_cap_rank END AS market_cap_rank, CASE WHEN k = 6 THEN '10m_partial' ELSE '10m_final' END AS candle_source
    FROM (SELECT *, (point_count + extract(day FROM day)) % 8 AS k FROM daily) WHERE k < 7)"""


@query("unchanged_filter", "WITH {DAILY}, " + FULL_STORED + " SELECT n.id, n.day FROM daily n LEFT JOIN fs o USING (id, day) WHERE o.candle_source IS DISTINCT FROM '10m_final' OR n.market_cap_rank IS DISTINCT FROM o.market_cap_rank OR NOT ("
    + " AND ".join(f"coalesce(n.{c} IS NOT DISTINCT FROM o.{c} OR abs(n.{c} - o.{c}) <= 1e-12, false)" for c in SAME_FIELDS) + ")")
def unchanged_filter(spark: SparkSession, d: str) -> DataFrame:
    """Candidates that differ from the stored final row in any field: prices and metrics within tolerance, rank and label exactly."""
    new = daily(spark, d).withColumn("candle_source", F.lit("10m_final"))
    k = (F.col("point_count") + F.day("day")) % 8
    old = new.withColumn("k", k).where("k < 7").withColumns({
        "open": F.when(F.col("k") == 1, F.col("open") + 1).otherwise(F.col("open")), "high": F.when(F.col("k") == 2, F.col("high") + 1).otherwise(F.col("high")),
        "close": F.when(F.col("k") == 3, F.col("close") + 5e-13).otherwise(F.col("close")), "market_cap": F.when(F.col("k") != 4, F.col("market_cap")),
        "market_cap_rank": F.when(F.col("k") == 5, F.coalesce("market_cap_rank", F.lit(0)) + 1).otherwise(F.col("market_cap_rank")),
        "candle_source": F.when(F.col("k") == 6, "10m_partial").otherwise("10m_final"),
    })
    exact = ("market_cap_rank", "candle_source")
    columns = [*SAME_FIELDS, *exact]
    return merge.with_stored(new, old, ["id", "day"], columns).where(~merge.unchanged(columns, exact)).select("id", "day")


@query("fill_missing_from_existing", "WITH {DAILY}, shifted AS (SELECT id, day, price_usd * 10 AS market_cap, volume_24h FROM daily WHERE point_count = 1) SELECT n.id, n.day, coalesce(n.market_cap, o.market_cap, 0.0) AS market_cap, coalesce(n.volume_24h, o.volume_24h, 0.0) AS volume_24h FROM daily n LEFT JOIN shifted o USING (id, day)")
def fill_missing_from_existing(spark: SparkSession, d: str) -> DataFrame:
    new = daily(spark, d)
    old = new.where("point_count = 1").select("id", "day", (F.col("price_usd") * 10).alias("market_cap"), "volume_24h")
    columns = ["market_cap", "volume_24h"]
    return merge.fill_missing(merge.with_stored(new, old, ["id", "day"], columns), columns).select("id", "day", *columns)


@query("insert_if_absent", "WITH {DAILY}, " + STORED_DAILY + " SELECT n.id, n.day, o.candle_source IS NULL AS applied FROM daily n LEFT JOIN old o USING (id, day)")
def insert_if_absent(spark: SparkSession, d: str) -> DataFrame:
    new, old = _candidate(spark, d)
    return merge.insert_if_absent(old, new, ["id", "day"]).select("id", "day", "applied")


@query("upsert_merge", "WITH {DAILY}, " + STORED_DAILY + """, n AS (SELECT id, day, close, market_cap, volume_24h, 'repair_api' AS candle_source FROM daily WHERE point_count = 2)
    SELECT id, day, close, candle_source FROM n UNION ALL SELECT o.id, o.day, o.close, o.candle_source FROM old o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.id = o.id AND n.day = o.day)""")
def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    new, old = _candidate(spark, d)
    fresh = new.where("point_count = 2").withColumn("candle_source", F.lit("repair_api"))
    return merge.upsert(old, fresh, ["id", "day"]).select("id", "day", "close", "candle_source")


@query("partial_bar_merge", """WITH {TICKS}, {BARS}, q AS (SELECT id, bucket, close + 1 AS p, last_updated + INTERVAL 1 MINUTE AS t FROM bars WHERE point_count = 1) SELECT b.id, b.bucket, open, CASE WHEN p IS NOT NULL THEN greatest(high, low, close, open, p) ELSE high END AS high,
    CASE WHEN p IS NOT NULL THEN least(high, low, close, open, p) ELSE low END AS low, coalesce(p, close) AS close, greatest(last_updated, t) AS last_updated FROM bars b LEFT JOIN q ON q.id = b.id AND q.bucket = b.bucket""")
def partial_bar_merge(spark: SparkSession, d: str) -> DataFrame:
    """A live quote folded into the stored partial candle of its slot."""
    b = bars_10m(spark, d)
    q = b.where("point_count = 1").select("id", "bucket", (F.col("close") + 1).alias("price"), F.expr("last_updated + interval 1 minute").alias("at"))
    folded = merge.fold_quote(b.withColumn("candle_source", F.lit("10m_partial")), q, ["id", "bucket"])
    return folded.select("id", "bucket", "open", "high", "low", "close", "last_updated")


@query("relabel_sources", """WITH {TICKS} SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN candle_source WHEN coalesce(candle_source, '') LIKE '%repair_api%' THEN 'legacy_api' ELSE 'legacy_non_api' END AS candle_source FROM ticks""")
def relabel_sources(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("candle_source")
    return ticks(spark, d).select("event_id", merge.relabel(s, provenance.api_label(s), F.col("ts") < F.lit(datetime(2024, 1, 20))).alias("candle_source"))


@query("lineage_label", """WITH {TICKS} SELECT event_id, left(lower(regexp_replace('bf_hourly_from_10m:' || string_split(coalesce(candle_source, 'unknown'), ':')[-1], '\\s+', '_', 'g')), 96) AS label FROM ticks""")
def lineage_label(spark: SparkSession, d: str) -> DataFrame:
    return ticks(spark, d).select("event_id", provenance.lineage("bf_hourly_from_10m", F.col("candle_source")).alias("label"))


@query("source_set_label", """WITH {TICKS} SELECT id, date_trunc('hour', ts) AS bucket, list_sort(list_distinct(list(candle_source) FILTER (WHERE candle_source IS NOT NULL)))::VARCHAR AS sources, CASE WHEN count(DISTINCT candle_source) = 1 THEN max(candle_source) ELSE 'mixed' END AS label FROM ticks GROUP BY 1, 2""".replace("list_sort(list_distinct(list(candle_source) FILTER (WHERE candle_source IS NOT NULL)))::VARCHAR", "string_agg(DISTINCT candle_source, ',' ORDER BY candle_source)"))
def source_set_label(spark: SparkSession, d: str) -> DataFrame:
    one = ticks(spark, d).groupBy("id", floor_hour(F.col("ts")).alias("bucket")).agg(F.array_sort(F.collect_set("candle_source")).alias("s"))
    return one.select("id", "bucket", F.when(F.size("s") > 0, F.array_join("s", ",")).alias("sources"), F.when(F.size("s") == 1, F.get("s", F.lit(0))).otherwise("mixed").alias("label"))


@query("repair_targets", """WITH {TICKS}, {BARS}, t AS (SELECT id, bucket, close, point_count, CAST(extract(hour FROM bucket) AS INT) % 3 AS k FROM bars) SELECT id, bucket, CASE WHEN k = 0 THEN 'protect' WHEN point_count < 2 AND k = 1 THEN 'replace_derived' WHEN close <= 0 OR k = 2 AND point_count >= 2 THEN 'overwrite' ELSE 'keep' END AS action FROM t""")
def repair_targets(spark: SparkSession, d: str) -> DataFrame:
    k = F.hour("bucket") % 3
    src = F.when(k == 0, "manual_api").when((k == 1) & (F.col("point_count") < 2), "bf_10m_carry_10m").otherwise("rolling_direct")
    b = bars_10m(spark, d).withColumn("src", src)
    action = (
        F.when(provenance.authoritative(F.col("src"), provenance.AUTHORITATIVE_HOURLY), "protect").when(provenance.derived(F.col("src")), "replace_derived")
        .when((F.col("close") <= 0) | ((k == 2) & (F.col("point_count") >= 2)), "overwrite").otherwise("keep")
    )
    return b.select("id", "bucket", action.alias("action"))


@query("repair_routing", """WITH dd AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS id, CAST(l_shipdate AS DATE) AS day FROM lineitem), e AS (SELECT id, day, extract(day FROM day) % 3 <> 0 AS need, extract(day FROM day) % 5 = 0 AS bad, extract(day FROM day) % 2 = 0 AS has FROM dd)
    SELECT id, day, CASE WHEN need AND NOT bad AND has THEN 'local' WHEN need OR bad THEN 'api' END AS route FROM e WHERE need OR bad""")
def repair_routing(spark: SparkSession, d: str) -> DataFrame:
    days = table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("id"), F.to_date("l_shipdate").alias("day")).distinct()
    n = F.day("day")
    need, bad, has = n % 3 != 0, n % 5 == 0, n % 2 == 0
    return days.where(need | bad).select("id", "day", F.when(need & ~bad & has, "local").otherwise("api").alias("route"))


@query("fx_incremental_watermark", """WITH fx AS (SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS asof_date, round(avg(l_extendedprice / l_quantity), 6) AS rate FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
    w AS (SELECT symbol, max(asof_date) AS watermark FROM fx WHERE asof_date <= DATE '2001-06-30' GROUP BY 1) SELECT fx.symbol, asof_date, CAST(extract(year FROM asof_date) AS INT) AS asof_year, rate, asof_date = max(asof_date) OVER (PARTITION BY fx.symbol) AS latest FROM fx JOIN w ON w.symbol = fx.symbol WHERE asof_date > watermark""")
def fx_incremental_watermark(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.sources import fx

    li, p = table(spark, d, "lineitem"), table(spark, d, "part")
    rates = li.join(p, li["l_partkey"] == p["p_partkey"]).groupBy(F.col("p_brand").alias("symbol"), F.to_date("l_shipdate").alias("asof_date")).agg(F.round(F.avg(F.col("l_extendedprice") / F.col("l_quantity")), 6).alias("rate"))
    marks = rates.where("asof_date <= date'2001-06-30'").groupBy("symbol").agg(F.max("asof_date").alias("watermark"))
    return fx.new_rates(rates, marks).select("symbol", "asof_date", "asof_year", "rate", "latest")


@query("copy_recent_filter", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate IS NULL OR o_orderdate >= TIMESTAMP '1998-01-01'")
def copy_recent_filter(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.sources.copy import recent_rows

    return recent_rows(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), datetime(1998, 1, 1), candidates=("ts", "date", "o_orderdate"))


@query("json_metrics_parse", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS INT)) AS BIGINT) AS sum_k FROM events GROUP BY 1")
def json_metrics_parse(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_type", F.from_json("props", "k int").alias("m"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("m.k").alias("sum_k"))


@query("crc32_routing", """SELECT c_custkey, CAST(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c_name, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda acc, b: list_reduce([xor(acc, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)), 4294967295::BIGINT) % 7 AS INT) AS key_no FROM customer""")
def crc32_routing(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", scalars.route(F.col("c_name"), 7).alias("key_no"))


#: Texts of refused requests; every event stands for one of them.
REFUSALS = (
    "Monthly credits used up", "no CREDITS left", "HTTP 429: Too many requests", "read timed out", "bad request", "Monthly report ready", "You've reached 10,000 calls limit",
    "API call limit exceeded, see pricing", "too many requests per minute, upgrade plan", "quota of 100 per minute", "Quota resets next month", "503 Service", "call limit", "",
)


def _any(*words: str) -> str:
    return "(" + " OR ".join("contains(t, '" + w.replace("'", "''") + "')" for w in words) + ")"


CLASSES = f"""c AS (SELECT *, {_any(*scalars.CALL_CAP)} AND ({_any(*scalars.CAP_REACHED)} OR {_any(*scalars.PLAN_HINT)}) AS cap, {_any("calls limit", "call limit")} AND {_any("you've reached", "you have reached", "developer dashboard", "pricing")} AS month_cap FROM e),
    k AS (SELECT *, (cap OR {_any(*scalars.QUOTA)}) AND NOT ({_any(*scalars.PER_MINUTE)} AND NOT (cap OR {_any(*scalars.QUOTA_HINT)})) AS quota,
        (month_cap OR {_any(*scalars.CREDIT_LIKE)}) AND ({_any(*scalars.MONTH_LIKE)} OR month_cap AND {_any("10,000", "10000")}) AS monthly FROM c)"""


@query("error_text_classify", f"""WITH e AS (SELECT event_id, lower(['{"', '".join(x.replace("'", "''") for x in REFUSALS)}'][CAST(event_id % {len(REFUSALS)} AS INT) + 1]) AS t FROM events), {CLASSES}
    SELECT event_id, CASE WHEN monthly THEN 'monthly' WHEN quota THEN 'quota' WHEN {_any(*scalars.RATE_LIMIT)} THEN 'rate_limit' WHEN {_any(*scalars.TRANSIENT)} THEN 'transient' ELSE 'other' END AS kind FROM k""")
def error_text_classify(spark: SparkSession, d: str) -> DataFrame:
    text = F.get(F.array(*[F.lit(x) for x in REFUSALS]), (F.col("event_id") % len(REFUSALS)).cast("int"))
    return table(spark, d, "events").select("event_id", scalars.error_class(text).alias("kind"))


@query("pipeline_latest", """SELECT event_type AS script, arg_max(event_id, ts) AS run_id, max(ts) AS started_at, arg_max(CASE WHEN value > 100 THEN 'failed' ELSE 'ok' END, ts) AS status, count(*) AS runs FROM events GROUP BY 1""")
def pipeline_latest(spark: SparkSession, d: str) -> DataFrame:
    runs = table(spark, d, "events").select(F.col("event_type").alias("script"), F.col("event_id").alias("run_id"), F.col("ts").alias("started_at"), F.when(F.col("value") > 100, "failed").otherwise("ok").alias("status"))
    return runs.groupBy("script").agg(F.max_by("run_id", "started_at").alias("run_id"), F.max("started_at").alias("started_at"), F.max_by("status", "started_at").alias("status"), F.count(F.lit(1)).alias("runs"))


@query("time_scalars", """SELECT event_id, time_bucket(INTERVAL '10 minutes', ts) AS slot, date_trunc('hour', ts) AS hour, CAST(extract(hour FROM ts) * 6 + extract(minute FROM ts) // 10 AS INT) AS slot_no, strftime(ts, '%Y-%m') AS ym,
    CAST(date_trunc('month', ts) + INTERVAL 1 MONTH AS DATE) AS next_month, strftime(date_trunc('hour', ts) - INTERVAL 1 HOUR * CAST(extract(hour FROM ts) % 2 AS INT), '%Y%m%d%H') AS lock_bucket FROM events""")
def time_scalars(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("ts")
    return table(spark, d, "events").select("event_id", floor_slot(t).alias("slot"), floor_hour(t).alias("hour"), slot_index(t).alias("slot_no"), year_month(t).alias("ym"), next_month_start(t).alias("next_month"), lock_bucket(t).alias("lock_bucket"))


@query("parse_times", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN date_trunc('second', ts) WHEN event_id % 3 = 1 THEN make_timestamp(epoch_us(ts) // 1000 * 1000) ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS parsed FROM events""")
def parse_times(spark: SparkSession, d: str) -> DataFrame:
    t, k = F.col("ts"), F.col("event_id") % 3
    text = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, F.floor(F.unix_micros(t.cast("timestamp")) / 1000).cast("string")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, d, "events").select("event_id", parse_time(text).alias("parsed"))


@query("worst_dates_top20", """WITH {DAILY} SELECT day, count(*) AS findings FROM daily WHERE open IS NULL OR close IS NULL GROUP BY 1 ORDER BY findings DESC, day LIMIT 20""")
def worst_dates_top20(spark: SparkSession, d: str) -> DataFrame:
    bad = daily(spark, d).where("open is null or close is null").groupBy("day").agg(F.count(F.lit(1)).alias("findings"))
    return bad.orderBy(F.desc("findings"), "day").limit(20)


@query("month_overlay_live", """WITH {DAILY}, m AS (SELECT id, strftime(day, '%Y-%m') AS year_month, arg_max(market_cap, day) FILTER (WHERE market_cap IS NOT NULL) AS market_cap, sum(volume_24h) AS volume FROM daily GROUP BY 1, 2), {LIVE}
    SELECT m.id, year_month, coalesce(m.market_cap, l.market_cap) AS filled_cap, coalesce(l.market_cap, m.market_cap) AS overwritten_cap FROM m LEFT JOIN live l ON l.id = m.id""")
def month_overlay_live(spark: SparkSession, d: str) -> DataFrame:
    """Both flavours: only what is missing comes from the live row, or all that the live row has."""
    from tidemark.operators.bars import last_known

    m = daily(spark, d).groupBy("id", F.date_format("day", "yyyy-MM").alias("year_month")).agg(last_known("market_cap", "day").alias("market_cap"))
    q = live(spark, d).select("id", F.col("market_cap").alias("now"))
    return m.join(q, "id", "left").select("id", "year_month", F.coalesce("market_cap", "now").alias("filled_cap"), F.coalesce("now", "market_cap").alias("overwritten_cap"))


@query("interval_estimate", "WITH {TICKS} SELECT event_id, CASE WHEN candle_source LIKE '%from_hourly%' OR candle_source LIKE '%from_daily%' THEN round(volume_24h / 144, 8) END AS volume_interval_est FROM ticks")
def interval_estimate(spark: SparkSession, d: str) -> DataFrame:
    donor = F.rlike("candle_source", F.lit("from_(hourly|daily)"))
    return ticks(spark, d).select("event_id", F.when(donor, F.round(F.col("volume_24h") / 144, 8)).alias("volume_interval_est"))


@query("retention_filter", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-30' - INTERVAL 7 DAY")
def retention_filter(spark: SparkSession, d: str) -> DataFrame:
    """Rows that a time to live of 7 days keeps; the cutoff is a literal, so that the filter reaches the scan."""
    return table(spark, d, "events").where(F.col("ts") >= F.lit(datetime(2024, 1, 23))).select("event_id", "ts")


@query("stream_tumbling_10m", "WITH {TICKS}, {BARS} SELECT id, bucket, open, high, low, close, point_count FROM bars")
def stream_tumbling_10m(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.streaming.bars import tumbling_once

    return tumbling_once(spark, f"{d}/events.parquet")


@query("day_turn_ranks", "WITH {DAILY} SELECT id, day, CAST(row_number() OVER (PARTITION BY day ORDER BY price_usd DESC, id) AS INT) AS day_rank FROM daily")
def day_turn_ranks(spark: SparkSession, d: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("day").orderBy(F.desc("price_usd"), "id"))
    return daily(spark, d).select("id", "day", n.alias("day_rank"))
