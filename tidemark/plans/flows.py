"""Queries that run through state: streams, stored tables that are changed in place, and paged sources."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import metrics_dump, metrics_of, metrics_preview, rounded
from tidemark.functions.scratch import pinned, shared_dir
from tidemark.functions.timeutil import last_days, plus_minutes, slot_index, whole_hours, whole_slots
from tidemark.operators import cascade, coverage
from tidemark.operators.ordering import ranged, with_position
from tidemark.plans.base import bars_10m, live, query, table, ticks
from tidemark.plans.series import SPINE, STORED
from tidemark.sources import api, catalogue, copy, fx, negative_cache, pages, stored
from tidemark.sources.tables import replace_partitions
from tidemark.streaming import carry, late


def _folder(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


# ---- streams


@query("carry_stream", f"""WITH {SPINE}, {{TICKS}}, {{BARS}}, {STORED},
    r AS (SELECT *, (stored_strong OR point IS NOT NULL) AS reset FROM st),
    g AS (SELECT *, sum(CAST(reset AS INT)) OVER (PARTITION BY id ORDER BY slot) AS grp, last_value(CASE WHEN stored_strong THEN stored ELSE point END IGNORE NULLS) OVER (PARTITION BY id ORDER BY slot) AS anchor FROM r),
    n AS (SELECT *, sum(CASE WHEN NOT reset AND (NOT has_stored OR stored IS NOT NULL) THEN 1 ELSE 0 END) OVER (PARTITION BY id, grp ORDER BY slot) AS c FROM g),
    x AS (SELECT *, CASE WHEN stored_strong THEN 'existing' WHEN point IS NOT NULL THEN 'direct' WHEN has_stored THEN 'existing' WHEN c <= 4 AND anchor IS NOT NULL THEN 'carry' END AS action FROM n)
    SELECT id, slot, action, CASE action WHEN 'existing' THEN stored WHEN 'direct' THEN point ELSE anchor END AS value FROM x
    WHERE action IS NOT NULL AND slot + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE""")  # fmt: skip
def carry_stream(spark: SparkSession, d: str) -> DataFrame:
    """locf_capped as a stream, in three runs that go on from each other's state: every slot that the watermark has passed."""
    place = F.pmod(F.hour("ts") + F.floor(F.minute("ts") / 10), F.lit(5)).cast("int")
    kind = F.when(place == 0, carry.STRONG).when(place == 1, carry.WEAK).otherwise(carry.OBSERVED)
    return carry.replay(ticks(spark, d).select("id", "ts", "price"), kind)


@query("late_hours_stream", """WITH {TICKS}, h AS (SELECT id, date_trunc('hour', ts) AS bucket, arg_min(price, ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, ts) AS close, count(*) AS point_count FROM ticks GROUP BY 1, 2)
    SELECT id, bucket, open, high, low, close, point_count, CASE WHEN final THEN '10m_final' ELSE '10m_partial' END AS candle_source, CASE WHEN final THEN 1 ELSE 0 END AS times_final
    FROM (SELECT *, bucket + INTERVAL 7 HOUR <= (SELECT max(ts) FROM events) AS final FROM h)""")  # fmt: skip
def late_hours_stream(spark: SparkSession, d: str) -> DataFrame:
    """Events that arrive up to six hours late, out of order, in five runs: each hour as it stands after them, and how often it
    was given out as final."""
    t = ticks(spark, d)
    arrives = plus_minutes(F.col("ts"), F.pmod(F.col("event_id") * 7919, F.lit(360)))
    rows, base = t.select("id", "ts", "price", arrives.alias("arrives")), _folder(spark, "late")
    late.in_runs(rows, late.equal_spans(rows, F.col("arrives"), 5), 5, f"{base}/in", lambda s: late.late_hours(s, base, f"{base}/state"))
    hours = spark.read.schema(f"{late.HOURS}, day date").parquet(f"{base}/hours")
    given = spark.read.schema(f"{late.HOURS}, batch long").parquet(f"{base}/emitted").where(F.col("candle_source") == late.FINAL)
    times = given.groupBy("id", "bucket").agg(F.count(F.lit(1)).cast("int").alias("times_final"))
    return hours.join(times, ["id", "bucket"], "left").select("id", "bucket", "open", "high", "low", "close", "point_count", "candle_source", F.coalesce("times_final", F.lit(0)).alias("times_final"))


# ---- stored levels


@query("cascade_recompute", """WITH {LIVE}, {USER_TICKS}, {BARS}, ch AS (SELECT *, epoch(bucket) // 600 % 100 = 7 AND extract(day FROM bucket) % 3 = 1 AS c FROM bars),
    s AS (SELECT id, bucket, open, CASE WHEN c THEN greatest(high, close * 1.5) ELSE high END AS high, low, CASE WHEN c THEN close * 1.5 ELSE close END AS close, CASE WHEN c THEN market_cap * 1.5 ELSE market_cap END AS market_cap, volume_24h, last_updated FROM ch),
    h AS (SELECT id, date_trunc('hour', bucket) AS bucket, arg_max(market_cap, bucket) FILTER (WHERE market_cap IS NOT NULL) AS market_cap, arg_max(volume_24h, bucket) AS volume_24h, max(last_updated) AS last_updated, max(high) AS high FROM s GROUP BY 1, 2),
    dy AS (SELECT id, date_trunc('day', bucket) AS bucket, arg_max(market_cap, bucket) FILTER (WHERE market_cap IS NOT NULL) AS market_cap, arg_max(volume_24h, bucket) AS volume_24h, max(last_updated) AS last_updated, max(high) AS high FROM h GROUP BY 1, 2),
    a AS (SELECT 'slots' AS level, id, CAST(bucket AS TIMESTAMP) AS bucket, market_cap, volume_24h, last_updated FROM s UNION ALL SELECT 'hours', id, CAST(bucket AS TIMESTAMP), market_cap, volume_24h, last_updated FROM h UNION ALL SELECT 'days', id, CAST(bucket AS TIMESTAMP), market_cap, volume_24h, last_updated FROM dy),
    n AS (SELECT a.*, coalesce(nullif(trim(category), ''), 'Other') AS category FROM a LEFT JOIN live ON live.id = a.id)
    SELECT level, bucket, CASE WHEN grouping(category) = 1 THEN 'ALL' ELSE category END AS category, round(sum(coalesce(market_cap, 0)), 4) AS market_cap, round(sum(coalesce(volume_24h, 0)), 4) AS volume_24h, max(last_updated) AS last_updated, count(*) AS contributors
    FROM n GROUP BY GROUPING SETS ((level, bucket, category), (level, bucket))""")  # fmt: skip
def cascade_recompute(spark: SparkSession, d: str) -> DataFrame:
    """Slots, hours and days are stored with their category totals; then one slot in a hundred of every third day changes, and only
    what depends on those is made anew. All totals of the three levels, as stored after it."""
    slots, categories, base = bars_10m(spark, d, "user_id"), live(spark, d).select("id", "category"), _folder(spark, "levels")
    cascade.build(slots, categories, base)
    hit = (F.pmod(F.floor(F.unix_seconds(F.col("bucket").cast("timestamp")) / 600), F.lit(100)) == 7) & (F.dayofmonth("bucket") % 3 == 1)
    close = F.col("close") * 1.5
    changed = slots.where(hit).withColumn("high", F.greatest("high", close)).withColumn("close", close).withColumn("market_cap", F.col("market_cap") * 1.5)
    cascade.recompute(changed, categories, base)
    parts = [spark.read.schema(cascade.TOTALS).parquet(f"{base}/{level.name}_totals").withColumn("level", F.lit(level.name)) for level in cascade.LEVELS]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.select("level", "bucket", "category", F.round("market_cap", 4).alias("market_cap"), F.round("volume_24h", 4).alias("volume_24h"), "last_updated", "contributors")


@query("stored_after_retention_and_deletes", """WITH {TICKS}, {BARS}, e AS (SELECT CAST(max(ts) AS DATE) AS last FROM events)
    SELECT id, bucket, open, high, low, close, point_count, CAST(bucket AS DATE) AS day FROM bars, e WHERE CAST(bucket AS DATE) >= last - 20 AND NOT coalesce(id = 'error' AND CAST(bucket AS DATE) >= last - 2 OR point_count = 1 AND extract(day FROM bucket) % 5 = 0, false)""")
def stored_after_retention_and_deletes(spark: SparkSession, d: str) -> DataFrame:
    """Candles stored by day; days older than three weeks are dropped unread, then rows are deleted: one id's last days, and the
    single-point candles of some days. What the table holds after it."""
    path, schema = _folder(spark, "candles"), "id string, bucket timestamp_ntz, open double, high double, low double, close double, point_count long, day date"
    rows = bars_10m(spark, d).withColumn("day", F.to_date("bucket")).select(*[c.split()[0] for c in schema.split(", ")])
    replace_partitions(rows, path, "day")
    days = stored.partitions(spark, path)
    if days:
        last = max(map(date.fromisoformat, days))
        stored.retain(spark, path, last - timedelta(days=20))
        stored.delete_rows(spark, path, F.col("id") == "error", schema, within=F.col("day") >= F.lit(last - timedelta(days=2)))
        stored.delete_rows(spark, path, F.col("point_count") == 1, schema, within=F.dayofmonth("day") % 5 == 0)
    return spark.read.schema(schema).parquet(path)


# ---- stored API responses


#: A listing of 250 assets a page: ranked customers by account balance; every tenth comes again further down, with a later
#: value; some records have no id. Behind its end, one page further on, lie pages that a client never gets to.
LISTING = """{LIVE}, seen AS (SELECT key, id, symbol, market_cap, 0 AS again FROM live WHERE market_cap_rank IS NOT NULL UNION ALL SELECT key, id, symbol, market_cap - 500, 1 FROM live WHERE market_cap_rank IS NOT NULL AND key % 10 = 4),
    placed AS (SELECT CASE WHEN key % 97 <> 1 THEN id END AS id, symbol, market_cap, CAST(row_number() OVER (ORDER BY market_cap DESC, key, again) - 1 AS INT) AS pos FROM seen),
    listing AS (SELECT id, symbol, market_cap, pos // 250 + 1 AS page, pos % 250 AS place, pos + 1 AS market_cap_rank FROM placed)"""


def _stored_listing(spark: SparkSession, d: str) -> tuple[str, int]:
    """Where the listing is stored, and the last page a client may ask for."""
    known = live(spark, d)
    ranked = known.where("market_cap_rank is not null").select("key", "id", "symbol", "market_cap", F.lit(0).alias("again"))
    again = ranked.where("key % 10 = 4").withColumn("market_cap", F.col("market_cap") - 500).withColumn("again", F.lit(1))
    seen = ranked.unionByName(again).withColumn("falling", -F.col("market_cap"))
    order = ["falling", "key", "again"]
    placed = with_position(ranged(seen, order, "_range"), "_range", order, "pos")
    behind = with_position(ranged(known.where("market_cap_rank is null").select("key", "id", "symbol", "market_cap"), ["key"], "_range"), "_range", ["key"], "pos")
    ends = placed.agg((F.floor(F.max("pos") / 250) + 3).alias("from"))  # the listing may end with a full page
    behind = behind.crossJoin(F.broadcast(ends)).select("key", "id", "symbol", "market_cap", "pos", (F.floor(F.col("pos") / 250) + F.col("from")).alias("page"))
    rows = placed.withColumn("page", F.floor(F.col("pos") / 250) + 1).withColumn("rank", F.col("pos") + 1).unionByName(behind, allowMissingColumns=True)
    record = F.struct(F.when(F.col("key") % 97 != 1, F.col("id")).alias("id"), "symbol", "market_cap", F.col("rank").alias("market_cap_rank"))
    path = pages.write_pages(rows.select(F.col("page").cast("int").alias("page"), (F.col("pos") % 250).cast("int").alias("place"), F.to_json(record).alias("payload")), _folder(spark, "listing"))
    return path, -(-2 * table(spark, d, "customer").count() // 250) + 3


def _records(rows: DataFrame) -> DataFrame:
    record = F.from_json("payload", "id string, symbol string, market_cap double, market_cap_rank int")
    return rows.select("page", "place", record.alias("r")).select("page", "place", "r.*")


@query("paged_listing_first_seen", "WITH " + LISTING + " SELECT id, page, place, symbol, market_cap, market_cap_rank FROM listing WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY page, place) = 1")
def paged_listing_first_seen(spark: SparkSession, d: str) -> DataFrame:
    """The listing through the data source: pages dealt out to tasks, cut at the first short one, each asset as first seen."""
    path, last = _stored_listing(spark, d)
    return api.listing(_records(pages.whole_listing(pages.read_pages(spark, path, last)))).select("id", "page", "place", "symbol", "market_cap", "market_cap_rank")


@query("paged_rank_window_last_seen", "WITH " + LISTING + " SELECT id, page, place, symbol, market_cap, market_cap_rank FROM listing WHERE id IS NOT NULL AND market_cap_rank BETWEEN 40 AND 620 QUALIFY row_number() OVER (PARTITION BY id ORDER BY page DESC, place DESC) = 1")
def paged_rank_window_last_seen(spark: SparkSession, d: str) -> DataFrame:
    """Only the pages on which a window of ranks lies are fetched (the filter goes to the source); of an asset's records in the
    window the last one counts."""
    path, last = _stored_listing(spark, d)
    first, end = pages.window_pages(40, 620)
    rows = pages.read_pages(spark, path, last, stop_at_short="false").where((F.col("page") >= first) & (F.col("page") <= end) & F.col("place").isNotNull())
    return api.listing(_records(rows).where("market_cap_rank between 40 and 620"), first_seen=False).select("id", "page", "place", "symbol", "market_cap", "market_cap_rank")


@query("chart_range_responses", """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS id, time_bucket(INTERVAL '1 second', ts) AS ts, max(value) AS v FROM events GROUP BY 1, 2)
    SELECT id, ts, v AS price, v * 1000 AS market_cap, v + 1 AS volume_24h FROM e WHERE CAST(ts AS DATE) < DATE '2024-01-20'""")
def chart_range_responses(spark: SparkSession, d: str) -> DataFrame:
    """Range responses (lists of [milliseconds, value] for three metrics), stored by week and a thousandth of the ids; a filter on
    the week prunes the stored folders, then instants meet again over the metrics."""
    second = F.date_trunc("second", "ts")
    e = table(spark, d, "events").groupBy(F.col("user_id").cast("string").alias("id"), second.cast("timestamp_ntz").alias("ts")).agg(F.max("value").alias("v"))
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("double")
    series = lambda v: F.collect_list(F.array(ms, v))
    chunk = e.groupBy("id", F.weekofyear("ts").alias("week")).agg(series(F.col("v")).alias("prices"), series(F.col("v") * 1000).alias("market_caps"), series(F.col("v") + 1).alias("total_volumes"))
    lines = chunk.select("week", F.pmod(F.crc32("id"), F.lit(16)).alias("share"), F.to_json(F.struct("id", "prices", "market_caps", "total_volumes")).alias("json"))
    stored = pages.write_responses(lines, _folder(spark, "charts"), "week", "share")
    kept = spark.read.schema("value string, week int, share int").text(stored).where("week <= 3")
    points = api.chart_points(kept.select(F.get_json_object("value", "$.id").alias("id"), F.col("value").alias("json")))
    return api.chart_rows(points).where("ts < timestamp_ntz'2024-01-20 00:00:00'")


@query("fx_range_responses", """SELECT CAST(o_orderdate AS DATE) AS asof_date, o_orderpriority AS symbol, round(avg(o_totalprice), 4) AS rate FROM orders WHERE extract(year FROM o_orderdate) = 1995 GROUP BY 1, 2""")
def fx_range_responses(spark: SparkSession, d: str) -> DataFrame:
    """Range responses of rates ({day: {symbol: rate}}) stored by month, read back for one year only."""
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("symbol"), "o_totalprice")
    rates = o.groupBy("day", "symbol").agg(rounded(F.avg("o_totalprice"), 4).alias("rate"))
    days = rates.groupBy("day").agg(F.map_from_entries(F.collect_list(F.struct("symbol", "rate"))).alias("r"))
    months = days.groupBy(F.year("day").alias("year"), F.month("day").alias("month")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("day").cast("string"), "r"))).alias("rates"))
    stored = pages.write_responses(months.select("year", "month", F.to_json(F.struct("rates")).alias("json")), _folder(spark, "rates"), "year", "month")
    return fx.range_payload(pages.read_responses(spark, stored, "year int, month int").where("year = 1995"))


# ---- stored bitmaps


@query("bitmaps_of_stored_batches", """WITH {USER_TICKS}, t AS (SELECT id, CAST(ts AS DATE) AS day, ts, CAST(extract(hour FROM ts) * 6 + extract(minute FROM ts) // 10 AS INT) AS slot FROM ticks), s AS (SELECT DISTINCT id, day, slot FROM t),
    b AS (SELECT id, day, slot // 8 AS byte, CAST(sum(1 << (slot % 8)) AS INT) AS v FROM s GROUP BY 1, 2, 3), k AS (SELECT DISTINCT id, day, unnest(generate_series(0, 17)) AS byte FROM s),
    f AS (SELECT k.id, k.day, k.byte, coalesce(v, 0) AS v FROM k LEFT JOIN b USING (id, day, byte)), seen AS (SELECT id, day, min(ts) AS first_seen, max(ts) AS last_seen FROM t GROUP BY 1, 2),
    m AS (SELECT id, day, string_agg(printf('%02X', v), '' ORDER BY byte) AS bitmap_hex, CAST(sum(bit_count(v)) AS BIGINT) AS set_count FROM f GROUP BY 1, 2)
    SELECT m.id, m.day, bitmap_hex, set_count, first_seen, last_seen FROM m JOIN seen USING (id, day)""")  # fmt: skip
def bitmaps_of_stored_batches(spark: SparkSession, d: str) -> DataFrame:
    """Bitmaps of three batches of arrivals, each made and stored on its own, ORed from what is stored."""
    t, path = ticks(spark, d, "user_id"), _folder(spark, "bitmaps")
    for n in range(3):
        batch = t.where(F.col("event_id") % 3 == n)
        coverage.slot_bitmaps(batch, slot_index(F.col("ts")), F.to_date("ts")).write.parquet(f"{path}/batch={n}")
    merged = coverage.merged_bitmaps(spark.read.parquet(path), ["id", "day"])
    return merged.select("id", "day", F.hex("bitmap").alias("bitmap_hex"), "set_count", "first_seen", "last_seen")


@query("slots_ever_seen", """WITH {USER_TICKS} SELECT id, count(DISTINCT CAST(extract(hour FROM ts) * 6 + extract(minute FROM ts) // 10 AS INT)) AS set_count, min(ts) AS first_seen, max(ts) AS last_seen FROM ticks GROUP BY 1""")
def slots_ever_seen(spark: SparkSession, d: str) -> DataFrame:
    """Which slots of the day an id was ever seen in: the day bitmaps ORed, as they would be from a stored table of them."""
    days = coverage.slot_bitmaps(ticks(spark, d, "user_id"), slot_index(F.col("ts")), F.to_date("ts"))
    return coverage.merged_bitmaps(days, ["id"]).select("id", "set_count", "first_seen", "last_seen")


# ---- rates, copies and the catalogue


#: Rates by brand and day, and five of the days, a sixth of the time apart.
PROVIDER = """fx AS (SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS asof_date, max(l_extendedprice / l_quantity) AS rate FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
    b AS (SELECT min(asof_date) AS a, (max(asof_date) - min(asof_date)) // 6 AS step FROM fx),
    ds AS (SELECT max(CASE WHEN asof_date <= a + CAST(step AS INT) THEN asof_date END) AS d1, max(CASE WHEN asof_date <= a + CAST(2 * step AS INT) THEN asof_date END) AS d2, max(CASE WHEN asof_date <= a + CAST(3 * step AS INT) THEN asof_date END) AS d3,
    max(CASE WHEN asof_date <= a + CAST(4 * step AS INT) THEN asof_date END) AS d4, max(CASE WHEN asof_date <= a + CAST(5 * step AS INT) THEN asof_date END) AS d5 FROM fx, b)"""


@query("fx_publication", "WITH " + PROVIDER + """, h AS (SELECT symbol, asof_date, CASE WHEN asof_date = d5 THEN rate * 2 ELSE rate END AS rate FROM fx, ds WHERE asof_date BETWEEN d1 AND d4 OR asof_date = d5),
    l AS (SELECT symbol, max(asof_date) AS asof_date FROM h GROUP BY 1)
    SELECT 'history' AS kind, 0 AS run, symbol AS name, asof_date, rate FROM h UNION ALL SELECT 'live', 0, h.symbol, h.asof_date, rate FROM h JOIN l ON l.symbol = h.symbol AND l.asof_date = h.asof_date
    UNION ALL SELECT 'status', r, m, day, NULL FROM (SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS r, unnest(['first', 'span', 'degraded', 'span', 'stale', 'empty', 'refresh']) AS m, unnest([d1, d2, d2, d4, d4, d5, d5]) AS day FROM ds)""")  # fmt: skip
def fx_publication(spark: SparkSession, d: str) -> DataFrame:
    """Seven runs of the loader: the first, one over a span, one whose span fails, the one that makes up for it, one without the
    latest day, one with an empty span, and one that corrects its day. The history, the live table and the statuses after them."""
    li, p = table(spark, d, "lineitem"), table(spark, d, "part")
    day = F.to_date("l_shipdate").alias("asof_date")
    rate = F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("rate")
    rates, path = li.join(p, li["l_partkey"] == p["p_partkey"]).groupBy(F.col("p_brand").alias("symbol"), day).agg(rate), _folder(spark, "fx")
    rates.write.parquet(f"{path}/provider")
    rates = spark.read.parquet(f"{path}/provider")
    first, last = rates.agg(F.min("asof_date"), F.max("asof_date")).first()
    until = [first + timedelta(days=k * ((last - first).days // 6)) for k in range(1, 6)]
    days = list(rates.agg(*[F.max(F.when(F.col("asof_date") <= F.lit(u), F.col("asof_date"))).alias(str(u)) for u in until]).first())
    of = lambda k: rates.where(F.col("asof_date") == F.lit(days[k]))
    span = lambda a, b: rates.where((F.col("asof_date") >= F.lit(days[a])) & (F.col("asof_date") <= F.lit(days[b])))
    runs = [(of(0), None), (of(1), span(0, 1)), (of(2), None), (of(3), span(1, 3)), (None, None), (of(4), rates.limit(0)), (of(4).withColumn("rate", F.col("rate") * 2), None)]
    for n, (latest, between) in enumerate(runs, 1):
        fx.publish(spark, path, n, days[3] + timedelta(days=2) if n == 5 else days[4], latest, between)
    none = F.lit(None)
    history = spark.read.schema(f"{fx.RATES}, asof_year int").parquet(f"{path}/history").select(F.lit("history").alias("kind"), F.lit(0).alias("run"), F.col("symbol").alias("name"), "asof_date", "rate")
    live_now = fx.live_rates(spark, path).select(F.lit("live").alias("kind"), F.lit(0).alias("run"), F.col("symbol").alias("name"), "asof_date", "rate")
    status = spark.read.schema(f"{fx.STATUS}, run int").parquet(f"{path}/status").select(F.lit("status").alias("kind"), "run", F.col("mode").alias("name"), F.col("latest_date").alias("asof_date"), none.cast("double").alias("rate"))
    return history.unionByName(live_now).unionByName(status)


@query("copy_summaries", """WITH o AS (SELECT CASE WHEN o_orderkey % 37 = 5 THEN 'n/a ' || CAST(o_orderkey % 11 AS VARCHAR) WHEN o_orderkey % 41 <> 7 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS created_at FROM orders),
    r AS (SELECT *, TRY_CAST(created_at AS TIMESTAMP) AS t FROM o), m AS (SELECT ascii(right(created_at, 1)) % 5 AS k, min(created_at) AS s FROM r WHERE created_at IS NOT NULL AND t IS NULL GROUP BY 1),
    s AS (SELECT count(*) AS rows_read, count(*) FILTER (WHERE t IS NULL OR t >= TIMESTAMP '1996-01-01') AS rows_kept, count(*) FILTER (WHERE t IS NULL AND created_at IS NOT NULL) AS unparsable FROM r)
    SELECT n AS table_name, rows_read, rows_kept, CASE WHEN n = 'dry' THEN 0 ELSE rows_kept END AS rows_written, rows_read - rows_kept AS rows_skipped, unparsable, (SELECT coalesce(string_agg(s, ', ' ORDER BY s), '') FROM m) AS samples FROM s, (VALUES ('copied'), ('dry')) v(n)""")  # fmt: skip
def copy_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Orders with their dates as texts, some of which are none, copied from a cutoff on, and tried out: each in one pass that
    also gives the counts and some of the texts."""
    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    text = F.when(key % 37 == 5, F.concat(F.lit("n/a "), (key % 11).cast("string"))).when(key % 41 != 7, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    path = _folder(spark, "copies")
    o.select("o_orderkey", text.alias("created_at")).write.parquet(f"{path}/source")
    done = {n: copy.copy_table(spark, f"{path}/source", f"{path}/target", datetime(1996, 1, 1), dry_run=n == "dry") for n in ("copied", "dry")}
    return copy.summaries(done).withColumn("samples", F.array_join("samples", ", "))


@query("catalogue_clones", """SELECT c.table_name, c.ordinal_position AS ordinal, c.column_name, n.rows FROM information_schema.columns c JOIN (SELECT 'nation' AS t, count(*) AS rows FROM nation UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events) n ON n.t = c.table_name""")
def catalogue_clones(spark: SparkSession, d: str) -> DataFrame:
    """Given tables registered in a catalogue, their schemas cloned into another one, their rows copied there: the clones' columns
    and rows. Tables of all known kinds are made beside them, once."""
    names, tag = ("nation", "customer", "orders", "lineitem", "events"), uuid.uuid4().hex
    given, clones = catalogue.database(spark, f"given_{tag}"), catalogue.database(spark, f"clones_{tag}")
    for n in names:
        source = catalogue.register(spark, given, n, f"{d}/{n}.parquet")
        target = catalogue.clone_schema(spark, source, f"{clones}.{n}")
        spark.table(source).write.insertInto(target)
    catalogue.create_missing(spark, clones)
    counts = [spark.table(f"{clones}.{n}").agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows")) for n in names]
    rows = counts[0]
    for c in counts[1:]:
        rows = rows.unionByName(c)
    return catalogue.columns(spark, clones).join(rows, "table_name").select("table_name", "ordinal", "column_name", "rows")


# ---- small state and scalars of runs


@query("negative_cache_runs", """WITH u AS (SELECT DISTINCT user_id FROM events WHERE event_type <> 'view'), c AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_custkey, user_id IS NULL AS none FROM customer LEFT JOIN u ON u.user_id = c_custkey)
    SELECT id, CASE WHEN none AND c_custkey % 2 = 0 THEN 1 WHEN none THEN 2 END AS cached_in, NOT none AS asked_in_3 FROM c""")
def negative_cache_runs(spark: SparkSession, d: str) -> DataFrame:
    """Two runs ask for customers (those of even numbers, then all that aren't known to have nothing) and note those without events;
    a third one asks for the rest only. When each customer was noted, and whether the third run asks for it."""
    ids = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_custkey").cast("string").alias("id"))
    have = table(spark, d, "events").where("event_type <> 'view'").select(F.col("user_id").cast("string").alias("id")).distinct()
    path, noted = _folder(spark, "no-data"), []
    for run, asked in ((1, ids.where("key % 2 = 0")), (2, ids)):
        asked = negative_cache.without_known(asked, path)
        negative_cache.append(asked.join(have, "id", "left_anti"), path)
        noted.append(pinned(negative_cache.read(spark, path)).withColumn("run", F.lit(run)))  # as it is now
    first = noted[0].unionByName(noted[1]).groupBy("id").agg(F.min("run").alias("cached_in"))
    left = negative_cache.without_known(ids, path).select("id", F.lit(True).alias("_asked"))
    return ids.join(first, "id", "left").join(left, "id", "left").select("id", "cached_in", F.coalesce("_asked", F.lit(False)).alias("asked_in_3"))


@query("calendar_sequences", """WITH u AS (SELECT CAST(user_id AS VARCHAR) AS id, min(ts) AS a, min(ts) + INTERVAL 1 MINUTE * CAST(count(*) * 37 AS INT) AS b FROM events GROUP BY 1),
    s AS (SELECT id, 'slot' AS kind, unnest(generate_series(CASE WHEN time_bucket(INTERVAL '10 minutes', a) < a THEN time_bucket(INTERVAL '10 minutes', a) + INTERVAL 10 MINUTE ELSE a END, time_bucket(INTERVAL '10 minutes', b) - INTERVAL 10 MINUTE, INTERVAL 10 MINUTE)) AS starts FROM u),
    h AS (SELECT id, 'hour' AS kind, unnest(generate_series(CASE WHEN date_trunc('hour', a) < a THEN date_trunc('hour', a) + INTERVAL 1 HOUR ELSE a END, date_trunc('hour', b) - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS starts FROM u),
    d AS (SELECT id, 'day' AS kind, CAST(unnest(generate_series(CAST(b AS DATE) - 2, CAST(b AS DATE), INTERVAL 1 DAY)) AS TIMESTAMP) AS starts FROM u)
    SELECT id, kind, CAST(starts AS TIMESTAMP) AS starts FROM (SELECT * FROM s UNION ALL SELECT * FROM h UNION ALL SELECT * FROM d)""")  # fmt: skip
def calendar_sequences(spark: SparkSession, d: str) -> DataFrame:
    """The whole slots and hours of a window of each user, and the three days up to its end."""
    u = table(spark, d, "events").groupBy(F.col("user_id").cast("string").alias("id")).agg(F.min("ts").alias("a"), F.count(F.lit(1)).alias("n"))
    u = u.withColumn("b", plus_minutes(F.col("a"), F.col("n") * 37)).withColumn("a", F.col("a").cast("timestamp_ntz"))
    days = F.transform(last_days(F.to_date("b"), 3), lambda x: x.cast("timestamp_ntz"))
    parts = {"slot": whole_slots(F.col("a"), F.col("b")), "hour": whole_hours(F.col("a"), F.col("b")), "day": days}
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("starts")) for k, v in parts.items()])
    return u.select("id", F.inline(kinds)).select("id", "kind", F.explode("starts").alias("starts"))


@query("metrics_dump_preview", """SELECT event_id, '{"a_value":"' || CAST(event_id % 7 AS VARCHAR) || '","errors":"' || CAST(event_id % 3 AS VARCHAR) || '","wrote":"' || CAST(user_id AS VARCHAR) || '"}' AS dump,
    CASE WHEN event_id % 5 = 0 THEN '-' WHEN event_id % 5 = 1 THEN 'a_value=' || CAST(event_id % 7 AS VARCHAR) || ', b_value=x' ELSE 'wrote=' || CAST(user_id AS VARCHAR) || ', errors=' || CAST(event_id % 3 AS VARCHAR) END AS preview FROM events""")
def metrics_dump_preview(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of a run dumped with sorted keys, and the preview of what a stored text holds: broken texts give none, texts
    without a preferred metric their first ones."""
    text = lambda c: c.cast("string")
    k = F.col("event_id")
    metrics = F.create_map(F.lit("wrote"), text(F.col("user_id")), F.lit("a_value"), text(k % 7), F.lit("errors"), text(k % 3))
    dump = metrics_dump(metrics)
    other = F.concat(F.lit('{"b_value": "x", "a_value": '), text(k % 7), F.lit("}"))
    stored_text = F.when(k % 5 == 0, F.when(k % 2 == 0, "{broken").when(k % 3 == 0, "  ")).when(k % 5 == 1, other).otherwise(dump)
    return table(spark, d, "events").select("event_id", dump.alias("dump"), metrics_preview(metrics_of(stored_text)).alias("preview"))
