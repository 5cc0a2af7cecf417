"""Golden cases of the domain's traps, worked out by hand."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars, timeutil
from tidemark.operators import audit, bars, coverage, fill, merge, ordering, provenance, rollup, universe
from tidemark.sources import api, categories, copy, fx, tables

T = datetime(2024, 1, 1, 10)
CANDLE = "id string, ts timestamp_ntz, price double, candle_source string, point_count int, last_updated timestamp_ntz, market_cap double"


def at(minute: int, second: int = 0) -> datetime:
    return T + timedelta(minutes=minute, seconds=second)


def f1(spark):
    rows = [
        ("a", at(0), 100.0, "rolling_direct", 1, at(0, 30), 1000.0), ("a", at(10), 130.0, "rolling_carry", 0, at(0, 30), None),
        ("a", at(20), 90.0, "rolling_direct", 1, at(20, 10), 1100.0), ("a", at(30), 95.0, None, None, at(-60), 1200.0),
    ]
    return spark.createDataFrame(rows, CANDLE)


def ohlc(r):
    return (r.open, r.high, r.low, r.close, r.market_cap)


def test_strength_differs_by_rollup(spark):
    df = f1(spark)
    hour = bars.bars_from_ticks(df, timeutil.floor_hour(F.col("ts"))).first()
    assert ohlc(hour) == (100, 130, 90, 95, 1200)
    strong = ~provenance.weak_for_day(F.col("candle_source"), F.col("point_count"), F.col("last_updated"), F.col("ts"))
    day = bars.bars_from_ticks(df, F.to_date("ts"), strong=strong).first()
    assert ohlc(day) == (100, 100, 90, 90, 1200) and day.point_count == 2
    weak = [r[0] for r in df.select(provenance.weak_for_hour(F.col("candle_source"), F.col("point_count"))).collect()]
    assert weak == [False, True, False, True]


def carry(spark, cap):
    rows = [(("a"), at(10 * k), {1: 55.0}.get(k), {2: 51.0, 5: 60.0}.get(k), k == 5, k in (2, 5), 50.0) for k in range(8)]
    df = spark.createDataFrame(rows, "id string, slot timestamp_ntz, point double, stored double, stored_strong boolean, has_stored boolean, prior double")
    return [(r.action, r.value) for r in fill.carry_capped(df, cap).orderBy("slot").collect()]


def test_capped_carry(spark):
    want = [("carry", 50), ("direct", 55), ("existing", 51), ("carry", 55), ("carry", 55), ("existing", 60), ("carry", 60), ("carry", 60)]
    assert carry(spark, 4) == want
    assert carry(spark, 2) == [*want[:4], ("skip", None), *want[5:]]


def test_category_rollup(spark):
    rows = [("a", T, "X", 10.0, 1.0, at(1)), ("b", T, "X", 20.0, None, at(3)), ("c", T, "Y", 25.0, 2.0, at(2)), ("d", T, None, None, 4.0, at(0))]
    df = spark.createDataFrame(rows, "id string, slot timestamp_ntz, category string, market_cap double, volume_24h double, last_updated timestamp_ntz")
    got = {r.category: (r.market_cap, r.volume_24h, r.last_updated, r.market_cap_rank) for r in rollup.with_ranks(rollup.category_totals(df)).collect()}
    assert got == {"ALL": (55, 7, at(3), 0), "X": (30, 1, at(3), 1), "Y": (25, 2, at(2), 2), "Other": (0, 4, at(0), 3)}


def test_v_shape(spark):
    for caps, flag in (((1000e9, 900e9, 1000e9), True), ((1000e9, 940e9, 1000e9), False), ((600e9, 552e9, 600e9), False)):
        df = spark.createDataFrame([("ALL", at(10 * k), c) for k, c in enumerate(caps)], "category string, slot timestamp_ntz, market_cap double")
        assert [r.v_shape for r in rollup.v_shapes(df, key="category").orderBy("slot").collect()] == [False, flag, False]


def test_slot_decision(spark):
    def decide(has, ok, prev, low):
        args = (F.lit(has), F.lit(ok), F.lit(False), F.lit(None).cast("double"), F.lit(prev).cast("double"), F.lit(low))
        return spark.range(1).select(rollup.slot_decision(*args)).first()[0]

    assert decide(True, False, 1.0, True) == "quarantine_prev" and decide(True, False, None, False) == "quarantine_skip"
    assert decide(True, True, 1.0, True) == "skip_low_coin_count" and decide(True, True, None, False) == "direct" and decide(False, True, 1.0, False) == "no_slot_data"


def test_monthly(spark):
    rows = [("a", date(2024, 1, 1), 10.0, 12.0, 9.0, 11.0, None, 5.0, 100.0, 3), ("a", date(2024, 1, 2), None, None, None, None, 20.0, None, None, None), ("a", date(2024, 1, 3), 15.0, 16.0, 8.0, 14.0, None, 7.0, 140.0, None), ("b", date(2024, 1, 3), *[None] * 5, 1.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "id string, day date, open double, high double, low double, close double, price_usd double, volume_24h double, market_cap double, market_cap_rank int")
    (r,) = bars.monthly(df).collect()
    assert (r.year_month, r.open, r.high, r.low, r.close, r.volume, r.market_cap, r.market_cap_rank) == ("2024-01", 10, 20, 8, 14, 12, 140, 3)


def test_interpolation(spark):
    df = spark.createDataFrame([("a", T + timedelta(hours=k), {0: 10.0, 3: 16.0}.get(k)) for k in range(5)], "id string, slot timestamp_ntz, value double")
    run = lambda **o: [r.filled for r in fill.interpolate(df, **o).orderBy("slot").collect()]
    assert run(edges=True) == [10, 12, 14, 16, 16]
    assert run(edges=True, max_gap_min=120, wide="left") == [10, 10, 10, 16, 16]
    assert run() == [10, 12, 14, 16, None]
    assert run(max_gap_min=120) == [10, None, None, 16, None]
    assert run(max_gap_min=180) == [10, 12, 14, 16, None]


def test_coverage(spark):
    days = spark.createDataFrame([("a", date(2024, 1, k)) for k in (1, 2, 3, 5, 6, 9)], "id string, day date")
    ranges = coverage.day_ranges(days)
    assert sorted((r.start_date.day, r.end_date.day) for r in ranges.collect()) == [(1, 3), (5, 6), (9, 9)]
    opened = [coverage.open_range_start(ranges, F.to_date(F.lit(f"2024-01-0{k}"))).first().open_range_start for k in (6, 9, 7)]
    assert opened == [date(2024, 1, 5), date(2024, 1, 9), None]
    bits = spark.range(1).select(F.hex(scalars.bitmap(F.array(F.lit(0), F.lit(5), F.lit(143), F.lit(5)), 18))).first()[0]
    assert bits == "21" + "00" * 16 + "80"


def test_donor_cascade(spark):
    rows = []
    for k in range(8):
        hour = 200.0 if k < 6 else None
        rows.append(("a", at(10 * k), 210.0 if k == 2 else None, "own", k == 2, hour, "10m_final", None, None, None, None))
    df = spark.createDataFrame(rows, "id string, slot timestamp_ntz, own double, own_source string, has_own boolean, hour double, hour_source string, day double, day_source string, prev_hour double, prev_day double")
    got = [(r.close, r.candle_source) for r in fill.donor_cascade(df).orderBy("slot").collect()]
    hourly, carried = (200, "bf_10m_from_hourly:10m_final"), (200, "bf_10m_carry_10m")
    assert got == [hourly, hourly, (210, "own"), hourly, hourly, hourly, carried, carried]


def test_precedence(spark):
    rows = [("repair_api_points", 5), ("live_points", 2), ("repair_api_interp", 0), ("carry_prev", 0), (None, None)]
    df = spark.createDataFrame(rows, "s string, n int")
    assert [r[0] for r in df.select(provenance.precedence(F.col("s"), F.col("n"))).collect()] == [405, 302, 220, 120, 0]
    assert spark.range(1).select(merge.may_overwrite(F.lit("carry_prev"), F.lit(0), F.lit("repair_api_interp"), F.lit(0))).first()[0] is False


def test_drift(spark):
    raw = spark.createDataFrame([(k, 1000e9, 699 if k == 3 else 700) for k in range(4)], "slot int, raw_cap double, contributors long")
    stored = spark.createDataFrame([(0, 960e9), (1, 900e9), (3, 900e9)], "slot int, stored_cap double")
    assert {r.slot: r.finding for r in audit.drift(raw, stored).collect()} == {1: "mismatch_all", 2: "missing_all"}


def test_validity(spark):
    df = spark.createDataFrame([(10.0, 9.0, 8.0, 10.0), (10.0, 10.0, 10.0, 10.0), (9.0, 11.0, 8.0, 10.0), (None, 1.0, 1.0, 1.0)], "open double, high double, low double, close double")
    assert [(bool(r[0]), bool(r[1])) for r in df.select(audit.ohlc_invalid(), audit.flat()).collect()][:3] == [(True, False), (False, True), (False, False)]


def test_unique_ranks(spark):
    df = spark.createDataFrame([("A", 7, at(2), 5.0), ("B", 7, at(3), 1.0), ("C", 7, at(3), 4.0), ("D", None, at(9), 9.0)], "id string, market_cap_rank int, last_updated timestamp_ntz, market_cap double")
    got = {r.id: (r.market_cap_rank, r.demoted) for r in universe.unique_ranks(df).collect()}
    assert got == {"A": (None, True), "B": (None, True), "C": (7, False), "D": (None, False)}


def test_longest_run(spark):
    df = spark.createDataFrame([("a", k, v) for k, v in enumerate([1, 1, 2, 2, 2, 1])], "id string, t int, v int")
    assert audit.longest_equal_run(df, "id", "t", "v").first().longest_run == 3
    assert audit.longest_equal_run(df.limit(0), "id", "t", "v").count() == 0


def test_category_file(spark, tmp_path):
    (tmp_path / "c.csv").write_text('﻿ID;Symbol;Category\nbitcoin;BTC;"Layer 1s"\nx;;\nbitcoin;BTC;Store\n', encoding="utf-8")
    rows = categories.read_categories(spark, str(tmp_path / "c.csv"))
    by_id = {r.id: (r.category, r.conflict) for r in categories.last_wins(rows, "id").collect()}
    assert by_id == {"bitcoin": ("Store", True), "x": ("Other", False)}
    by_symbol = categories.last_wins(rows, "symbol")
    live = spark.createDataFrame([("unknown", "btc"), ("unknown2", "zzz"), ("X", None)], "id string, symbol string")
    got = {r.id: r.category for r in universe.with_category(live, categories.last_wins(rows, "id"), by_symbol).collect()}
    assert got == {"unknown": "Store", "unknown2": "Other", "X": "Other"}


def test_chained_open(spark):
    df = spark.createDataFrame([("a", T, 10.0), ("a", T + timedelta(hours=4), 8.0)], "id string, bucket timestamp_ntz, close double")
    seed = spark.createDataFrame([("a", 9.0)], "id string, close double")
    got = [(r.open, r.high, r.low, r.close) for r in fill.chained_open(df, seed).orderBy("bucket").collect()]
    assert got == [(9, 10, 9, 10), (10, 10, 8, 8)]


def test_fx(spark):
    json = spark.createDataFrame([('{"rates":{"2024-01-03":{"EUR":0.9},"2024-01-04":{"EUR":0.91},"2024-01-05":{"EUR":0.92}}}',)], "json string")
    marks = spark.createDataFrame([("EUR", date(2024, 1, 3))], "symbol string, watermark date")
    got = sorted((r.asof_date.day, r.rate, r.latest) for r in fx.new_rates(fx.range_payload(json), marks).collect())
    assert got == [(4, 0.91, False), (5, 0.92, True)]
    d = lambda k: F.to_date(F.lit(f"2024-01-0{k}"))
    assert spark.range(1).select(fx.next_watermark(d(3), d(5), F.lit(True)), fx.next_watermark(d(3), d(5), F.lit(False))).first()[:] == (date(2024, 1, 3), date(2024, 1, 5))
    assert spark.range(1).select(fx.latest_payload(F.lit('{"date":"2024-01-05","rates":{"EUR":0.9}}')).alias("p")).first().p.rates == {"EUR": 0.9}


def test_api_points(spark):
    t = 1_704_103_200_000
    json = f'{{"prices":[[{t},1.5],[{t + 600000},2.5],[{t + 86400000},9]],"market_caps":[[{t},10]],"total_volumes":[]}}'
    points = api.chart_points(spark.createDataFrame([("a", json)], "id string, json string"))
    assert points.where("metric = 'price'").count() == 3
    rows = {r.ts: (r.price, r.market_cap) for r in api.chart_rows(points).collect()}
    assert rows[T] == (1.5, 10.0)
    prices = points.where("metric = 'price'").select("id", "ts", "value")
    (r,) = bars.bars_from_points(prices, F.to_date("ts")).collect()
    assert (r.open, r.close, r.point_count) == (1.5, 2.5, 2)
    chunks = api.request_chunks(spark.createDataFrame([("a", T, T + timedelta(hours=5))], "id string, start timestamp_ntz, end timestamp_ntz"), 2).orderBy("chunk_start").collect()
    assert [(c.chunk_start, c.chunk_end) for c in chunks] == [(T, at(119, 59)), (at(120), at(239, 59)), (at(240), at(299, 59))]
    pages = spark.createDataFrame([(1, 1, "a", 5), (2, 1, "a", 6), (2, 2, None, 7)], "page int, place int, id string, v int")
    assert api.listing(pages).first().v == 5 and api.listing(pages, first_seen=False).first().v == 6


def test_asof_strict_and_aged(spark):
    left = spark.createDataFrame([("a", at(0), 1), ("a", at(10), 2), ("b", at(0), 3)], "id string, slot timestamp_ntz, k int")
    right = spark.createDataFrame([("a", at(0), 5.0), ("a", at(5), 6.0), ("a", None, 7.0)], "id string, t timestamp_ntz, v double")
    get = lambda **o: {r.k: r.asof_v for r in fill.asof(left, right, "id", "slot", "t", ["v"], **o).collect()}
    assert get() == {1: None, 2: 6.0, 3: None}
    assert get(strict=False) == {1: 5.0, 2: 6.0, 3: None}
    assert get(max_age_min=4) == {1: None, 2: None, 3: None}


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, s string, v double")
    new = spark.createDataFrame([(2, "c", None), (3, "d", 3.0)], "k int, s string, v double")
    assert sorted(map(tuple, merge.upsert(old, new, ["k"]).collect()), key=lambda r: r[0]) == [(1, "a", 1.0), (2, "c", None), (3, "d", 3.0)]
    assert {r.k: r.applied for r in merge.insert_if_absent(old, new, ["k"]).collect()} == {2: False, 3: True}
    j = merge.with_stored(new, old, ["k"], ["v"])
    assert {r.k: r.v for r in merge.fill_missing(j, ["v"], zero=("v",)).collect()} == {2: 2.0, 3: 3.0}
    same = merge.with_stored(spark.createDataFrame([(1, 1.0 + 1e-13), (2, 2.1)], "k int, v double"), old, ["k"], ["v"])
    assert {r.k: r.u for r in same.select("k", merge.unchanged(["v"]).alias("u")).collect()} == {1: True, 2: False}


def test_ordering(spark):
    ids = spark.createDataFrame([(f"{k:03d}",) for k in range(50)], "id string")
    assert sorted((r.id, r.position) for r in universe.shard(ids, 7, 3).collect()) == [(f"{k:03d}", k) for k in range(50) if k % 7 == 3]
    plans = spark.createDataFrame([("a", 2), ("b", 1), ("c", 1), ("d", 5)], "id string, cost int")
    assert sorted(r.id for r in ordering.budget_prefix(plans, "cost", 4, ["cost"], "id").collect()) == ["a", "b", "c"]
    assert universe.new_entrants(spark.createDataFrame([("a", 2), ("b", 1)], "id string, market_cap_rank int"), spark.createDataFrame([("b", date(2020, 1, 1))], "id string, first_day date"), "2023-01-01").first().id == "a"


def test_tables(spark, tmp_path):
    p = str(tmp_path / "t")
    df = tables.create(spark, p, "coverage_ranges")
    assert df.count() == 0 and tables.create(spark, p, "coverage_ranges").columns == df.columns and tables.describe(df)[0] == ("id", "string")
    q = str(tmp_path / "q")
    assert not tables.refresh_if_enough(spark.range(3), q, 4) and tables.refresh_if_enough(spark.range(5), q, 4) and spark.read.parquet(q).count() == 5
    got = copy.copy_table(spark, q, str(tmp_path / "r"), dry_run=True).first()
    assert (got.rows_read, got.rows_written) == (5, 0)
    assert copy.copy_table(spark, q, str(tmp_path / "r"), truncate=True).first().rows_written == 5
    r = str(tmp_path / "parts")
    tables.replace_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string"), r, "day")
    tables.replace_partitions(spark.createDataFrame([(3, "b")], "v int, day string"), r, "day")
    assert sorted(x.v for x in spark.read.parquet(r).collect()) == [1, 3]
    old = spark.createDataFrame([(at(0),), (at(-60 * 24 * 9),)], "ts timestamp_ntz")
    assert tables.retained(old, "ts", F.lit(at(1)).cast("timestamp_ntz"), 8).count() == 1


def test_scalars(spark):
    now = timeutil.guarded_now(datetime(2024, 1, 1, 10, 1, 30))
    assert now == datetime(2024, 1, 1, 9, 50)
    r = spark.createDataFrame([(datetime(2024, 1, 31, 23, 59, 59),)], "t timestamp_ntz").select(
        timeutil.ceil_slot(F.col("t")).alias("c"), timeutil.slot_index(F.col("t")).alias("i"), timeutil.next_month_start(F.col("t")).alias("n"), timeutil.lock_bucket(F.col("t")).alias("l"),
        timeutil.parse_time(F.lit("2024-01-01T00:00:00Z")).alias("iso"), timeutil.parse_time(F.lit("1704067200000")).alias("ms"), timeutil.parse_time(F.lit("1704067200")).alias("s"), timeutil.parse_time(F.lit("junk")).alias("bad"),
        scalars.number(F.lit("x"), F.lit(2.0)).alias("x"), scalars.same(F.lit(1.0), F.lit(1.0 + 1e-13)).alias("same"), scalars.route(F.lit("hint"), 5).alias("route"), scalars.clamp(F.lit(9.0), 0, 5).alias("clamp"),
    ).first()
    import zlib

    t0 = datetime(2024, 1, 1)
    assert (r.c, r.i, r.n, r.l, r.iso, r.ms, r.s, r.bad) == (datetime(2024, 2, 1), 143, date(2024, 2, 1), "2024013122", t0, t0, t0, None)
    assert (r.x, r["same"], r.route, r.clamp) == (2.0, True, zlib.crc32(b"hint") % 5, 5.0)


def test_upsert_stream(spark, tmp_path):
    from tidemark.streaming.bars import tumbling, upsert_batches

    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    rows = [(at(1), "a", 1.0), (at(2), "a", 3.0), (at(14), "a", 2.0)]
    schema = "ts timestamp_ntz, event_type string, value double"
    for k, part in enumerate((rows[:1], rows[1:])):
        spark.createDataFrame(part, schema).write.mode("append").parquet(src)
        stream = tumbling(spark.readStream.schema(schema).parquet(src))
        q = upsert_batches(stream, out, ["id", "bucket"], str(tmp_path / "state"))
        q.processAllAvailable()
        q.stop()
        assert spark.read.parquet(f"{out}/rows").count() == k + 1
    got = {r.bucket: (r.open, r.close, r.point_count) for r in spark.read.parquet(f"{out}/rows").collect()}
    assert got == {at(0): (1.0, 3.0, 2), at(10): (2.0, 2.0, 1)}


@pytest.mark.parametrize("parts", [0, 1, 3])
def test_stream_reads_folders_and_open_slots(spark, tmp_path, parts):
    import os

    import __spark_entry__ as entry
    from conftest import SMALL

    if parts:
        spark.read.parquet(f"{SMALL}/events.parquet").repartition(parts).write.parquet(f"{tmp_path}/events.parquet")
    else:
        os.symlink(f"{SMALL}/events.parquet", tmp_path / "events.parquet")
    columns = ["id", "bucket", "open", "high", "low", "close", "point_count"]
    got = entry.queries()["stream_tumbling_10m"](spark, str(tmp_path)).select(columns).collect()
    want = entry.queries()["ohlc_10m"](spark, str(tmp_path)).select(columns).collect()
    assert len(got) > 100 and sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_rounded_is_binary(spark):
    """Halves that binary doubles hold go away from zero; a product a hair below a half goes down; nulls stay null."""
    rows = spark.createDataFrame([(0, 0.5), (1, -0.5), (2, 33.1896875), (3, None), (4, 2.25)], "k int, x double")
    got = {r.k: (r.a, r.b) for r in rows.select("k", scalars.rounded(F.col("x"), 0).alias("a"), scalars.rounded(F.col("x"), 1).alias("b")).collect()}
    assert got == {0: (1.0, 0.5), 1: (-1.0, -0.5), 2: (33.0, 33.2), 3: (None, None), 4: (2.0, 2.3)}
