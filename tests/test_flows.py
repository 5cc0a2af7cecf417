"""State that is carried: fills cut by day, streams with timers, stored tables changed in place, paged sources."""

from __future__ import annotations

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars, timeutil
from tidemark.operators import cascade, coverage, fill, rollup
from tidemark.sources import api, catalogue, copy, fx, negative_cache, pages, stored, tables
from tidemark.streaming import carry, late

T0 = datetime(2024, 1, 1)
STEP = timedelta(minutes=10)


def brute_carry(rows, cap):
    """rows: (slot, point, stored, strong, has_stored) in order; the action and value of each, one slot after the other."""
    anchor, n, out = None, 0, []
    for _, point, stored, strong, has in rows:
        if (strong and stored is not None) or point is not None:
            anchor, n = (stored if strong else point), 0
        elif not has or stored is not None:
            n += 1
        action = "existing" if strong else "direct" if point is not None else "existing" if has else "carry" if anchor is not None and n <= cap else "skip"
        out.append((action, {"existing": stored, "direct": point, "carry": anchor, "skip": None}[action]))
    return out


def test_carry_goes_over_days(spark):
    rng, rows = random.Random(5), []
    for i in range(3):
        for k in range(700):
            kind = rng.choice("....sw." if rng.random() < 0.4 else "p.....") if i else rng.choice("." * 300 + "pw")
            v = float(rng.randint(1, 99))
            rows.append((f"i{i}", T0 + STEP * k, v if kind == "p" else None, v if kind in "sw" and rng.random() < 0.9 else None, kind == "s", kind in "sw"))
    df = spark.createDataFrame(rows, "id string, slot timestamp_ntz, point double, stored double, stored_strong boolean, has_stored boolean")
    got = {(r["id"], r["slot"]): (r["action"], r["value"]) for r in fill.carry_capped(df.withColumn("prior", F.lit(None).cast("double")), cap=150).collect()}
    for i in range(3):
        mine = [r for r in rows if r[0] == f"i{i}"]
        want = brute_carry([r[1:] for r in mine], 150)
        assert [got[r[0], r[1]] for r in mine] == want


def test_interpolation_is_linear_in_slots(spark):
    """100,000 slots of one id, known at both ends and here and there: seconds, not minutes, and in more than one task."""
    known = F.when((F.col("k") % 997 == 3) | (F.col("k") == 99_999), F.col("k") * 2.0)
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("k") * 600).cast("timestamp_ntz")
    df = spark.range(100_000).withColumnRenamed("id", "k").select(F.lit("a").alias("id"), at.alias("slot"), "k", known.alias("value"))
    began = time.time()
    out = fill.interpolate(df, edges=True).where("abs(filled - greatest(k, 3) * 2.0) < 1e-6").count()
    assert out == 100_000
    assert time.time() - began < 40


def test_neighbours_keep_null_times_and_ids_apart(spark):
    rows = [(None, T0, 1.0), (None, T0 + STEP, None), ("a", None, 5.0), ("a", T0, None), ("a", T0 + 300 * STEP, 2.0), ("b", T0, None)]
    df = spark.createDataFrame(rows, "id string, slot timestamp_ntz, value double")
    got = {(r["id"], r["slot"]): r["filled"] for r in fill.interpolate(df, edges=True).collect()}
    assert got[None, T0 + STEP] == 1.0 and got["a", T0] == 2.0 and got["b", T0] is None and len(got) == 6


MS = 60_000


def test_advance():
    step = 10 * MS
    waiting = {0: (1, 5.0, carry.OBSERVED), 3 * step: (1, 7.0, carry.WEAK)}
    state, out, gone = carry.advance((None, 2, 0), waiting, 4 * step, 2, step)
    assert out == [(0, "direct", 5.0), (step, "carry", 5.0), (2 * step, "carry", 5.0), (3 * step, "existing", 7.0)]
    assert state is None and gone == [0, 3 * step]
    state, out, gone = carry.advance((5.0, 0, step), {4 * step: (1, 1.0, carry.STRONG)}, 3 * step - 1, 4, step)
    assert out == [(step, "carry", 5.0)] and state == (5.0, 1, 2 * step) and not gone
    assert carry.advance((5.0, 4, step), {}, 99 * step, 4, step) == (None, [], [])


@pytest.mark.parametrize("batches", [1, 4])
def test_carry_stream_equals_batch(spark, batches):
    """Any number of runs gives what the batch form gives for slots behind the watermark."""
    rng, rows = random.Random(7), []
    for i in range(4):
        for _ in range(60):
            at = T0 + timedelta(minutes=rng.randint(0, 3 * 24 * 60), seconds=rng.randint(0, 59), microseconds=rng.randint(0, 999_999))
            rows.append((f"i{i}", at, rng.choice([None, float(rng.randint(1, 9))])))
    ticks = spark.createDataFrame(rows, "id string, ts timestamp_ntz, price double")
    kind = F.pmod(F.hour("ts"), F.lit(3)).cast("int")
    got = sorted((r["id"], r["slot"], r["action"], r["value"]) for r in carry.replay(ticks, kind, batches=batches, cap=5, delay="1 minute").collect())
    slot = lambda t: t.replace(minute=t.minute // 10 * 10, second=0, microsecond=0)
    closed, want = max(r[1] for r in rows) - timedelta(minutes=1), []
    for i in range(4):
        last = {}
        for _, at, price in sorted(r for r in rows if r[0] == f"i{i}" and r[2] is not None):
            last[slot(at)] = price
        line = []
        for k in range(3 * 144 + 1):
            s = T0 + STEP * k
            v, kind_of = last.get(s), s.hour % 3
            line.append((s, v if kind_of == 2 else None, v if kind_of != 2 else None, v is not None and kind_of == 0, v is not None and kind_of != 2))
        for (s, *_), (action, value) in zip(line, brute_carry(line, 5), strict=True):
            if action != "skip" and s + STEP <= closed:
                want.append((f"i{i}", s, action, value))
    assert got == sorted(want)


def test_carry_stream_of_nothing(spark):
    empty = spark.createDataFrame([], "id string, ts timestamp_ntz, price double")
    assert carry.replay(empty, F.lit(carry.OBSERVED)).count() == 0


def stored_pages(tmp_path, contents):
    import json

    for page, records in contents.items():
        (tmp_path / f"page={page}").mkdir()
        (tmp_path / f"page={page}" / "part-0.txt").write_text(json.dumps(records))
        (tmp_path / f"page={page}" / "_SUCCESS").write_text("")
    return f"file://{tmp_path}"


def test_listing_ends_at_a_short_page(spark, tmp_path):
    full = lambda p: [{"id": f"{p}-{k}"} for k in range(3)]
    path = stored_pages(tmp_path, {1: full(1), 2: full(2), 3: [{"id": "3-0"}, "no record"], 4: full(4), 5: full(5)})
    for each in (1, 2, 10):
        rows = pages.whole_listing(pages.read_pages(spark, path, 9, per_page=3, pages_per_task=each), 3)
        assert sorted((r["page"], r["place"]) for r in rows.collect()) == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2), (3, 0)]


def test_listing_ends_at_a_missing_page_or_no_list(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    gap = stored_pages(tmp_path / "a", {1: [{"id": "x"}], 3: [{"id": "y"}]})
    error = stored_pages(tmp_path / "b", {1: [{"id": "x"}], 2: {"error": "limit"}, 3: [{"id": "y"}]})
    for path in (gap, error):
        assert [r["payload"] for r in pages.whole_listing(pages.read_pages(spark, path, 5, per_page=1, pages_per_task=1), 1).collect()] == ['{"id": "x"}']
    assert pages.whole_listing(pages.read_pages(spark, f"file://{tmp_path}/none", 5, per_page=1), 1).count() == 0


def test_page_filters_reach_the_source(spark, tmp_path):
    path = stored_pages(tmp_path, {p: [{"id": str(p)}] for p in range(1, 31)})
    rows = pages.read_pages(spark, path, 30, per_page=1, pages_per_task=1).where("page >= 4 and page < 7 and place is not null")
    assert rows.rdd.getNumPartitions() == 3
    assert sorted(r["page"] for r in rows.collect()) == [4, 5, 6]
    assert pages.read_pages(spark, path, 30, per_page=1).where("page = 31").count() == 0


def test_window_pages():
    assert pages.window_pages(1, 250) == (1, 1) and pages.window_pages(250, 251) == (1, 2) and pages.window_pages(251, 251) == (2, 2)


def test_first_and_last_seen(spark):
    rows = spark.createDataFrame([(1, 0, "a", 1), (2, 5, "a", 2), (1, 1, None, 3), (1, 2, "b", 4)], "page int, place int, id string, v int")
    assert sorted((r["id"], r["v"]) for r in api.listing(rows).collect()) == [("a", 1), ("b", 4)]
    assert sorted((r["id"], r["v"]) for r in api.listing(rows, first_seen=False).collect()) == [("a", 2), ("b", 4)]


# ---- late data


def run_late(spark, path, runs, lookback=2):
    for number, rows in enumerate(runs):
        late.apply_arrivals(spark.createDataFrame(rows, late.TICKS), number, path, lookback)


def hours_of(spark, path):
    rows = spark.read.schema(f"{late.HOURS}, day date").parquet(f"{path}/hours").collect()
    return {(r["id"], r["bucket"]): (r["open"], r["close"], r["point_count"], r["candle_source"], r["changed_in"]) for r in rows}


def at(hours, minutes=0):
    return T0 + timedelta(hours=hours, minutes=minutes)


def test_late_rows_change_partial_hours_and_never_final_ones(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    run_late(spark, path, [
        [("a", at(0, 10), 1.0), ("a", at(0, 50), 2.0), ("a", at(1, 5), 3.0)],
        [("a", at(0, 55), 9.0), ("b", at(2, 0), 4.0)],  # late, but in time
        [("a", at(3, 30), 5.0)],  # now 3:30: the hour 0 is over by two hours
        [("a", at(0, 20), 7.0), ("a", at(1, 10), 8.0)],  # too late for the hour 0, not for the hour 1
        [("a", at(50), 6.0)],  # days later: all before is final, though nothing came for it
    ])
    got = hours_of(spark, path)
    assert got["a", at(0)] == (1.0, 9.0, 3, late.FINAL, 2)
    assert got["a", at(1)] == (3.0, 8.0, 2, late.FINAL, 4)
    assert got["b", at(2)] == (4.0, 4.0, 1, late.FINAL, 4)
    assert got["a", at(50)] == (6.0, 6.0, 1, late.PARTIAL, 4)
    aside = spark.read.parquet(f"{path}/too_late").collect()
    assert [(r["id"], r["ts"], r["price"], r["batch"]) for r in aside] == [("a", at(0, 20), 7.0, 3)]
    finals = spark.read.schema(f"{late.HOURS}, batch long").parquet(f"{path}/emitted").where(F.col("candle_source") == late.FINAL)
    assert finals.count() == finals.select("id", "bucket").distinct().count() == 4


def test_a_repeated_run_makes_the_same(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    runs = [[("a", at(0, 10), 1.0)], [("a", at(4, 10), 2.0), ("a", at(0, 20), 3.0)], [("a", at(5, 0), 4.0)]]
    run_late(spark, path, runs)
    want = hours_of(spark, path), sorted(map(str, spark.read.parquet(f"{path}/emitted").collect()))
    late.apply_arrivals(spark.createDataFrame(runs[2], late.TICKS), 2, path, 2)
    assert (hours_of(spark, path), sorted(map(str, spark.read.parquet(f"{path}/emitted").collect()))) == want


def test_an_empty_run(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    run_late(spark, path, [[], [("a", at(0), 1.0)], []])
    assert hours_of(spark, path) == {("a", at(0)): (1.0, 1.0, 1, late.PARTIAL, 1)}


# ---- stored levels and tables


def slots_table(spark, days=40):
    n = spark.range(days * 144).select(F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 600).cast("timestamp_ntz").alias("bucket"), F.explode(F.array(*map(F.lit, "abc"))).alias("id"), (F.col("id") % 17 + 1.0).alias("v"))
    return n.select("id", "bucket", *[F.col("v").alias(c) for c in ("open", "high", "low", "close")], F.lit(1).cast("long").alias("point_count"), F.lit(1).cast("long").alias("rows_seen"), F.col("v").alias("market_cap"), F.col("v").alias("volume_24h"), F.col("bucket").alias("last_updated"))


def levels_of(spark, path):
    names = [f"{level.name}{t}" for level in cascade.LEVELS for t in ("", "_totals")]
    return {n: sorted(map(str, spark.read.parquet(f"{path}/{n}").withColumn("part", F.col("part").cast("string")).collect())) for n in names}


def test_cascade_equals_a_full_recompute_and_leaves_other_partitions(spark, tmp_path):
    slots = slots_table(spark)
    categories = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None)], "id string, category string")
    one, two = f"file://{tmp_path}/one", f"file://{tmp_path}/two"
    cascade.build(slots, categories, one)
    before = {level.name: stored.files(spark, f"{one}/{level.name}") for level in cascade.LEVELS}
    hit = (F.col("id") == "b") & (F.dayofmonth("bucket") == 5) & (F.hour("bucket") == 3) & (F.month("bucket") == 1)
    changed = slots.where(hit).withColumn("market_cap", F.lit(500.0)).withColumn("high", F.lit(99.0))
    written = cascade.recompute(changed, categories, one)
    assert [list(map(str, written[n])) for n in ("slots", "hours", "days")] == [["2024-01-05"], ["2024-01-05"], ["2024-01-01"]]
    cascade.build(slots.where(~hit).unionByName(changed), categories, two)
    assert levels_of(spark, one) == levels_of(spark, two)
    for level in cascade.LEVELS:
        after = stored.files(spark, f"{one}/{level.name}")
        assert {p for p in after if after[p] != before[level.name][p]} == set(map(str, written[level.name]))
        assert len(after) > 1
    assert cascade.recompute(changed.limit(0), categories, one)["days"] == []
    assert levels_of(spark, one) == levels_of(spark, two)


def test_retention_and_deletes_touch_only_their_partitions(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    schema = "id long, v long, day date"
    rows = spark.range(60).select("id", (F.col("id") % 6).alias("v"), F.date_add(F.lit("2024-02-25").cast("date"), (F.col("id") % 10).cast("int")).alias("day"))
    stored.replace_partitions(rows, path, "day")
    before = stored.files(spark, path)
    assert len(before) == 10 and stored.retain(spark, path, datetime(2024, 2, 28).date()) == ["2024-02-25", "2024-02-26", "2024-02-27"]
    changed = stored.delete_rows(spark, path, F.col("id").isin(4, 14), schema)
    assert list(map(str, changed)) == ["2024-02-29"]
    assert list(map(str, stored.delete_rows(spark, path, F.col("v") >= 0, schema, within=F.col("day") == "2024-03-01"))) == ["2024-03-01"]
    assert stored.delete_rows(spark, path, F.col("v") > 99, schema) == []
    after = stored.files(spark, path)
    assert set(before) - set(after) == {"2024-02-25", "2024-02-26", "2024-02-27", "2024-03-01"}
    assert {p for p in after if after[p] != before[p]} == {"2024-02-29"}
    left = {r["id"] for r in spark.read.schema(schema).parquet(path).collect()}
    assert left == {i for i in range(60) if i % 10 >= 3 and i not in (4, 14) and i % 10 != 5}


# ---- bitmaps, rates, copies, the catalogue


def test_bitmaps_of_batches_equal_one_pass(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), T0 + timedelta(minutes=rng.randint(0, 5000)), rng.randint(0, 2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "id string, ts timestamp_ntz, batch int")
    slot, day = F.hour("ts") * 6 + F.floor(F.minute("ts") / 10), F.to_date("ts")
    maps = [coverage.slot_bitmaps(df.where(F.col("batch") == n), slot, day) for n in range(3)]
    got = coverage.merged_bitmaps(maps[0].union(maps[1]).union(maps[2]), ["id", "day"]).collect()
    assert len(got) == len({(i, t.date()) for i, t, _ in rows})
    for r in got:
        mine = [t for i, t, _ in rows if i == r["id"] and t.date() == r["day"]]
        slots = {t.hour * 6 + t.minute // 10 for t in mine}
        assert len(r["bitmap"]) == 18 and {8 * k + b for k, v in enumerate(r["bitmap"]) for b in range(8) if v >> b & 1} == slots
        assert (r["set_count"], r["first_seen"], r["last_seen"]) == (len(slots), min(mine), max(mine))
    again = coverage.merged_bitmaps(coverage.merged_bitmaps(maps[0].union(maps[1]), ["id", "day"]).drop("set_count").unionByName(maps[2]), ["id", "day"])
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


D = lambda day: datetime(2024, 3, day).date()


def rates_on(spark, *days, rate=None):
    return spark.createDataFrame([(s, D(d), float(rate or d)) for d in days for s in ("EUR", "CHF")], fx.RATES)


def published(spark, path):
    history = {(r["symbol"], r["asof_date"]): r["rate"] for r in spark.read.parquet(f"{path}/history").collect()}
    return {k[1].day: v for k, v in history.items() if k[0] == "EUR"}, {r["symbol"]: (r["asof_date"].day, r["rate"]) for r in fx.live_rates(spark, path).collect()}, fx.status_of(spark, path)[:2]


def test_rates_are_published_run_by_run(spark, tmp_path):
    path = f"file://{tmp_path}/fx"
    with pytest.raises(RuntimeError):
        fx.publish(spark, path, 1, D(1), None, None)  # nothing to fall back on
    assert fx.publish(spark, path, 2, D(1), rates_on(spark, 1), None) == "first"
    assert fx.publish(spark, path, 3, D(4), rates_on(spark, 4), rates_on(spark, 1, 2, 4)) == "span"
    assert published(spark, path) == ({1: 1.0, 2: 2.0, 4: 4.0}, {"EUR": (4, 4.0), "CHF": (4, 4.0)}, ("span", D(4)))
    assert fx.publish(spark, path, 4, D(8), rates_on(spark, 8), None) == "degraded"
    assert published(spark, path) == ({1: 1.0, 2: 2.0, 4: 4.0, 8: 8.0}, {"EUR": (8, 8.0), "CHF": (8, 8.0)}, ("degraded", D(4)))
    want = published(spark, path)
    assert fx.publish(spark, path, 5, D(7), None, None) == "stale" and published(spark, path)[:2] == want[:2]
    with pytest.raises(RuntimeError):
        fx.publish(spark, path, 6, D(8), None, None)  # the watermark is four days old
    assert fx.publish(spark, path, 6, D(8), rates_on(spark, 8), rates_on(spark, 4, 6)) == "span"  # the latest day isn't in the span
    assert published(spark, path) == ({1: 1.0, 2: 2.0, 4: 4.0, 6: 6.0, 8: 8.0}, {"EUR": (8, 8.0), "CHF": (8, 8.0)}, ("span", D(8)))
    assert fx.publish(spark, path, 7, D(9), rates_on(spark, 8, rate=80), None) == "refresh"
    assert fx.publish(spark, path, 8, D(12), rates_on(spark, 12), rates_on(spark, 12).limit(0)) == "empty"
    assert published(spark, path) == ({1: 1.0, 2: 2.0, 4: 4.0, 6: 6.0, 8: 80.0, 12: 12.0}, {"EUR": (12, 12.0), "CHF": (12, 12.0)}, ("empty", D(12)))


def test_a_repeated_publication_makes_the_same(spark, tmp_path):
    path = f"file://{tmp_path}/fx"
    fx.publish(spark, path, 1, D(1), rates_on(spark, 1), None)
    fx.publish(spark, path, 2, D(3), rates_on(spark, 3), rates_on(spark, 2, 3))
    want = published(spark, path)
    assert fx.publish(spark, path, 2, D(3), rates_on(spark, 3), rates_on(spark, 2, 3)) == "span" and published(spark, path) == want


def test_copy_counts_while_it_writes(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    times = ["2024-01-01 00:00:00", "2024-03-01 00:00:00", None, *[f"bad {k}" for k in range(40)]]
    spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, ts string").write.parquet(source)
    r = copy.copy_table(spark, source, target, datetime(2024, 2, 1)).first()
    assert (r["rows_read"], r["rows_kept"], r["rows_written"], r["rows_skipped"], r["unparsable"]) == (43, 42, 42, 1, 40)
    assert 0 < len(r["samples"]) <= copy.SAMPLES and all(s.startswith("bad") for s in r["samples"])
    assert spark.read.parquet(target).count() == 42
    dry = copy.copy_table(spark, source, str(tmp_path / "none"), datetime(2024, 2, 1), dry_run=True).first()
    assert dry["rows_written"] == 0 and dry["rows_kept"] == 42 and not (tmp_path / "none").exists()
    plain = copy.copy_table(spark, source, target, candidates=("none",)).first()
    assert plain["rows_written"] == 43 and plain["unparsable"] == 0 and plain["samples"] == []


def test_catalogue(spark, tmp_path):
    db = catalogue.database(spark, "catalogue_test")
    made = catalogue.create_missing(spark, db)
    assert sorted(made) == sorted(tables.SCHEMAS) == catalogue.tables(spark, db) and catalogue.create_missing(spark, db) == []
    got = [(r["table_name"], r["column_name"]) for r in catalogue.columns(spark, db).orderBy("table_name", "ordinal").collect()]
    assert got == [(k, c.split()[0]) for k in sorted(tables.SCHEMAS) for c in tables.SCHEMAS[k].split(", ")]
    spark.range(3).write.parquet(str(tmp_path / "x"))
    clone = catalogue.clone_schema(spark, catalogue.register(spark, db, "given", str(tmp_path / "x")), f"{db}.clone")
    assert spark.table(clone).count() == 0 and spark.table(clone).columns == ["id"] and spark.table(f"{db}.given").count() == 3
    spark.sql(f"DROP DATABASE {db} CASCADE")


# ---- small state and scalars of runs


def test_coverage_against_stored_totals(spark):
    rows = [(at(k), "ALL", float(v)) for k, v in enumerate([100, 80, 60, 50, 90])]
    totals = spark.createDataFrame(rows, "slot timestamp_ntz, category string, market_cap double")
    kept = totals.where(F.col("slot").isin(at(0), at(3)))
    got = {r["slot"]: (r["prev_slot"], r["prev_all"], r["coverage_ratio"], r["drop_pct"]) for r in rollup.coverage_against_stored(totals, kept).collect()}
    assert got[at(0)][1] is None and got[at(0)][2] is None
    assert got[at(1)] == (at(0), 100.0, 0.8, pytest.approx(0.2)) and got[at(3)][:3] == (at(0), 100.0, 0.5)  # its own stored total doesn't count
    assert got[at(4)][:3] == (at(3), 50.0, 1.8) and got[at(4)][3] == 0.0


def test_negative_cache(spark, tmp_path):
    path = f"file://{tmp_path}/cache"
    assert negative_cache.read(spark, path).count() == 0
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    negative_cache.append(ids("a", " b ", "", None), path)
    negative_cache.append(ids("b", "c"), path)
    assert sorted(r["id"] for r in negative_cache.read(spark, path).collect()) == ["a", "b", "c"]
    assert spark.read.text(path).count() == 3
    assert sorted(str(r["id"]) for r in negative_cache.without_known(ids("a", "d", None), path).collect()) == ["None", "d"]


def test_whole_slots_and_hours(spark):
    rows = [(at(0, 1), at(2, 5)), (at(1), at(3)), (at(1, 55), at(2, 5)), (at(2), at(1))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(timeutil.whole_slots(F.col("a"), F.col("b")), timeutil.whole_hours(F.col("a"), F.col("b"))).collect()
    assert got[0][0][0] == at(0, 10) and got[0][0][-1] == at(1, 50) and got[0][1] == [at(1)]
    assert got[1][1] == [at(1), at(2)] and len(got[1][0]) == 12
    assert got[2][0] == [] and got[2][1] == [] and got[3][0] == [] and got[3][1] == []


def test_metrics_texts(spark):
    texts = ['{"b": 1, "a": "x"}', '{"errors": 2, "wrote": 3, "zz": 1, "coins": 9, "api_failures": 0, "missing_slots": 4}', "[1]", "nonsense", "", None, "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(scalars.metrics_preview(scalars.metrics_of(F.col("t")))).collect()]
    assert got == ["a=x, b=1", "coins=9, wrote=3, missing_slots=4, api_failures=0", "-", "-", "-", "-", "-"]
    m = F.create_map(F.lit("b"), F.lit("1"), F.lit("a"), F.lit("2"))
    assert spark.range(1).select(scalars.metrics_dump(m), scalars.metrics_dump(F.lit(None).cast("map<string,string>"))).first()[:] == ('{"a":"2","b":"1"}', "{}")
    long = F.create_map(F.lit("k"), F.repeat(F.lit("x"), 20_000))
    assert len(spark.range(1).select(scalars.metrics_dump(long)).first()[0]) == scalars.MAX_METRICS_JSON
