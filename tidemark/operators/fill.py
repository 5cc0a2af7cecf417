"""Spines, as-of values, bounded carry-forward, interpolation and donor cascades, all as windows over ordered series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeutil import SLOT_MINUTES, minutes_between
from tidemark.operators.provenance import lineage


def spine(entities: DataFrame, bounds: DataFrame, minutes: int = SLOT_MINUTES) -> DataFrame:
    """Every entity at every slot in [start, end); bounds: one row. Only the two bounds go to the tasks."""
    slots = F.sequence("_start", F.col("_end") - F.make_dt_interval(mins=F.lit(minutes)), F.make_dt_interval(mins=F.lit(minutes)))
    one = bounds.select(F.col("start").alias("_start"), F.col("end").alias("_end"))
    return entities.crossJoin(F.broadcast(one)).where("_start < _end").select(*entities.columns, F.explode(slots).alias("slot"))


def whole_days(rows: DataFrame, ts: str = "ts") -> DataFrame:
    """One row: start of the first and end of the last day of the rows."""
    first, last = F.date_trunc("day", F.min(ts)), F.date_trunc("day", F.max(ts)) + F.expr("interval 1 day")
    return rows.agg(first.cast("timestamp_ntz").alias("start"), last.cast("timestamp_ntz").alias("end"))


def asof(left: DataFrame, right: DataFrame, on: str, left_time: str, right_time: str, values: list[str], strict: bool = True, max_age_min: int | None = None) -> DataFrame:
    """left with the values of the latest right row before left_time (or at it, unless strict).

    One window for each entity and day over the union of both sides; what a day starts with comes from one row an entity and
    day. So an entity with a long or crowded history is spread over its days.
    """
    names = [f"asof_{v}" for v in values]
    at = F.struct(F.col(right_time).alias("t"), *[F.col(v).alias(v) for v in values])
    known = right.where(F.col(right_time).isNotNull())
    blank = [F.lit(None).cast(left.schema[c].dataType).alias(f"_l_{c}") for c in left.columns if c != on]
    r = known.select(F.col(on), F.col(right_time).alias("_t"), F.lit(1 if strict else 0).alias("_side"), at.alias("_r"), *blank)
    own = [F.col(c).alias(f"_l_{c}") for c in left.columns if c != on]
    lf = left.select(F.col(on), F.col(left_time).alias("_t"), F.lit(0 if strict else 1).alias("_side"), F.lit(None).cast(r.schema["_r"].dataType).alias("_r"), *own)
    both = r.withColumn("_left", F.lit(False)).unionByName(lf.withColumn("_left", F.lit(True))).withColumn("_day", F.to_date("_t"))
    # at equal times the row that may see the other comes last
    within = Window.partitionBy(on, "_day").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_in", F.last("_r", ignorenulls=True).over(within)).where("_left")
    days = both.groupBy(on, "_day").agg(F.max_by("_r", F.when(F.col("_r").isNotNull(), F.struct("_t"))).alias("_last"))
    carried = F.last("_last", ignorenulls=True).over(Window.partitionBy(on).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1))
    before = days.select(F.col(on).alias("_on"), F.col("_day").alias("_d"), carried.alias("_before"))
    seen = seen.join(before, F.col(on).eqNullSafe(F.col("_on")) & F.col("_day").eqNullSafe(F.col("_d")), "left").withColumn("_seen", F.coalesce("_in", "_before"))
    if max_age_min is not None:
        young = minutes_between(F.col("_t"), F.col("_seen.t")) <= max_age_min
        seen = seen.withColumn("_seen", F.when(young, F.col("_seen")))
    back = [F.col(on) if c == on else F.col(f"_l_{c}").alias(c) for c in left.columns]
    return seen.select(*back, F.col("_seen.t").alias("asof_time"), *[F.col(f"_seen.{v}").alias(n) for v, n in zip(values, names, strict=True)])


def known_before(df: DataFrame, key: str, at: str, day: str, **known: tuple[Column, str]) -> DataFrame:
    """df with one column more for each name: its value in the nearest row that has one.

    known: name = (value, side), the side being "before" (earlier rows only), "upto" (the row itself too) or "from" (the row
    itself and later ones). Windows run over an entity's day; what lies outside the day comes from one row an entity and day,
    carried on over the days. So an entity's history is spread over its days, and each window is passed once.
    """
    forward, backward = Window.partitionBy(key, day).orderBy(at), Window.partitionBy(key, day).orderBy(F.desc(at))
    values = df.select("*", *[v.alias(f"_v_{n}") for n, (v, _) in known.items()])
    inside, edges, over_days = [], [], []
    by_day = {True: Window.partitionBy(key).orderBy("_d"), False: Window.partitionBy(key).orderBy(F.desc("_d"))}
    for n, (_, side) in known.items():
        ahead = side != "from"
        w = (forward if ahead else backward).rowsBetween(Window.unboundedPreceding, -1 if side == "before" else 0)
        inside.append(F.last(f"_v_{n}", ignorenulls=True).over(w).alias(f"_i_{n}"))
        there = F.when(F.col(f"_v_{n}").isNotNull(), F.col(at))
        edges.append((F.max_by if ahead else F.min_by)(f"_v_{n}", there).alias(f"_e_{n}"))
        over_days.append(F.last(f"_e_{n}", ignorenulls=True).over(by_day[ahead].rowsBetween(Window.unboundedPreceding, -1)).alias(f"_o_{n}"))
    days = values.groupBy(F.col(key).alias(key), F.col(day).alias("_d")).agg(*edges)
    outside = days.select(F.col(key).alias("_k"), "_d", *over_days)
    j = values.select("*", *inside).join(outside, F.col(key).eqNullSafe(F.col("_k")) & F.col(day).eqNullSafe(F.col("_d")), "left")
    return j.select(*df.columns, *[F.coalesce(f"_i_{n}", f"_o_{n}").alias(n) for n in known])


def carry_capped(slots: DataFrame, cap: int = 4) -> DataFrame:
    """slots: id, slot, point (observed here), stored, stored_strong, has_stored, prior (last point before the window).

    action: existing (a strong row is stored), direct, carry, or skip; value. A carry repeats the anchor, the last strong
    stored value or point, at most cap eligible slots long; weak stored rows with a value use up the cap too, stored rows
    without a value change nothing. Slots since the
    last anchor are counted within the day; a day that starts with none gets the count of the days before.
    """
    strong = F.coalesce("stored_strong", F.lit(False))
    reset = (strong & F.col("stored").isNotNull()) | F.col("point").isNotNull()
    eligible = ~reset & (~F.col("has_stored") | F.col("stored").isNotNull())
    anchor = F.when(strong, F.col("stored")).otherwise(F.col("point"))
    s = slots.withColumn("_day", F.to_date("slot")).withColumn("_reset", reset.cast("int"))
    run = Window.partitionBy("id", "_day").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("_group", F.sum("_reset").over(run))
    s = s.withColumn("_n", F.sum(eligible.cast("int")).over(Window.partitionBy("id", "_day", "_group").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)))
    days = s.groupBy("id", F.col("_day").alias("_d")).agg(F.max_by("_n", "slot").alias("_tail"), F.max("_reset").alias("_any"))
    by_day = Window.partitionBy("id").orderBy("_d")
    days = days.withColumn("_g", F.sum("_any").over(by_day.rowsBetween(Window.unboundedPreceding, 0)))
    so_far = F.sum("_tail").over(Window.partitionBy("id", "_g").orderBy("_d").rowsBetween(Window.unboundedPreceding, 0))
    days = days.withColumn("_so_far", so_far).select(F.col("id").alias("_k"), "_d", F.lag("_so_far").over(by_day).alias("_carried"))
    s = known_before(s, "id", "slot", "_day", _anchor=(anchor, "upto"))
    s = s.join(days, (F.col("id") == F.col("_k")) & (F.col("_day") == F.col("_d")), "left")
    n = F.col("_n") + F.when(F.col("_group") == 0, F.coalesce("_carried", F.lit(0))).otherwise(0)
    held = F.coalesce("_anchor", "prior")
    action = (
        F.when(strong, "existing").when(F.col("point").isNotNull(), "direct").when(F.col("has_stored"), "existing")
        .when(held.isNotNull() & (n <= cap), "carry").otherwise("skip")
    )
    value = F.when(F.col("action") == "existing", F.col("stored")).when(F.col("action") == "direct", F.col("point")).when(F.col("action") == "carry", held)
    return s.withColumn("action", action).withColumn("value", value).select(*slots.columns, "action", "value")


def interpolate(df: DataFrame, key: str = "id", at: str = "slot", value: str = "value", edges: bool = False, max_gap_min: int | None = None, wide: str = "null", out: str = "filled") -> DataFrame:
    """Linear in time between known values.

    edges: outside, the nearest known value (else null). max_gap_min: wider gaps give null, or the left value (wide="left").
    """
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(at).alias("t"), F.col(value).alias("v")))
    d = known_before(df.withColumn("_day", F.to_date(at)), key, at, "_day", _left=(known, "upto"), _right=(known, "from")).drop("_day")
    lv, rv = F.col("_left.v"), F.col("_right.v")
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    span, past = us(F.col("_right.t")) - us(F.col("_left.t")), us(F.col(at)) - us(F.col("_left.t"))
    inner = lv + (rv - lv) * (past / F.nullif(span, F.lit(0)))
    if max_gap_min is not None:
        inner = F.when(span <= max_gap_min * 60_000_000, inner).otherwise(lv if wide == "left" else F.lit(None))
    both = F.when(lv.isNotNull() & rv.isNotNull(), inner)
    filled = F.coalesce(F.col(value), both, *([lv, rv] if edges else []))
    if not edges and wide != "left":
        filled = F.coalesce(F.col(value), both)
    return d.withColumn(out, filled).withColumn("left_value", lv).drop("_left", "_right")


def _close_before(candles: DataFrame, order: str) -> DataFrame:
    """candles with _prev: a struct of the close of the candle before, which may be null there; null for the first candle."""
    return known_before(candles.withColumn("_day", F.to_date(order)), "id", order, "_day", _prev=(F.struct("close"), "before")).drop("_day")


def previous_close_open(candles: DataFrame, order: str = "bucket") -> DataFrame:
    """open: the previous candle's close, where there is one; extremes widened to hold it."""
    c = _close_before(candles, order).withColumn("open", F.coalesce("_prev.close", "open")).drop("_prev")
    return c.withColumn("high", F.greatest("high", "open", "close")).withColumn("low", F.least("low", "open", "close"))


def chained_open(repaired: DataFrame, seed: DataFrame, order: str = "bucket") -> DataFrame:
    """Over repaired rows only: open is the previous repaired close, the first one's the stored close before it (seed)."""
    j = _close_before(repaired, order).join(seed.select("id", F.col("close").alias("_seed")), "id", "left")
    o = F.coalesce("_prev.close", "_seed", "close")
    return j.withColumn("open", o).withColumn("high", F.greatest("open", "close")).withColumn("low", F.least("open", "close")).drop("_seed", "_prev")


def donor_cascade(slots: DataFrame) -> DataFrame:
    """slots: id, slot, own, own_source, has_own, hour, hour_source, day, day_source, prev_hour, prev_day.

    Fills missing slots from the own hour, the own day, the slot before (filled ones too, without limit), the hour or day
    before the window. A stored row without a close is not filled from the slot before.
    """
    x = F.coalesce("own", F.when(~F.col("has_own"), F.coalesce("hour", "day")))
    s = slots.withColumn("_x", x).withColumn("_day", F.to_date("slot"))
    s = known_before(s, "id", "slot", "_day", _carry=(F.col("_x"), "before")).drop("_day")
    missing = ~F.col("has_own")
    close = F.coalesce("_x", F.when(missing, F.coalesce("_carry", "prev_hour", "prev_day")))
    label = (
        F.when(F.col("has_own"), F.col("own_source"))
        .when(F.col("hour").isNotNull(), lineage("bf_10m_from_hourly", F.col("hour_source")))
        .when(F.col("day").isNotNull(), lineage("bf_10m_from_daily", F.col("day_source")))
        .when(F.col("_carry").isNotNull(), "bf_10m_carry_10m").when(F.col("prev_hour").isNotNull(), "bf_10m_carry_hourly").when(F.col("prev_day").isNotNull(), "bf_10m_carry_daily")
    )
    return s.withColumn("close", close).withColumn("candle_source", label).drop("_x", "_carry")


def rollup_cascade(targets: DataFrame, finer: DataFrame, coarser: DataFrame | None, unit: str, carry: bool = True) -> DataFrame:
    """Missing candles of one resolution (targets: id, at, has, own_close, own_source) from a finer one, else a coarser one,
    else the candle before (stored or just filled, unless carry is off).

    finer: id, at, open, high, low, close, points, sources (the set of its labels' leaves) and via, the candles it was made of,
    if not of 10m; coarser: id, at, close, source.
    unit names the candle: hourly (from 10m, from daily) or daily (from 10m, from hourly).
    """
    finer = finer if "via" in finer.columns else finer.withColumn("via", F.lit("10m"))
    j = targets.join(finer.withColumn("_f", F.lit(True)), ["id", "at"], "left")
    if coarser is not None:
        j = j.join(coarser.select("id", "at", F.col("close").alias("_cc"), F.col("source").alias("_cs")), ["id", "at"], "left")
    else:
        j = j.withColumn("_cc", F.lit(None).cast("double")).withColumn("_cs", F.lit(None).cast("string"))
    fine = ~F.col("has") & F.coalesce("_f", F.lit(False))
    coarse = ~F.col("has") & ~fine & F.col("_cc").isNotNull()
    made = F.when(F.col("has"), F.col("own_close")).when(fine, F.col("close")).when(coarse, F.col("_cc"))
    # the candle before is the last one that is there, even if it has no close
    there = F.when(F.col("has") | fine | coarse, F.struct(made.alias("close")))
    span = F.to_date("at") if unit == "hourly" else F.trunc("at", "year")  # daily candles are cut by year
    j = known_before(j.withColumn("_span", span), "id", "at", "_span", _there=(there, "before")).withColumn("_before", F.col("_there.close"))
    carried = ~F.col("has") & ~fine & ~coarse & F.col("_before").isNotNull() & F.lit(carry)
    one = F.when(carried, F.col("_before")).otherwise(made)
    leaf = F.when(F.size("sources") == 1, F.get("sources", F.lit(0))).otherwise("mixed")
    label = (
        F.when(F.col("has"), F.col("own_source")).when(fine, F.when(F.col("via") == "10m", lineage(f"bf_{unit}_from_10m", leaf)).otherwise(lineage(f"bf_{unit}_from_hourly", leaf))).when(coarse, lineage(f"bf_{unit}_from_daily", F.col("_cs")))
        .when(carried, f"bf_{unit}_carry_{unit}")
    )
    pick = lambda c: F.when(fine, F.col(c)).otherwise(one)
    points = F.when(fine, F.col("points")).when(coarse | carried, F.lit(1).cast("long"))
    out = j.select("id", "at", pick("open").alias("open"), pick("high").alias("high"), pick("low").alias("low"), one.alias("close"), label.alias("candle_source"), points.alias("point_count"))
    return out.where("candle_source is not null")
