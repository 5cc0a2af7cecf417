"""Time columns: slot flooring, guarded clocks, calendars. The clock is always an argument."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOT_MINUTES, SLOT_DELAY_SEC, SLOTS_PER_DAY = 10, 120, 144


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def floor_slot(ts: Column, minutes: int = SLOT_MINUTES) -> Column:
    """Start of the ts's slot, counted from the epoch in UTC."""
    step = minutes * 60_000_000
    return _from_micros(_micros(ts) - F.pmod(_micros(ts), F.lit(step)))


def ceil_slot(ts: Column, minutes: int = SLOT_MINUTES) -> Column:
    step = minutes * 60_000_000
    return _from_micros(_micros(ts) + F.pmod(-_micros(ts), F.lit(step)))


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def ceil_hour(ts: Column) -> Column:
    down = floor_hour(ts)
    return F.when(down < ts, plus_minutes(down, 60)).otherwise(down)


def whole_slots(start: Column, end: Column, minutes: int = SLOT_MINUTES) -> Column:
    """Starts of the slots that lie wholly in [start, end): the first one due, up to the last one over. Empty if there is none."""
    step = F.expr(f"interval {minutes} minutes")
    first, last = ceil_slot(start, minutes), floor_slot(end, minutes)
    return F.when(first < last, F.sequence(first, last - step, step)).otherwise(F.array().cast("array<timestamp_ntz>"))


def whole_hours(start: Column, end: Column) -> Column:
    """Starts of the hours that lie wholly in [start, end)."""
    step = F.expr("interval 1 hour")
    first, last = ceil_hour(start), floor_hour(end)
    return F.when(first < last, F.sequence(first, last - step, step)).otherwise(F.array().cast("array<timestamp_ntz>"))


def last_days(last: Column, days: int) -> Column:
    """So many days up to and with the last one."""
    return F.sequence(F.date_sub(last, days - 1), last)


def minutes_between(late: Column, early: Column) -> Column:
    return F.floor((_micros(late) - _micros(early)) / 60_000_000).cast("long")


def plus_minutes(ts: Column, minutes: int | Column) -> Column:
    return _from_micros(_micros(ts) + (F.lit(minutes) if isinstance(minutes, int) else minutes).cast("long") * F.lit(60_000_000))


def plus_seconds(ts: Column, seconds: int | Column) -> Column:
    return _from_micros(_micros(ts) + (F.lit(seconds) if isinstance(seconds, int) else seconds).cast("long") * F.lit(1_000_000))


def slot_index(ts: Column) -> Column:
    """0 to 143: the ten-minute slot of the day."""
    return (F.hour(ts) * 6 + F.floor(F.minute(ts) / 10)).cast("int")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def next_month_start(day: Column) -> Column:
    return F.add_months(F.trunc(day, "month"), 1)


def month_bounds(day: Column, grace_days: int = 3) -> tuple[Column, Column, Column]:
    """(first day, last day, whether the month before may still be written: the day is among the month's first ones)."""
    first = F.trunc(day, "month")
    return first, F.last_day(day), F.datediff(day, first) < grace_days


def end_of(text: Column) -> Column:
    """An end given as text: a plain date means the midnight after it."""
    return F.when(F.rlike(text, F.lit(r"^\s*\d{4}-\d{2}-\d{2}\s*$")), (F.date_add(F.try_to_date(F.trim(text)), 1)).cast("timestamp_ntz")).otherwise(parse_time(text))


def lock_bucket(ts: Column, hours: int = 2) -> Column:
    """Name of the ts's lock bucket, e.g. 2024010104 for 2-hour buckets."""
    return F.date_format(F.date_trunc("hour", ts) - F.make_dt_interval(hours=F.pmod(F.hour(ts), F.lit(hours))), "yyyyMMddHH")


def parse_time(text: Column) -> Column:
    """ISO text (with Z or offset), a plain date, or an epoch in seconds or (above 1e10) milliseconds; else null."""
    as_number = text.try_cast("double")
    epoch = F.when(as_number > 1e10, as_number / 1000).otherwise(as_number)
    return F.coalesce(F.timestamp_micros((epoch * 1_000_000).cast("long")), F.try_to_timestamp(text)).cast("timestamp_ntz")


def guarded_now(now: datetime, delay_sec: int = SLOT_DELAY_SEC, minutes: int = SLOT_MINUTES) -> datetime:
    """End of the last slot that is due at now."""
    t = now - timedelta(seconds=delay_sec)
    return t - timedelta(minutes=t.minute % minutes, seconds=t.second, microseconds=t.microsecond)


def slots(spark: SparkSession, start: datetime, end: datetime, minutes: int = SLOT_MINUTES) -> DataFrame:
    """Slot starts in [start, end): one row each, as column slot."""
    text = "select explode(sequence(timestamp_ntz'{}', timestamp_ntz'{}', interval {} minutes)) as slot"
    return spark.sql(text.format(start.isoformat(sep=" "), (end - timedelta(minutes=minutes)).isoformat(sep=" "), minutes))
