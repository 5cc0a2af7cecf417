"""Predicates on a candle's provenance. Each is its own: they differ in blanks, counts and labels, and stay separate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.timeutil import plus_minutes

#: Source labels.
WEAK_CC = ("hist-carry", "rolling_carry", "repair_unknown", "hourly_interp")
WEAK_FUTURE = ("carry_prev", "repair_carry", "repair_api_interp", "live_partial", "10m_partial")
AUTHORITATIVE_HOURLY = ("hourly_api", "manual_api", "manual_api_hourly")
AUTHORITATIVE_DAILY = ("api_daily_final", "daily_api")
FINAL_HOURLY = ("cg_hourly_final", "manual_api_hourly", "hourly_api")
FINAL_DAILY = ("cg_daily_final", "api_daily_final", "daily_api")


def _label(source: Column) -> Column:
    return F.lower(F.trim(F.coalesce(source, F.lit(""))))


def _has(label: Column, *tokens: str) -> Column:
    return F.rlike(label, F.lit("|".join(tokens)))


def weak_for_append(source: Column) -> Column:
    """A stored ten-minute row that a real observation may replace."""
    s = _label(source)
    return (s == "") | s.startswith("bf_") | s.isin(*WEAK_CC)


def weak_for_hour(source: Column, points: Column) -> Column:
    s = _label(source)
    n = points.try_cast("int")
    return F.coalesce(n <= 0, F.lit(True)) | (s == "") | s.startswith("bf_") | _has(s, "carry", "interp") | s.isin("repair_unknown", "unknown")


def weak_for_day(source: Column, points: Column, last_updated: Column, ts: Column) -> Column:
    """A blank source counts as strong here."""
    stale = F.coalesce(last_updated < plus_minutes(ts, -20), F.lit(False))
    return _has(_label(source), "carry", "from_daily", "from_hourly", "interp") | F.coalesce(points <= 0, F.lit(False)) | stale


def weak_future(source: Column) -> Column:
    s = _label(source)
    return (s == "") | s.isin(*WEAK_FUTURE) | _has(s, "carry", "interp", "partial")


def derived(source: Column) -> Column:
    return _label(source).startswith("bf_")


def authoritative(source: Column, labels: tuple[str, ...], points: Column | None = None) -> Column:
    hit = _label(source).isin(*labels)
    return hit if points is None else hit & F.coalesce(points >= 2, F.lit(False))


def api_label(source: Column) -> Column:
    s = _label(source)
    return s.isin(*FINAL_DAILY) | s.startswith("cg_pro") | s.startswith("cg_daily") | F.contains(s, F.lit("repair_api"))


def precedence(source: Column, points: Column) -> Column:
    """Score of a ten-minute candle; a new one overwrites if its score is not lower."""
    s, n = _label(source), F.coalesce(points, F.lit(0))
    return (
        F.when(s == "repair_api_points", 400 + n).when(n > 0, 300 + n).when(_has(s, "interp"), F.lit(220)).when(_has(s, "carry"), F.lit(120)).otherwise(F.lit(0)).cast("int")
    )


def lineage(prefix: str, source: Column) -> Column:
    """prefix:leaf, lower case, blanks to underscores, at most 96 characters; leaf: what follows the last colon."""
    leaf = F.element_at(F.split(F.coalesce(source, F.lit("unknown")), ":"), -1)
    return F.left(F.lower(F.regexp_replace(F.concat(F.lit(prefix + ":"), leaf), r"\s+", "_")), F.lit(96))
