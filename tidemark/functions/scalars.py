"""Scalar columns: sanitised numbers, tolerant equality, text classification, bits, routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Wordings of refused requests.
CALL_CAP = ("calls limit", "call limit", "api call limit", "request limit")
CAP_REACHED = ("you've reached", "you have reached", "limit reached", "exceeded")
PLAN_HINT = ("developer dashboard", "subscribe", "pricing", "plan")
QUOTA = ("monthly", "credit", "quota", "usage cap", "plan limit", "billing", "upgrade plan")
QUOTA_HINT = ("monthly", "credit", "quota", "usage cap")
PER_MINUTE = ("per minute", "minute rate", "too many requests")
CREDIT_LIKE = ("credit", "quota", "allowance", "usage cap", "plan limit")
MONTH_LIKE = ("month", "billing cycle", "resets")
RATE_LIMIT = ("rate limit", "too many requests", "429", "throttl", "per minute", "minute rate")
TRANSIENT = ("timeout", "timed out", "connection reset", "temporarily unavailable", "503", "502")


def number(x: Column, fallback: Column | None = None) -> Column:
    """A double, or the fallback where x isn't one."""
    value = x.try_cast("double")
    return value if fallback is None else F.coalesce(value, fallback)


def rounded(x: Column, digits: int) -> Column:
    """x * 10^digits to the nearest whole number, halves away from zero, then back: what binary rounding in SQL engines gives.

    F.round takes the shortest decimal text instead, so a value stored a hair below a half goes up there and down here.
    """
    return F.round(x * float(10**digits)) / float(10**digits)


def same(a: Column, b: Column, tolerance: float = 1e-12) -> Column:
    """Equal within an absolute tolerance; nulls are equal to nulls only."""
    return F.coalesce(a.eqNullSafe(b) | (F.abs(a - b) <= tolerance), F.lit(False))


def category_or_other(c: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("Other"))


def error_class(text: Column, small_plan: bool = False) -> Column:
    """monthly: credit wording and month wording together, or the small plan's call cap; quota: any other credit wording that
    isn't mere throttling; rate_limit; transient; other. small_plan: every call cap is the month's."""
    low = F.lower(F.coalesce(text, F.lit("")))

    def says(*words: str) -> Column:
        return reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])

    cap = says(*CALL_CAP) & (says(*CAP_REACHED) | says(*PLAN_HINT))
    throttled = says(*PER_MINUTE) & ~(cap | says(*QUOTA_HINT))
    quota = (cap | says(*QUOTA)) & ~throttled
    month_cap = says("calls limit", "call limit") & says("you've reached", "you have reached", "developer dashboard", "pricing")
    monthly = (month_cap | says(*CREDIT_LIKE)) & (says(*MONTH_LIKE) | month_cap & (says("10,000", "10000") | F.lit(small_plan)))
    return F.when(monthly, "monthly").when(quota, "quota").when(says(*RATE_LIMIT), "rate_limit").when(says(*TRANSIENT), "transient").otherwise("other")


def csv_list(text: Column) -> Column:
    """The items of a comma-separated text, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), F.trim), lambda x: x != "")


def masked(key: Column) -> Column:
    """The first and last four characters of a key longer than eight; else only stars."""
    return F.when(F.length(key) <= 8, "***").otherwise(F.concat(F.left(key, F.lit(4)), F.lit("..."), F.right(key, F.lit(4))))


def shortened(text: Column, most: int) -> Column:
    """White space collapsed, at most so many characters."""
    return F.left(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")), F.lit(most))


def with_bits(old: Column, new: Column) -> Column:
    """Two bitmaps of the same layout, hexadecimal, ORed; a missing one has no bits, a shorter one is filled up."""
    width = F.greatest(F.length(F.coalesce(old, F.lit(""))), F.length(F.coalesce(new, F.lit(""))))
    at = lambda c, k: F.conv(F.substring(F.rpad(F.coalesce(c, F.lit("")), width, F.lit("0")), k * 2 + 1, F.lit(2)), 16, 10).cast("int")
    bytes_ = F.transform(F.sequence(F.lit(0), F.greatest((width / 2).cast("int") - 1, F.lit(0))), lambda k: F.lpad(F.hex(at(old, k).bitwiseOR(at(new, k))), 2, "0"))
    return F.when(width == 0, "").otherwise(F.array_join(bytes_, ""))


def route(hint: Column, n: int) -> Column:
    """Key number for a hint: crc32 modulo n."""
    return F.pmod(F.crc32(hint.cast("binary")), F.lit(n)).cast("int")


def bitmap(slot_rows: Column, size_bytes: int) -> Column:
    """Bytes with bit i of byte i // 8 set for every slot of an array of slots."""
    byte = F.transform(
        F.sequence(F.lit(0), F.lit(size_bytes - 1)),
        lambda k: F.aggregate(F.array_distinct(F.filter(slot_rows, lambda s: F.floor(s / 8) == k)), F.lit(0), lambda acc, s: acc + F.pow(F.lit(2), s % 8).cast("int")),
    )
    return F.unhex(F.array_join(F.transform(byte, lambda v: F.lpad(F.hex(v), 2, "0")), ""))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def popcount(bits: Column) -> Column:
    """Bits set in a hexadecimal bitmap."""
    digit = F.transform(F.filter(F.split(bits, ""), lambda c: c != ""), lambda c: F.bit_count(F.conv(c, 16, 10).cast("int")))
    return F.aggregate(digit, F.lit(0).cast("long"), lambda z, n: z + n)


#: Metrics that a preview names first, and the most characters of a dump.
PREFERRED_METRICS = ("coins", "coins_scoped", "wrote", "wrote_10m", "wrote_hourly", "wrote_daily", "wrote_monthly", "wrote_live", "wrote_rolling", "wrote_mcap", "missing_slots", "api_failures", "errors")
MAX_METRICS_JSON = 16_000


def metrics_dump(metrics: Column) -> Column:
    """A map of metrics as compact JSON text with sorted keys, cut where it is too long; none gives {}."""
    ordered = F.map_from_entries(F.array_sort(F.map_entries(metrics)))
    return F.coalesce(F.substring(F.to_json(ordered), 1, MAX_METRICS_JSON), F.lit("{}"))


def metrics_of(text: Column) -> Column:
    """The metrics of a dump, as texts; an empty map where the text is null, blank or no JSON object."""
    return F.coalesce(F.from_json(F.trim(text), "map<string,string>"), F.create_map().cast("map<string,string>"))


def metrics_preview(metrics: Column, most: int = 4) -> Column:
    """key=value of up to four metrics: the preferred ones that are there, in their order; without any, the first by name."""

    def shown(m: Column) -> Column:
        named = F.filter(F.array(*map(F.lit, PREFERRED_METRICS)), lambda k: F.map_contains_key(m, k))
        keys = F.when(F.size(named) > 0, named).otherwise(F.array_sort(F.map_keys(m)))
        pairs = F.transform(F.slice(keys, 1, most), lambda k: F.concat(k, F.lit("="), F.coalesce(F.try_element_at(m, k), F.lit("None"))))
        return F.when(F.size(pairs) > 0, F.array_join(pairs, ", ")).otherwise("-")

    return F.get(F.transform(F.array(metrics), shown), F.lit(0))  # the map is made once
