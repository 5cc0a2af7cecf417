"""Merging candidate rows with stored ones: upsert, insert if absent, fill, protect, skip unchanged."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import same
from tidemark.operators.provenance import precedence


def upsert(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new replace stored rows of the same key."""
    return new.select(*stored.columns).unionByName(stored.join(new.select(*keys), keys, "left_anti"))


def insert_if_absent(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new with applied: whether its key was free."""
    held = stored.select(*keys).distinct().withColumn("_held", F.lit(True))
    return new.join(held, keys, "left").withColumn("applied", F.col("_held").isNull()).drop("_held")


def with_stored(new: DataFrame, stored: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return new.join(stored.select(*keys, *[F.col(c).alias(f"old_{c}") for c in columns], F.lit(True).alias("_has")), keys, "left").withColumn("has_old", F.coalesce("_has", F.lit(False))).drop("_has")


def fill_missing(joined: DataFrame, columns: list[str], zero: tuple[str, ...] = ("market_cap", "volume_24h")) -> DataFrame:
    """Nulls from the stored row; what is then still null in zero columns becomes 0."""
    for c in columns:
        joined = joined.withColumn(c, F.coalesce(c, f"old_{c}", *([F.lit(0.0)] if c in zero else [])))
    return joined


def unchanged(columns: list[str], exact: tuple[str, ...] = ()) -> Column:
    """All columns equal to their stored values within tolerance, those in exact to the letter."""
    equal = [F.col(c).eqNullSafe(F.col(f"old_{c}")) if c in exact else same(F.col(c), F.col(f"old_{c}")) for c in columns]
    return F.col("has_old") & reduce(lambda a, b: a & b, equal)


def keep_stored(joined: DataFrame, columns: list[str]) -> DataFrame:
    """The stored row's values where it has them: prices are replaced, metrics stay."""
    for c in columns:
        joined = joined.withColumn(c, F.coalesce(f"old_{c}", c))
    return joined


def heal(stored: DataFrame, points: DataFrame, keys: list[str], source: str = "repair_api_points") -> DataFrame:
    """points (candles made from API points) over stored rows that may be overwritten, as rows with healed: whether written."""
    j = with_stored(points.withColumn("candle_source", F.lit(source)), stored, keys, ["candle_source", "point_count"])
    allowed = ~F.col("has_old") | may_overwrite(F.col("candle_source"), F.col("point_count"), F.col("old_candle_source"), F.col("old_point_count"))
    return j.withColumn("healed", allowed)


def fold_quote(stored: DataFrame, quotes: DataFrame, keys: list[str], final: str = r"^cg_.*_final$") -> DataFrame:
    """Live quotes (keys, price, at) folded into stored partial candles: open is the old open, close or the quote; extremes
    take all in; close is the quote; points are at least one. A final row of the API stays as it is."""
    q = quotes.select(*keys, F.col("price").alias("_p"), F.col("at").alias("_at"))
    j = stored.join(q, keys, "left")
    closed = F.rlike(F.lower(F.coalesce("candle_source", F.lit(""))), F.lit(final))
    use = F.col("_p").isNotNull() & ~closed
    o, h, lo, c, p = (F.col(x) for x in ("open", "high", "low", "close", "_p"))
    return j.withColumns({
        "open": F.when(use, F.coalesce(o, c, p)).otherwise(o), "high": F.when(use, F.greatest(h, lo, c, o, p)).otherwise(h), "low": F.when(use, F.least(h, lo, c, o, p)).otherwise(lo),
        "close": F.when(use, p).otherwise(c), "point_count": F.when(use, F.greatest(F.lit(1), F.coalesce("point_count", F.lit(0)))).otherwise(F.col("point_count")).cast("long"),
        "last_updated": F.when(use, F.greatest("last_updated", "_at")).otherwise(F.col("last_updated")),
    }).drop("_p", "_at")


def may_overwrite(source: Column, points: Column, old_source: Column, old_points: Column) -> Column:
    return precedence(source, points) >= precedence(old_source, old_points)


def weak_share(weak: Column, present: Column, expected: Column) -> Column:
    """Weak and missing slots as a share of those expected."""
    return (weak + F.greatest(expected - present, F.lit(0))) / F.greatest(expected, F.lit(1))


def protects(old_authoritative: Column, share: Column, allowed: float = 0.0) -> Column:
    """An authoritative stored row stays while the candidate rests on weak or missing slots."""
    return F.coalesce(old_authoritative, F.lit(False)) & (share > allowed)


def canonical(source: Column, api: Column, old_enough: Column, label: str = "api_daily_final") -> Column:
    """One label for all API rows; old rows that aren't are tagged; newer ones keep theirs."""
    return F.when(api, label).when(old_enough, "legacy_non_api").otherwise(source)


def relabel(source: Column, api: Column, old_enough: Column) -> Column:
    """Two buckets for old labels: API and not; newer rows keep theirs."""
    return F.when(~old_enough, source).when(api, "legacy_api").otherwise("legacy_non_api")
