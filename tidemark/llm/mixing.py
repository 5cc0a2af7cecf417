"""Mixing sources by temperature, realised as budgeted block permutations.

A source's natural weight is its share of all tokens. Raising the shares to one exponent and normalising flattens them; the
exponent is bisected until the weights meet a target entropy or no source is repeated more often than allowed. The weights
are then realised exactly as far as whole documents allow: every source has a token budget, its documents are dealt into
blocks, and each pass over the source permutes the blocks, and the documents in them, by a keyed hash; the last pass stops
where the budget is spent.

The sources are interleaved: a block comes when its source has given out the share of its budget that all others have, too.
Rows are in the mixture's order when sorted by (mix_key, source, epoch, turn, place); every prefix holds the sources by weight.

The budget is the smallest for which the most reduced source still gets one whole pass, so no document is lost; smaller
sources are repeated. A smaller budget may be asked for. Tokens are words unless another count is given.

Nulls and ties: a null source is a source of its own; a null or empty text has one token, so that it has a place; rows with
equal ids are ordered by their text's hash and repeated like others; with one source the weights are natural whatever the
target. An empty table gives no row. Other columns pass through; those named like the added ones are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, packed, shuffle_width, unpacked

#: Documents in a block, about: sources are dealt into as many blocks (a power of two) as they need, FINEST at most.
BLOCK_ROWS, FINEST = 2048, 1 << 18
ENTROPY_SHARE, MAX_REPEATS = 0.97, 2.0
#: So many sources are few enough to be sent to every task; more are joined by salted keys.
FEW_SOURCES = 10_000
#: Runs of blocks whose sizes are summed first, so that no task holds all blocks of a source.
RUNS = 256


def token_count(text: Column) -> Column:
    """Words, at least one."""
    return F.greatest(F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)), F.lit(1)).cast("long")


def tempered(shares: list[float], exponent: float) -> list[float]:
    powers = [s**exponent for s in shares]
    return [p / sum(powers) for p in powers]


def _entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def bisect_exponent(holds: Callable[[list[float]], list[bool]], ways: int = 17, rounds: int = 9) -> float:
    """The largest exponent in [0, 1] at which holds is true; it is true from there down. 0 if it never is.

    Each round halves the interval several times at once: holds looks at ways - 1 exponents in one pass over the sources.
    """
    low, high = 0.0, 1.0
    if holds([1.0])[0]:
        return 1.0
    for _ in range(rounds):
        points = [low + (high - low) * k / ways for k in range(1, ways)]
        good = [p for p, h in zip(points, holds(points), strict=True) if h]
        low, high = max(good, default=low), min((p for p in points if p > max(good, default=low)), default=high)
    return low


def exponent_for(entropies: Callable[[list[float]], list[float]], sources: int, ratio: float, entropy_share: float, max_repeats: float) -> float:
    """The exponent closest to natural (1) whose entropy is entropy_share of the most, unless a source would then be repeated
    more than max_repeats times for each pass over the most reduced one: the repetition limit wins.

    ratio: the largest share through the smallest; a source of share s is passed over s^(a - 1) times, up to a factor.
    """
    if sources < 2:
        return 1.0
    wanted = entropy_share * math.log(sources)
    exponent = bisect_exponent(lambda points: [h >= wanted for h in entropies(points)])
    repeats = lambda a: ratio ** (1 - a)
    if repeats(exponent) <= max_repeats * (1 + 1e-12):
        return exponent
    # flatter than this is too many repeats: 1 - a is the largest step from natural that holds
    return 1 - bisect_exponent(lambda points: [repeats(1 - p) <= max_repeats for p in points])


def fit_exponent(shares: list[float], entropy_share: float = ENTROPY_SHARE, max_repeats: float = MAX_REPEATS) -> float:
    """exponent_for of a list of shares."""
    ratio = max(shares) / min(shares) if shares else 1.0
    return exponent_for(lambda points: [_entropy(tempered(shares, a)) for a in points], len(shares), ratio, entropy_share, max_repeats)


def source_weights(sources: DataFrame, budget: int | None = None, entropy_share: float = ENTROPY_SHARE, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """sources (source, tokens, n) with weight and budget (tokens to give out).

    Sums over the sources are all that the driver sees: their number is not bounded.
    """
    total = sources.agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("k"), F.max("tokens").alias("hi"), F.min("tokens").alias("lo")).first()
    if not total["k"]:
        return sources.withColumns({"weight": F.lit(0.0), "budget": F.lit(0).cast("long")})
    share = F.col("tokens") / F.lit(float(total["t"]))

    def sums(points: list[float]) -> list[tuple[float, float]]:
        powers = [(F.sum(F.pow(share, F.lit(a))), F.sum(F.pow(share, F.lit(a)) * F.log(share))) for a in points]
        row = sources.agg(*[c for pair in powers for c in pair]).first()
        return list(zip(row[::2], row[1::2], strict=True))

    def entropies(points: list[float]) -> list[float]:
        return [math.log(z) - a * y / z for a, (z, y) in zip(points, sums(points), strict=True)]

    exponent = exponent_for(entropies, total["k"], total["hi"] / total["lo"], entropy_share, max_repeats)
    weight = F.pow(share, F.lit(exponent)) / F.lit(sums([exponent])[0][0])
    out = sources.withColumn("weight", weight)
    given = float(budget) if budget is not None else out.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0]
    exact = F.col("weight") * F.lit(given)
    whole = F.abs(exact - F.col("tokens")) <= 1e-9 * F.col("tokens")
    return out.withColumn("budget", F.when(whole, F.col("tokens")).otherwise(F.floor(exact)).cast("long"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 11,
    block_rows: int = BLOCK_ROWS, tokens: Callable[[Column], Column] = token_count, with_order: bool = True, **limits,
) -> DataFrame:
    """docs' columns with, unless the order is left out, epoch (from 0), block, turn (the block's place among its source's in that epoch), place (that of the
    row in its block) and mix_key (0 to 1).

    Sizes are summed once, by source and hash; blocks are joins of hash cells. Prefix sums run over blocks, and inside the one
    block of each source that the budget ends in.
    """
    spark = docs.sparkSession
    keyed = packed(
        docs, source=F.col(source_col).cast("string"), tokens=tokens(F.col(text_col)), id=F.col(id_col).cast("string"),
        hash=F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col)),
    )
    keyed = keyed.withColumn("cell", F.col("hash").bitwiseAND(F.lit(FINEST - 1)))
    cells = materialise(keyed.groupBy("source", "cell").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")), "cells")
    sources = materialise(cells.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.sum("n").alias("n")), "sources")
    needed = F.greatest(F.ceil(F.log2(F.col("n") / block_rows)), F.lit(0))
    blocks = F.least(F.pow(F.lit(2.0), needed), F.lit(float(FINEST))).cast("long")
    weights = materialise(source_weights(sources, **limits).select(F.col("source").alias("of"), F.col("tokens").alias("all"), "budget", blocks.alias("blocks")).where("budget > 0"), "weights")

    def with_source(rows: DataFrame) -> DataFrame:
        """rows with their source's figures; a hot source is spread over salts unless all sources go to every task."""
        if weights.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES:
            return rows.join(F.broadcast(weights), F.col("source").eqNullSafe(F.col("of")))
        width = shuffle_width(spark)
        spread = weights.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
        return rows.withColumn("salted", F.pmod("cell", F.lit(width)).cast("int")).join(spread, F.col("source").eqNullSafe(F.col("of")) & (F.col("salted") == F.col("salt")))

    block = F.col("cell").bitwiseAND(F.col("blocks") - 1)
    sized = with_source(cells).groupBy("source", block.alias("block"), "all", "budget").agg(F.sum("tokens").alias("size"))
    passes = F.ceil(F.col("budget") / F.col("all")).cast("int")
    sized = sized.withColumn("epoch", F.explode(F.sequence(F.lit(0), passes - 1)))
    sized = sized.withColumn("order", F.xxhash64(F.lit(seed), "block", "epoch")).withColumn("run", F.shiftright("order", 56).cast("int"))
    sized = materialise(sized, "turns")
    # a block's turn and start: those of its run (RUNS an epoch), then inside the run
    runs = sized.groupBy("source", "epoch", "run").agg(F.sum("size").alias("run_size"), F.count(F.lit(1)).alias("run_n"))
    before = Window.partitionBy("source").orderBy("epoch", "run").rowsBetween(Window.unboundedPreceding, -1)
    in_epoch = Window.partitionBy("source", "epoch").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("run").alias("r"),
        F.coalesce(F.sum("run_size").over(before), F.lit(0)).alias("run_start"), F.coalesce(F.sum("run_n").over(in_epoch), F.lit(0)).alias("run_turn"),
    )
    inside = Window.partitionBy("source", "epoch", "run").orderBy("order", "block")
    turns = sized.withColumn("in_run", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("nth", F.row_number().over(inside) - 1)
    turns = turns.join(runs, F.col("source").eqNullSafe(F.col("s")) & (F.col("epoch") == F.col("e")) & (F.col("run") == F.col("r")))
    start = F.col("run_start") + F.col("in_run")
    turns = turns.select(
        F.col("source").alias("s"), F.col("block").alias("b"), "epoch", (F.col("run_turn") + F.col("nth")).alias("turn"), start.alias("start"), "size", F.col("budget").alias("most"),
        ((start + F.col("size") / 2) / F.col("budget")).alias("mix_key"),
    ).where(F.col("start") < F.col("most"))
    turns = materialise(turns, "turns")

    rows = with_source(keyed).withColumn("block", block)
    given = rows.join(turns, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).withColumn("place", F.xxhash64(F.lit(seed), "hash", "epoch"))
    cut = F.col("start") + F.col("size") > F.col("most")
    whole, last = given.where(~cut), given.where(cut)
    within = Window.partitionBy("source", "block", "epoch").orderBy("place", "id", "hash").rowsBetween(Window.unboundedPreceding, -1)
    some = last.withColumn("given", F.coalesce(F.sum("tokens").over(within), F.lit(0))).where(F.col("start") + F.col("given") < F.col("most"))
    columns = ["row", "epoch", "block", "turn", "place", "mix_key"]
    out = whole.select(*columns).unionByName(some.select(*columns))
    return unpacked(out, docs.columns, **({c: F.col(c) for c in columns[1:]} if with_order else {}))
