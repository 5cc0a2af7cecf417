"""Near-duplicate groups by min-max hashing, confirmed on full shingle sets.

A document's set holds its distinct word shingles. Each of PERMUTATIONS hash functions yields two signature values, the
minimum and the maximum over the set, so a signature of 2 * PERMUTATIONS values costs half the hash evaluations; bands of
BAND values are the bucket keys. At a similarity of 0.75 a pair shares no bucket with probability (1 - 0.75^3)^32 = 2e-8.

Equal sets are one node from the start. A bucket is not expanded into pairs: its most central member (the one with the
least share of shingles that no one else has) is compared with the rest, and connected components are taken. Where a bucket
still holds members of different components, pairs across components are formed inside a join that also asks for a fitting
size, for an intersection that can be large enough (shingles that no one shares don't count, nor those in cells of the hash
range where the other has none: copies with edits of their own in different places drop out), and for a sketch distance of at
most SKETCH_BITS (a link misses that bound with probability under 1e-8). Members most of whose shingles no one shares can't
link at all and are left out before. So big groups of copies, and crowds that share a passage, cost rows in proportion to
their members, and no link that could join two components is left out. (Candidates by rarest shingles instead of buckets were
tried: on tables with very frequent passages they grow with the square of a group.)

Nulls and ties: null, empty or wordless texts have an empty set, link with nothing and stay. Texts with fewer words than a
shingle have one shingle, the whole sequence. Rows with equal ids are nodes of their own and end in the same group only if
their texts link. A null id is never the smallest id of a group unless all are null. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise, packed, unpacked
from .components import connected_components

WORDS, PERCENT = 5, 75
PERMUTATIONS, BAND = 48, 3
SKETCH_BITS = 60
_U = np.uint64
SIGNATURE = "row_id long, doc_id long, text_hash long, n_shingles long, set_a long, set_b long, bands array<long>, s0 long, s1 long, s2 long"


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3's constants)."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class WordHashes(dict):
    """word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh64_intdigest(word)
        if len(self) >= 1_000_000:
            self.clear()
        self[word] = h
        return h


_HASHES = WordHashes()


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; A-Z lower-cased, words split at ASCII white space."""
    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return np.zeros(0, _U)
    h = np.fromiter(map(_HASHES.__getitem__, parts), _U, len(parts))
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, _U)
    for k in range(width):
        out = (out ^ h[k : k + len(out)]) * _U(0x9E3779B97F4A7C15) + _U(0x632BE59BD9B4E019)
        out ^= out >> _U(29)
    return np.unique(_mix(out))


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    k = _mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
    return k[:PERMUTATIONS, None] | _U(1), k[PERMUTATIONS:, None]


def min_max_signature(shingles: np.ndarray) -> np.ndarray:
    """2 * PERMUTATIONS values: the minimum under each permutation, then the maximum under each."""
    a, b = _multipliers()
    low, high = np.full(PERMUTATIONS, 2**64 - 1, _U), np.zeros(PERMUTATIONS, _U)
    for k in range(0, len(shingles), 4096):
        y = shingles[None, k : k + 4096] * a + b
        low, high = np.minimum(low, y.min(axis=1)), np.maximum(high, y.max(axis=1))
    return np.concatenate([low, high])


def band_keys(signature: np.ndarray) -> np.ndarray:
    groups = signature.reshape(-1, BAND)
    key = np.arange(len(groups), dtype=_U)
    for k in range(BAND):
        key = _mix(key ^ groups[:, k])
    return key.view(np.int64)


def sketch(signature: np.ndarray) -> np.ndarray:
    """Two bits of each value, as 64-bit words: equal values agree, others by chance."""
    bits = (_mix(signature)[:, None] >> np.array([7, 41], _U)) & _U(1)
    return np.packbits(bits.astype(np.uint8).ravel()).view(np.int64)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    source = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"),
    )

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for batch in batches:
            out = []
            for row_id, doc_id, text_hash, text in batch.itertuples(index=False):
                s = shingle_set(text)
                if not len(s):
                    out.append((row_id, doc_id, text_hash, 0, row_id, -1, None, 0, 0, 0))  # a node of its own
                    continue
                sig = min_max_signature(s)
                digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                out.append((row_id, doc_id, text_hash, len(s), digest[0], digest[1], band_keys(sig), *sketch(sig)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SIGNATURE.split(", ")]).astype({"doc_id": "Int64"})

    return source.mapInPandas(rows, SIGNATURE)


def _distance(x: str, y: str) -> Column:
    return sum((F.bit_count(F.col(f"{x}.s{k}").bitwiseXOR(F.col(f"{y}.s{k}"))) for k in range(3)), F.lit(0))


def _plausible(x: str, y: str) -> Column:
    nx, ny = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    return (100 * F.least(nx, ny) >= PERCENT * F.greatest(nx, ny)) & (_distance(x, y) <= SKETCH_BITS)


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node, shingles (hashes) for the wanted nodes: their texts are read again, so that no set is kept for the others.

    wanted: node, with the id and text hash of one of its rows; rows that share both have one set.
    """
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("text"))
    found = source.join(wanted, source["_id"].eqNullSafe(wanted["doc_id"]) & (source["_hash"] == wanted["text_hash"])).select("node", "text")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 200):
                part = batch.iloc[a : a + 200]
                yield pd.DataFrame({"node": part["node"].to_numpy(), "shingles": [shingle_set(t).view(np.int64) for t in part["text"]]})

    return found.mapInPandas(rows, "node long, shingles array<long>").groupBy("node").agg(F.first("shingles").alias("shingles"))


def _confirm(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (a, b) with linked: whether 100 * |intersection| >= PERCENT * |union| on full sets."""
    x = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    both = x.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.select("a", "b", (100 * common >= PERCENT * (F.size("x") + F.size("y") - common)).alias("linked"))


CELLS = 8  # 64-bit words of a profile


def _profiles(sets: DataFrame) -> DataFrame:
    """node, held: how many of its shingles another node of sets has too; c0 ... c7: which of 512 cells those fall into."""
    each = sets.select("node", F.explode("shingles").alias("s"))
    alone = each.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1").groupBy("node").agg(F.collect_list("s").alias("alone"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for node, shingles, own in batch.itertuples(index=False):
                shared = shingles if own is None else np.setdiff1d(shingles, own, assume_unique=True)
                bits = np.zeros(64 * CELLS, np.uint8)
                bits[(shared >> 20) & (64 * CELLS - 1)] = 1
                out.append((node, len(shared), *np.packbits(bits).view(np.int64)))
            yield pd.DataFrame(out, columns=["node", "held", *[f"c{k}" for k in range(CELLS)]])

    both = sets.join(alone, "node", "left").select("node", "shingles", "alone")
    return both.mapInPandas(rows, "node long, held long, " + ", ".join(f"c{k} long" for k in range(CELLS)))


def _can_link(x: str, y: str) -> Column:
    """An upper bound of the intersection still reaches the similarity.

    Only shingles that each shares with anyone can be in it, and of those none in a cell where the other has none.
    """
    nx, ny = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")

    def most(p: str, q: str) -> Column:
        apart = [F.bit_count(F.col(f"{p}.c{k}").bitwiseAND(F.bitwise_not(F.col(f"{q}.c{k}")))) for k in range(CELLS)]
        return F.col(f"{p}.held") - sum(apart, F.lit(0))

    common = F.least(most(x, y), most(y, x))
    return 100 * common >= PERCENT * (nx + ny - common)


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row of docs: row_id, doc_id, text_hash, n_shingles, group (a number of its component), component_id."""
    sig = materialise(signatures(docs, id_col, text_col), "signatures")
    node = F.struct("row_id", "doc_id", "text_hash")
    nodes = sig.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles").agg(F.min(node).alias("x"), F.min("doc_id").alias("doc"), *[F.first(c).alias(c) for c in ("bands", "s0", "s1", "s2")])
    nodes = materialise(nodes.select("set_a", "set_b", F.col("x.row_id").alias("node"), "x.doc_id", "x.text_hash", "doc", "n_shingles", "bands", "s0", "s1", "s2"), "nodes")

    keys = nodes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = materialise(keys.join(shared, "key"), "buckets")  # key, node, size
    weight = met.groupBy("node").agg(F.sum("size").alias("weight"))
    sets = materialise(_sets(docs, nodes.select("node", "doc_id", "text_hash").join(weight.select("node"), "node"), id_col, text_col), "sets")
    about = nodes.select("node", "n_shingles", "s0", "s1", "s2").join(weight, "node").join(_profiles(sets), "node")
    about = materialise(about, "about")
    # the centre of a bucket has the least share of shingles for itself: copies are nearer to it than to each other
    own = (1 - F.col("held") / F.col("n_shingles")).alias("own")
    central = met.select("key", "node").join(about.select("node", own, (-F.col("weight")).alias("w")), "node")
    central = central.groupBy("key").agg(F.min(F.struct("own", "w", F.xxhash64("node"), "node")).alias("m")).select("key", F.col("m.node").alias("a"))
    star = met.select("key", F.col("node").alias("b")).join(central, "key").where("a <> b").select("a", "b").distinct()
    x, y = about.alias("x"), about.alias("y")
    star = (
        star.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node")).where(_can_link("x", "y") & _plausible("x", "y"))
        .select("a", "b", _distance("x", "y").alias("d"), (1 - F.col("x.held") / F.col("x.n_shingles")).alias("own"))
    )
    best = star.groupBy("b").agg(F.min(F.struct("d", "a")).alias("near"), F.min(F.struct("own", "d", "a")).alias("mid"))
    first = best.select(F.explode(F.array_distinct(F.array("near.a", "mid.a"))).alias("a"), "b")
    checked = materialise(_confirm(sets, first), "pairs")
    comps = connected_components(checked.where("linked"))

    rows = met.select("key", "node").join(comps, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    split = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    # a link needs three quarters of a set; what no one shares can't be in it
    able = about.where(100 * F.col("held") >= PERCENT * F.col("n_shingles")).drop("weight")
    members = materialise(rows.join(split, "key").join(able, "node"), "open")
    done = checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    across = materialise(_across(members).join(done, ["a", "b"], "left_anti"), "across")
    # first the nearest pair between each two components, then whatever is left between those that are still apart
    near = materialise(_confirm(sets, across.groupBy("ca", "cb").agg(F.min(F.struct("d", "a", "b")).alias("m")).select("m.a", "m.b")), "pairs")
    pairs = [checked, near]
    if near.where("linked").limit(1).count():
        comps = connected_components(checked.unionByName(near).where("linked"))
    of = comps.select(F.col("node").alias("n"), F.col("comp").alias("c"))
    far = across.join(near.select("a", "b"), ["a", "b"], "left_anti").select("a", "b")
    far = far.join(of, far["a"] == of["n"], "left").select("a", "b", F.coalesce("c", "a").alias("ca"))
    far = far.join(of, far["b"] == of["n"], "left").select("a", "b", "ca", F.coalesce("c", "b").alias("cb")).where("ca <> cb")
    rest = materialise(_confirm(sets, far.select("a", "b")), "pairs")
    pairs.append(rest)
    if rest.where("linked").limit(1).count():
        comps = connected_components(checked.unionByName(near).unionByName(rest).where("linked"))

    least = nodes.select("node", "doc").join(comps, "node").groupBy("comp").agg(F.min("doc").alias("component_id"))
    of_node = nodes.select("set_a", "set_b", "node", "doc").join(comps.join(least, "comp"), "node", "left")
    of_node = of_node.select("set_a", "set_b", F.coalesce("comp", "node").alias("group"), F.coalesce("component_id", "doc").alias("component_id"))
    out = sig.select("row_id", "doc_id", "text_hash", "n_shingles", "set_a", "set_b").join(of_node, ["set_a", "set_b"], "left")
    group, component = F.coalesce("group", "row_id").alias("group"), F.coalesce("component_id", "doc_id").alias("component_id")
    groups = materialise(out.select("row_id", "doc_id", "text_hash", "n_shingles", group, component), "groups")
    discard(sig, nodes, met, sets, about, members, across, *pairs)
    return groups


def _across(members: DataFrame) -> DataFrame:
    """Pairs (a < b, of components ca and cb, with their sketch distance d) that share a bucket and may link."""
    p, q = members.alias("p"), members.alias("q")
    met = (F.col("p.key") == F.col("q.key")) & (F.col("p.comp") < F.col("q.comp")) & _can_link("p", "q") & _plausible("p", "q")
    pairs = p.join(q, met).select(
        F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b"),
        F.col("p.comp").alias("ca"), F.col("q.comp").alias("cb"), _distance("p", "q").alias("d"),
    )
    return pairs.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: row_id, doc_id, n_shingles, component_id, kept. See the module's text."""
    out = _grouped(docs, id_col, text_col)
    return out.select("row_id", "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each near-duplicate group, that of the smallest (id, text hash), and all rows without words.

    The survivor is chosen for each group, not for each id: rows that share an id (or have none) stay apart unless their
    texts link. A null id gives way to any other. Rows that repeat the survivor's id and text go. All columns pass through.
    """
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    chosen = _grouped(docs, id_col, text_col).groupBy("group").agg(F.min(rank).alias("m"), F.max("n_shingles").alias("n"))
    chosen = chosen.groupBy(F.col("m.doc_id").alias("kept_id"), F.col("m.text_hash").alias("kept_hash")).agg((F.max("n") > 0).alias("words"))
    rows = packed(docs, own_id=F.col(id_col).cast("long"), own_hash=F.xxhash64(text_col))
    rows = rows.join(chosen, F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_hash") == F.col("kept_hash")))
    # rows that share id and text are repeats of each other, but for those without words
    rows = rows.withColumn("apart", F.when(~F.col("words"), F.monotonically_increasing_id()))
    turn = Window.partitionBy("own_id", "own_hash", "apart").orderBy("own_hash")
    return unpacked(rows.withColumn("turn", F.row_number().over(turn)).where("turn = 1"), docs.columns)
