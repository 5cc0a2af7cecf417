"""Exact top-k search by inner product with dual cover trees.

Vectors are cut into blocks of bounded size, alike vectors together; each block has a cover tree, built once and kept with
it. Queries and data are both indexed. Two nodes are searched together: the largest inner product they can hold is bounded
by their points and covering radii, and the pair is pruned if that is below the worst kth score of the query node's queries.
The same bound prunes pairs of whole blocks before they are shipped: each query block first searches the data blocks nearest
to it, which gives its worst kth score, and then only the blocks that can still beat it.

Nulls and ties: null vectors and vectors with a null or non-finite component take no part; vectors meet only vectors of
their own length. Equal scores go to the smaller vec_id, a null one last. Rows with equal ids are rows of their own; a query
leaves out only itself. Scores are exact; one that does not fit a long ends the query with an error. Empty tables, and
queries alone in their table, give no row. Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise, shuffle_width

#: Rows of a data block and of a query block, leaf sizes of their trees, most pivots that cut the table into blocks, data
#: blocks that a query block searches first; SMALL: so few scores are formed at once rather than bounded further; WORTH: the
#: share of a pair's scores that may be left for it to be opened.
DATA_BLOCK, QUERY_BLOCK, LEAF, QUERY_LEAF, PIVOTS, NEAREST, SMALL, WORTH = 2048, 1024, 32, 1, 4096, 2, 1 << 13, 0.8
BLOCK_SCHEMA = "block long, dims int, n int, data binary, center array<double>, radius double"


class CoverTree:
    """A cover tree over the rows of x (float64), cut off at leaves of few rows.

    Level by level, rows farther than 2^l from every centre become centres, until there is none. So the centres of level l lie
    more than 2^l apart (separation), every row but those of the leaves above is within 2^l of one of them (covering), and they are also centres of level l - 1 (nesting). A node is a centre at a level; its children are itself one level down and the new centres nearest to it.

    Nodes as arrays: point (a row), level, radius (measured, to the farthest row below), start and stop in order, children.
    """

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x = x
        centres, level, parents, owner, levels = _nets(x, leaf)
        below: list[list[int]] = [[] for _ in centres]  # centre -> centres whose parent it is, the coarsest first
        for c in range(1, len(centres)):
            below[parents[c]].append(c)
        rows: list[list[int]] = [[] for _ in centres]
        for r, c in enumerate(owner):
            rows[c].append(r)
        point, node_level, start, stop, children, order = [], [], [], [], [], []

        def open_node(c: int, at: int) -> int:
            point.append(centres[c])
            node_level.append(at)
            start.append(len(order))
            stop.append(0)
            children.append([])
            return len(point) - 1

        # (centre, level, how many of its children are of higher levels, parent node, its number once it is open)
        todo = [(0, levels, 0, -1, -1)] if len(x) else []
        while todo:
            c, at, seen, parent, node = todo.pop()
            if node >= 0:
                stop[node] = len(order)
                continue
            node = open_node(c, at)
            if parent >= 0:
                children[parent].append(node)
            todo.append((c, at, seen, parent, node))
            rest = below[c][seen:]
            if not rest:
                order.extend(rows[c])
                continue
            next_level = level[rest[0]]  # levels that only repeat the centre are passed over
            new = [k for k in rest if level[k] == next_level]
            todo.append((c, next_level, seen + len(new), node, -1))
            todo.extend((k, next_level, 0, node, -1) for k in new)
        self.order = np.array(order, np.int64)
        self.point, self.level = np.array(point, np.int64), np.array(node_level)
        self.start, self.stop = np.array(start, np.int64), np.array(stop, np.int64)
        self.children = [np.array(k, np.int64) for k in children]
        self.radii = np.array([_distances(x[order[a:b]], x[p]).max() for p, a, b in zip(point, start, stop, strict=True)])
        self._derive()

    def _derive(self) -> None:
        self.centers = self.x[self.point] if len(self.x) else self.x
        self.norms = np.linalg.norm(self.centers, axis=-1) if len(self.x) else np.zeros(0)

    def __getstate__(self) -> dict:
        """As it is stored: whole numbers in as few bytes as they need."""
        state = {k: v for k, v in self.__dict__.items() if k not in ("centers", "norms")}
        most = np.abs(self.x).max(initial=0)
        state["x"] = self.x.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.int64)
        return state

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.x = self.x.astype(np.float64)
        self._derive()


def _nets(x: np.ndarray, leaf: int) -> tuple[list[int], list[int], list[int], np.ndarray, int]:
    """(centres; the level each is new at; its parent among the centres; each row's centre; top level).

    Goes on among the rows of centres that have more than leaf, until there is none or its rows are all equal to it.
    """
    if not len(x):
        return [], [], [], np.zeros(0, np.int64), 0
    root = int(_distances(x, x.mean(axis=0)).argmin())
    near, owner = _distances(x, x[root]), np.zeros(len(x), np.int64)
    top = int(np.ceil(np.log2(near.max()))) if near.max() > 0 else 0
    centres, level, parents, open_rows = [root], [top], [-1], np.full(len(x), len(x) > leaf)
    while True:
        far = float(near[open_rows].max(initial=0))
        if far <= 0:
            return centres, level, parents, owner, top
        now = int(np.ceil(np.log2(far))) - 1  # levels without a new centre are passed over
        above = owner.copy()  # the net of the level above is whole: a new centre's parent is the nearest in it
        while len(uncovered := np.flatnonzero(open_rows & (near > 2.0**now))):
            pick = int(uncovered[0])
            centres.append(pick)
            level.append(now)
            parents.append(int(above[pick]))
            d = _distances(x, x[pick])
            closer = open_rows & (d < near)
            owner[closer], near[closer] = len(centres) - 1, d[closer]
            open_rows &= (np.bincount(owner, minlength=len(centres)) > leaf)[owner]  # the others are a leaf's and stay with it


def _distances(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - point) ** 2).sum(axis=1))


def bounds(qt: CoverTree, i: np.ndarray, dt: CoverTree, j: np.ndarray) -> np.ndarray:
    """Most that an inner product can be between the balls of nodes i and j, with room for rounding; i by j."""
    nq, qr, nd, dr = qt.norms[i][:, None], qt.radii[i][:, None], dt.norms[j][None, :], dt.radii[j][None, :]
    return qt.centers[i] @ dt.centers[j].T + qr * nd + dr * nq + qr * dr + 1e-6 * (1 + (nq + qr) * (nd + dr))


class _Best:
    """The k best (score, place) of each query: the higher score, then the smaller place."""

    def __init__(self, queries: int, k: int, places: int, size: float):
        self.shift = np.int64(max(places - 1, 1).bit_length())
        self.last = np.int64((1 << int(self.shift)) - 1)
        self.low = np.int64(-(2**62))
        self.packs = size * float(1 << int(self.shift)) < 2.0**61  # score and place fit in one number
        self.keys = np.full((queries, k), self.low)
        self.rows: list[list[tuple[int, int]]] = [[] for _ in range(0 if self.packs else queries)]
        self.k = k

    def add(self, qi: np.ndarray, dj: np.ndarray, scores: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Takes in scores (qi by dj); own marks a query's own row. Returns each query's kth score, or -inf."""
        if not self.packs:
            for n, q in enumerate(qi):
                new = [(int(s), int(p)) for s, p, o in zip(scores[n], dj, own[n], strict=True) if not o]
                self.rows[q] = sorted(self.rows[q] + new, key=lambda x: (-x[0], x[1]))[: self.k]
            return np.array([self.rows[q][-1][0] if len(self.rows[q]) == self.k else -np.inf for q in qi], np.float64)
        keys = (scores.astype(np.int64) << self.shift) | (self.last - dj)[None, :]
        keys[own] = self.low
        both = np.concatenate([self.keys[qi], keys], axis=1)
        self.keys[qi] = both[np.arange(len(qi))[:, None], np.argpartition(both, both.shape[1] - self.k, axis=1)[:, -self.k :]]
        kth = self.keys[qi].min(axis=1)
        return np.where(kth > self.low, kth >> self.shift, -np.inf)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.packs:
            flat = [(q, p, s) for q, own in enumerate(self.rows) for s, p in own]
            if any(abs(s) >= 2**63 for _, _, s in flat):
                raise ValueError("a score does not fit a long: scale the vectors down")
            return tuple(np.array([x[n] for x in flat], np.int64) for n in range(3))
        q, col = np.nonzero(self.keys > self.low)
        keys = self.keys[q, col]
        return q, self.last - (keys & self.last), keys >> self.shift


def search_trees(qt: CoverTree, q_rows: np.ndarray, dt: CoverTree, d_rows: np.ndarray, k: int, floor: float, formed: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best data rows of each query: (query place, data place, score). Data places are in order of id; q_rows, d_rows
    name rows. Nothing below floor matters.

    Every query leaf first gets a floor from the data leaf that promises it most. Then both trees are opened together: a query
    node keeps the data nodes whose bound reaches the worst kth score of its queries. A node is scored against its data nodes by
    one matrix product where opening them further would spare less than a fifth of these scores, by the bounds between leaves.
    formed, if given, takes the number of scores of each product.
    """
    if not len(q_rows) or not len(d_rows):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    q, d = qt.x, dt.x
    size = float(np.linalg.norm(q, axis=1).max() * np.linalg.norm(d, axis=1).max())
    # float64 products are exact below 2**52; where a score may not fit a long, Python's integers are exact
    kind = np.int64 if size < 2.0**62 else object
    whole = (q.astype(np.int64).astype(kind), d.astype(np.int64).astype(kind)) if size >= 2.0**52 else None
    best = _Best(len(q), k, len(d), size)
    worst = np.full(len(q), floor)

    q_width, d_width = qt.stop - qt.start, dt.stop - dt.start

    def scores_of(i: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The node's queries, the data rows below nodes, their scores, and which of these are a query with itself."""
        qi = qt.order[qt.start[i] : qt.stop[i]]
        dj = np.concatenate([dt.order[dt.start[j] : dt.stop[j]] for j in nodes])
        scores = np.rint(q[qi] @ d[dj].T) if whole is None else whole[0][qi] @ whole[1][dj].T
        return qi, dj, scores, q_rows[qi][:, None] == d_rows[dj][None, :]

    def raise_floor(i: int) -> None:
        """Scores of the data node that promises most, the smallest that has more than k rows."""
        j = 0
        while len(dt.children[j]):
            best_kid = int(dt.children[j][bounds(qt, np.array([i]), dt, dt.children[j])[0].argmax()])
            if d_width[best_kid] <= k:
                break
            j = best_kid
        qi, dj, scores, own = scores_of(i, np.array([j]))
        if len(dj) > k:
            kth = np.partition(np.where(own, -np.inf, scores), -k, axis=1)[:, -k]
            worst[qi] = np.maximum(worst[qi], kth)

    def needed(i: int) -> float:
        return worst[qt.order[qt.start[i] : qt.stop[i]]].min()

    def score(i: int, nodes: np.ndarray) -> None:
        qi, dj, scores, own = scores_of(i, nodes)
        if formed is not None:
            formed.append(scores.size)
        worst[qi] = np.maximum(worst[qi], best.add(qi, dj, scores, own))

    top = np.zeros(1, np.int64)
    q_leaves, d_leaves = (np.array([n for n, kids in enumerate(t.children) if not len(kids)]) for t in (qt, dt))
    for i in q_leaves if size < 2.0**52 else ():  # beyond, a floor could be rounded up
        raise_floor(i)
    keep = bounds(qt, q_leaves, dt, d_leaves) >= np.array([needed(i) for i in q_leaves])[:, None]
    # the scores that would be left below each query node if all its leaves met the data leaves one by one
    promised = np.zeros(len(q) + 1)
    promised[qt.start[q_leaves]] = q_width[q_leaves] * (keep @ d_width[d_leaves])
    promised = np.concatenate([[0], np.cumsum(promised)])
    promised = promised[qt.stop] - promised[qt.start]
    todo = [(0, top)]
    while todo:
        i, nodes = todo.pop()
        nodes = nodes[bounds(qt, np.array([i]), dt, nodes)[0] >= needed(i)]
        if not len(nodes):
            continue
        if promised[i] > WORTH * q_width[i] * d_width[nodes].sum():
            score(i, nodes)
            continue
        opened = np.concatenate([dt.children[j] if len(dt.children[j]) else [j] for j in nodes]).astype(np.int64)
        kids = qt.children[i] if len(qt.children[i]) else np.array([i])
        keep = bounds(qt, kids, dt, opened) >= np.array([needed(c) for c in kids])[:, None]
        some = opened[keep.any(axis=0)]
        leaves = not len(qt.children[i]) and not any(len(dt.children[j]) for j in some)
        if len(some) and (leaves or q_width[i] * d_width[some].sum() <= SMALL):
            score(i, some)
            continue
        todo += [(int(c), opened[keep[n]]) for n, c in enumerate(kids) if keep[n].any()]
    return best.found()


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False)) & (F.size(vector) > 0)


def quantise(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) as longs; a component that does not fit ends the query."""

    def whole(x: Column) -> Column:
        y = x.cast("double") * scale
        return F.when(F.abs(y) < 2.0**52, F.floor(y)).otherwise(F.raise_error(F.lit("a component is too large for a score")).cast("long"))

    return F.transform(vector, whole)


def _pack(rows: pd.DataFrame, leaf: int) -> bytes:
    """A block's rows in order of id (null last), and its cover tree."""
    rows = rows.sort_values(["id", "row"], kind="stable", na_position="last")
    tree = CoverTree(np.stack(rows["v"].to_numpy()).astype(np.float64), leaf)
    known = rows["id"].notna().to_numpy()
    return pickle.dumps((tree, rows["row"].to_numpy(np.int64), rows["id"].fillna(0).to_numpy(np.int64), known))


def _blocks(vectors: DataFrame, size: int, leaf: int) -> DataFrame:
    """vectors (row, id, v, pivot, ring, dims) to BLOCK_SCHEMA. A pivot's rows are dealt to as many blocks as they need:
    by their distance from the pivot, then, where that doesn't tell them apart, by hash."""
    spot = ["pivot", "dims"]
    counts = vectors.groupBy(*spot).agg(F.count(F.lit(1)).alias("n"), F.min("ring").alias("low"), F.max("ring").alias("high"))
    # rings of equal width, as many as the pivot needs blocks
    rings = F.ceil(F.col("n") / size)
    across = F.floor((F.col("ring") - F.col("low")) / (F.col("high") - F.col("low")) * rings)
    ring = F.when(F.col("high") > F.col("low"), F.least(across, rings - 1)).otherwise(0)
    placed = vectors.join(F.broadcast(counts), spot).withColumn("zone", ring.cast("int")).drop("n", "low", "high", "ring")  # PIVOTS rows a length at most
    zones = placed.groupBy(*spot, "zone").agg(F.count(F.lit(1)).alias("n"))
    parts = placed.join(zones, [*spot, "zone"]).withColumn("part", F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / (0.8 * size))))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["v"].to_numpy()).astype(np.float64)
        center = x.mean(axis=0)
        out = (int(rows["row"].min()), int(rows["dims"].iloc[0]), len(x), _pack(rows, leaf), center.tolist(), float(_distances(x, center).max()))
        return pd.DataFrame([out], columns=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")])

    return parts.groupBy(*spot, "zone", "part").applyInPandas(pack, BLOCK_SCHEMA)


def _nearest_pivot(vectors: DataFrame, pivots: list[tuple[int, list[int]]]) -> DataFrame:
    """pivot: the place of a near pivot of the same length, -1 if none; ring: the distance from it.

    Pivots are grouped around their first few; a row goes to the nearest of these, then to the nearest in its group.
    """
    known = {}
    for n in {m for m, _ in pivots}:
        p = np.array([v for m, v in pivots if m == n], np.float64)
        heads = p[: int(np.ceil(np.sqrt(len(p))))]
        known[n] = (p, heads, (2 * p @ heads.T - (heads**2).sum(axis=1)).argmax(axis=1))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place, ring = np.full(len(batch), -1, np.int32), np.zeros(len(batch))
            for n, (p, heads, head_of) in known.items():
                at = np.flatnonzero(batch["dims"].to_numpy() == n)
                if not len(at):
                    continue
                x = np.stack(batch["v"].to_numpy()[at]).astype(np.float64)
                head = (2 * x @ heads.T - (heads**2).sum(axis=1)).argmax(axis=1)
                for h in np.unique(head):
                    own, of = np.flatnonzero(head == h), np.flatnonzero(head_of == h)
                    y = x[own]
                    best = of[(2 * y @ p[of].T - (p[of] ** 2).sum(axis=1)).argmax(axis=1)]
                    place[at[own]], ring[at[own]] = best, np.sqrt(((y - p[best]) ** 2).sum(axis=1))
            batch["id"] = batch["id"].astype("Int64")
            yield batch.assign(pivot=place, ring=ring)

    return vectors.mapInPandas(rows, "row long, id long, v array<long>, dims int, pivot int, ring double")


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """pairs of a query block (q_data) and a data block (d_data), with worst: query, query_id, d_row, vec_id, score."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for q_block, q_data, d_data, worst in batch.itertuples(index=False):
                qt, q_rows, q_ids, q_known = pickle.loads(q_data)
                dt, d_rows, d_ids, d_known = pickle.loads(d_data)
                a, b, score = search_trees(qt, q_rows, dt, d_rows, k, -np.inf if worst is None or np.isnan(worst) else worst)
                query_id, vec_id = (pd.Series(x, dtype="Int64").mask(~known) for x, known in ((q_ids[a], q_known[a]), (d_ids[b], d_known[b])))
                yield pd.DataFrame({"q_block": q_block, "query": q_rows[a], "query_id": query_id, "d_row": d_rows[b], "vec_id": vec_id, "score": score})

    # pairs are few and heavy: they are dealt out by number, not by bytes
    dealt = pairs.repartition(4 * shuffle_width(pairs.sparkSession), "q_block", "d_block").select("q_block", "q_data", "d_data", "worst")
    return dealt.mapInPandas(rows, "q_block long, query long, query_id long, d_row long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score of every row for which queries holds, against all other rows."""
    source = vectors.where(usable(F.col(vector_col))).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), quantise(F.col(vector_col), scale).alias("v"),
        F.size(vector_col).alias("dims"), F.coalesce(queries, F.lit(False)).alias("is_query"),
    )
    table = materialise(source, "vectors")
    asked = table.where("is_query").count()
    wanted = max(1, min(PIVOTS, -(-table.count() // DATA_BLOCK)))
    sample = table.orderBy(F.xxhash64("id", "row")).select("dims", "v").limit(wanted).collect()  # PIVOTS rows at most; any would be right
    pivots = [(r["dims"], list(r["v"])) for r in sample]
    columns = ["row", "id", "v", "dims"]
    data = materialise(_blocks(_nearest_pivot(table.select(*columns), pivots), DATA_BLOCK, LEAF), "blocks")
    few = pivots[: max(1, -(-asked // QUERY_BLOCK))]
    query = materialise(_blocks(_nearest_pivot(table.where("is_query").select(*columns), few), QUERY_BLOCK, QUERY_LEAF), "queries")

    def dot(x: str, y: str) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)

    # pairs of blocks, as centres and radii only; the blocks themselves join the pairs that are left
    nodes = query.select(F.col("block").alias("q_block"), "dims", F.col("n").alias("q_n"), F.col("center").alias("qc"), F.col("radius").alias("qr"))
    tops = data.select(F.col("block").alias("d_block"), "dims", F.col("center").alias("dc"), F.col("radius").alias("dr"))
    width = shuffle_width(vectors.sparkSession)  # vectors mostly have one length: query blocks are spread over as many keys
    nodes = nodes.withColumn("salt", F.pmod(F.xxhash64("q_block"), F.lit(width)))
    tops = tops.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(width - 1).cast("long"))))
    met = nodes.join(tops, ["dims", "salt"]).withColumn("qd", dot("qc", "dc")).withColumn("qq", dot("qc", "qc")).withColumn("dd", dot("dc", "dc"))
    near = F.row_number().over(Window.partitionBy("q_block").orderBy(F.col("qq") - 2 * F.col("qd") + F.col("dd"), "d_block"))
    most = F.col("qd") + F.col("qr") * F.sqrt("dd") + F.col("dr") * F.sqrt("qq") + F.col("qr") * F.col("dr")
    met = met.withColumn("most_", most)
    most = F.col("most_")
    met = materialise(met.select("q_block", "d_block", "q_n", near.alias("near"), (most + 1e-6 * F.abs("most_") + 1).alias("most")), "met")
    q_all = query.select(F.col("block").alias("q_block"), F.col("data").alias("q_data"))
    d_all = data.select(F.col("block").alias("d_block"), F.col("data").alias("d_data"))

    home = met.where(F.col("near") <= NEAREST).select("q_block", "d_block", F.lit(None).cast("double").alias("worst"))
    first = materialise(_search(home.join(q_all, "q_block").join(d_all, "d_block"), k), "home")
    # the worst kth score of each query block, if all its queries have k results
    kth = first.groupBy("q_block", "query").agg(F.slice(F.sort_array(F.collect_list("score"), asc=False), 1, k).alias("s")).where(F.size("s") >= k)
    kth = kth.groupBy("q_block").agg(F.min(F.get("s", F.lit(k - 1))).cast("double").alias("worst"), F.count(F.lit(1)).alias("full"))
    rest = met.where(F.col("near") > NEAREST).join(kth, "q_block", "left").withColumn("worst", F.when(F.col("full") == F.col("q_n"), F.col("worst")))
    rest = rest.where(F.col("worst").isNull() | (F.col("most") >= F.col("worst"))).select("q_block", "d_block", "worst")
    found = first.unionByName(_search(rest.join(q_all, "q_block").join(d_all, "d_block"), k))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "d_row"))
    out = materialise(found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "ranked")
    discard(table, data, query, met, first)
    return out
