"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often a pair of ids does so.

Each document is encoded by a byte-level tokenizer (A, on a space and the text) and a sentencepiece model (B, which adds the
space). Offsets where tokens of both end cut its bytes into groups; every A token of a group is linked to every B token of it.

Inside a task all is Arrow on chunks of documents: id lists are flattened with their parent indices, segmented cumulative sums
give each token's end, a hash join on (document, end) finds the common ends, another on the group the links, and group_by
counts them by (document, pair) and by pair. Spark adds up the pairs' counts over the corpus, and brings each chunk the
counts of its own pairs; a chunk's links are stored meanwhile as numbers into its own list of pairs. Nothing is kept for a
pair and document beyond that, so what is shuffled follows the number of chunks times the distinct pairs of one.

Memory: a chunk ends after CHUNK_BYTES of text, or with one document if that is longer.

Nulls and ties: texts null or empty, and those whose tokens of A or B don't spell the space and the text again, have no tokens
and zeros everywhere. Ids may be null or repeat: each row is a document of its own. An empty table gives none. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import materialise

#: Text after which a chunk is aligned; a chunk's arrays take about sixty times that.
CHUNK_BYTES = 2_000_000
#: Links of a group from which its ids are counted first; bits of an id.
MANY, ID_BITS = 64, 20
_DIGEST = [("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("n_links", "long"), ("groups_sha256", "string")]


class Vocabularies:
    """Both tokenizers, the bytes of their ids, and the ids written in decimal with what may follow."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = tokens.encoder(a_path, plain=True), tokens.piece_encoder(b_path)
        spelt = tokens.byte_level_tokens(self.a), self.b.token_bytes()
        self.bytes = [pa.array(t, pa.binary()) for t in spelt]
        self.sizes = [pa.array([len(x) for x in t], pa.int64()) for t in spelt]
        ids = [str(i) for i in range(max(map(len, spelt)))]
        self.written = {end: pa.array([i + end for i in ids]) for end in (",", "|", ";", "")}

    def lists(self, texts: list[str | None]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of A and B for each text; none for texts that either doesn't spell."""
        wanted = [(" " + t).encode() if t else b"" for t in texts]
        both = [[self.a.encode(" " + t) if t else b"" for t in texts], [self.b.encode(t) for t in texts]]
        good = np.ones(len(texts), bool)
        for side, raw in enumerate(both):
            ids = _list_array(raw)
            spelt = self.bytes[side].take(ids.flatten())
            data = spelt.buffers()[2].to_pybytes() if len(spelt) else b""
            ends = np.frombuffer(spelt.buffers()[1], np.int32)[: len(spelt) + 1]
            at = ends[ids.offsets.to_numpy()]
            good &= np.array([data[i:j] == w for i, j, w in zip(at[:-1].tolist(), at[1:].tolist(), wanted, strict=True)], bool)
        a, b = ([x if g else b"" for x, g in zip(raw, good, strict=True)] for raw in both)
        return _list_array(a), _list_array(b)


def _list_array(raw: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in raw])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(raw), np.int32)))


@lru_cache(2)
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


def _token_table(lists: pa.ListArray, sizes: pa.Array) -> pa.Table:
    """One row per token: its document, its id, its number, and its key: document and the byte offset at which it ends there."""
    flat, doc = lists.flatten(), pc.list_parent_indices(lists)
    end = pc.cumulative_sum(sizes.take(flat))
    before = pa.concat_arrays([pa.array([0], pa.int64()), end]).take(lists.offsets)  # bytes of all documents before each one
    end = pc.subtract(end, before.take(doc))
    key = pc.add(pc.shift_left(doc.cast(pa.int64()), 40), end)
    return pa.table({"doc": doc, "key": key, "id": flat, "at": pa.array(np.arange(len(flat)))})


def align(a_lists: pa.ListArray, b_lists: pa.ListArray, vocab: Vocabularies) -> tuple[pa.Table, pa.Table]:
    """The tokens of A and of B, in order, each with its group; groups are numbered through all the documents."""
    sides = [_token_table(lists, sizes) for lists, sizes in zip((a_lists, b_lists), vocab.sizes, strict=True)]
    ends = sides[0].select(["key", "at"]).join(sides[1].select(["key", "at"]), "key", join_type="inner", right_suffix="_b", use_threads=False)
    out = []
    for side, at in zip(sides, ("at", "at_b"), strict=True):
        closes = np.zeros(len(side), np.int64)
        closes[ends[at].to_numpy()] = 1
        group = pc.subtract(pc.cumulative_sum(pa.array(closes)), pa.array(closes))  # a token that closes a group is its last one
        out.append(side.append_column("group", group).append_column("closes", pa.array(closes.astype(bool))))
    return out[0], out[1]


def links(a: pa.Table, b: pa.Table) -> pa.Table:
    """doc, a_id, b_id and n: how many links of the document have these ids. In groups of many links, equal ids of a side are
    counted before they meet those of the other."""
    ga, gb = a["group"].to_numpy(), b["group"].to_numpy()
    groups = int(ga[-1]) + 1 if len(ga) else 0
    many = np.bincount(ga, minlength=groups) * np.bincount(gb, minlength=groups) > MANY
    left, right = (_counted(t, many[g]) for t, g in ((a, ga), (b, gb)))
    pairs = left.join(right.drop_columns("doc"), "group", join_type="inner", right_suffix="_b", use_threads=False)
    key = pc.bit_wise_or(pc.shift_left(pairs["doc"].cast(pa.int64()), 2 * ID_BITS), pc.bit_wise_or(pc.shift_left(pairs["id"].cast(pa.int64()), ID_BITS), pairs["id_b"].cast(pa.int64())))
    each = pa.table({"key": key, "n": pc.multiply(pairs["n"], pairs["n_b"])}).group_by("key", use_threads=False).aggregate([("n", "sum")])
    key, low = each["key"], (1 << ID_BITS) - 1
    ids = [pc.bit_wise_and(pc.shift_right(key, shift), low).cast(pa.int32()) for shift in (ID_BITS, 0)]
    return pa.table({"doc": pc.shift_right(key, 2 * ID_BITS), "a_id": ids[0], "b_id": ids[1], "n": each["n_sum"]})


def _counted(side: pa.Table, many: np.ndarray) -> pa.Table:
    """group, doc, id and n of a side's tokens; equal ids of a group are one row where many is set."""
    rows = side.select(["group", "doc", "id"])
    out = [rows.filter(pa.array(~many))]
    out[0] = out[0].append_column("n", pa.array(np.ones(len(out[0]), np.int64)))
    if many.any():
        some = rows.filter(pa.array(many)).group_by(["group", "doc", "id"], use_threads=False).aggregate([([], "count_all")])
        out.append(some.rename_columns(["group", "doc", "id", "n"]))
    return pa.concat_tables(out)


def written_groups(a: pa.Table, b: pa.Table, n_docs: int, vocab: Vocabularies) -> list[bytes]:
    """Each document's groups in decimal, like 1,2|7;3|8,9."""
    ga, gb = a["group"].to_numpy(), b["group"].to_numpy()
    groups = int(ga[-1]) + 1 if len(ga) else 0
    a_in, b_in = np.bincount(ga, minlength=groups), np.bincount(gb, minlength=groups)
    # a token's place where each group's A tokens come first: its number among its own side's and those of the other before it
    places = np.arange(len(ga)) + (np.cumsum(b_in) - b_in)[ga], np.arange(len(gb)) + np.cumsum(a_in)[gb]
    b_doc = b["doc"].to_numpy()
    last = np.append(b_doc[1:] != b_doc[:-1], True)[: len(b_doc)]
    size, texts = len(vocab.written[","]), pa.concat_arrays([vocab.written[e] for e in (",", "|", ";", "")])
    code = np.zeros(len(ga) + len(gb), np.int64)
    code[places[0]] = a["id"].to_numpy() + size * a["closes"].to_numpy()
    code[places[1]] = b["id"].to_numpy() + size * np.where(last, 3, np.where(b["closes"].to_numpy(), 2, 0))
    line = texts.take(pa.array(code))
    data, ends = memoryview(line.buffers()[2] or b""), np.frombuffer(line.buffers()[1], np.int32)[: len(line) + 1]
    per_doc = np.bincount(a["doc"].to_numpy(), minlength=n_docs) + np.bincount(b_doc, minlength=n_docs)
    at = ends[np.concatenate([[0], np.cumsum(per_doc)])].tolist()
    return [data[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers, their bytes by rank, compressed."""
    return pa.compress(values.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def _from_planes(raw: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    flat = np.frombuffer(pa.decompress(raw, 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(4, -1).T).view("<i4")[:, 0].astype(np.int64)


def _chunk(ids: pa.Array, texts: list[str | None], number: int, vocab: Vocabularies) -> pa.RecordBatch:
    """One row: the documents' digests, the links as (document, number of the pair, how often), the distinct pairs."""
    a_lists, b_lists = vocab.lists(texts)
    a, b = align(a_lists, b_lists, vocab)
    linked, n_docs = links(a, b), len(texts)
    key = pc.add(pc.multiply(linked["a_id"].cast(pa.int64()), 1 << 32), linked["b_id"].cast(pa.int64())).combine_chunks()
    coded = pc.dictionary_encode(key)
    pair, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    doc, n = linked["doc"].to_numpy(), linked["n"].to_numpy()
    order = np.lexsort((pair, doc))
    docs_of_pair = pa.table({"pair": coded.indices}).group_by("pair", use_threads=False).aggregate([("pair", "count")])
    n_docs_of = np.zeros(len(distinct), np.int64)
    n_docs_of[docs_of_pair["pair"].to_numpy()] = docs_of_pair["pair_count"].to_numpy()
    per_doc = np.bincount(doc, minlength=n_docs)
    digests = [hashlib.sha256(g).hexdigest() if len(g) else "" for g in written_groups(a, b, n_docs, vocab)]
    groups = np.bincount(a["doc"].to_numpy()[a["closes"].to_numpy()], minlength=n_docs)
    n_links = np.bincount(doc, n, n_docs).astype(np.int64)
    lengths = [pc.list_value_length(x).cast(pa.int64()) for x in (a_lists, b_lists)]
    columns = {
        "chunk": pa.array([number]), "n_pairs": pa.array([len(pair)]), "pairs": pa.array([_planes(pair[order])], pa.binary()), "times": pa.array([_planes(n[order])], pa.binary()),
        "doc_id": _one(ids), "n_a": _one(lengths[0]), "n_b": _one(lengths[1]), "n_groups": _one(pa.array(groups)), "n_links": _one(pa.array(n_links)),
        "groups_sha256": _one(pa.array(digests, pa.string())), "doc_pairs": _one(pa.array(per_doc)),
        "a_ids": _one(pa.array((distinct >> 32).astype(np.int32))), "b_ids": _one(pa.array((distinct & 0xFFFFFFFF).astype(np.int32))), "n_docs": _one(pa.array(n_docs_of)),
    }
    return pa.RecordBatch.from_pydict(columns)


def _one(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _chunks(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"chunk long, n_pairs long, pairs binary, times binary, doc_id array<{id_type}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>,"
        " groups_sha256 array<string>, doc_pairs array<long>, a_ids array<int>, b_ids array<int>, n_docs array<long>"
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, number = vocabularies(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // CHUNK_BYTES, prepend=0)) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True):
                if start < stop:
                    yield _chunk(ids.slice(start, stop - start), texts.slice(start, stop - start).to_pylist(), number, vocab)
                    number += 1

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(rows, schema)


def _counts(chunks: DataFrame) -> DataFrame:
    pairs = chunks.select(F.explode(F.arrays_zip("a_ids", "b_ids", "n_docs")).alias("p")).select("p.*")
    return pairs.groupBy(F.col("a_ids").alias("a_id"), F.col("b_ids").alias("b_id")).agg(F.sum("n_docs").alias("n_docs"))


def link_counts(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """a_id, b_id and n_docs: how many documents hold the pair linked."""
    return _counts(_chunks(docs, a_path, b_path, id_col, text_col).select("a_ids", "b_ids", "n_docs"))


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids of both tokenizers and its groups: how many tokens of A and of B each one has."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, a_ids array<int>, b_ids array<int>, a_in_group array<int>, b_in_group array<int>"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabularies(a_path, b_path)
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                lists = vocab.lists(part.column(1).to_pylist())
                sides = align(*lists, vocab)
                ends = np.concatenate([[0], np.cumsum(np.bincount(sides[0]["doc"].to_numpy()[sides[0]["closes"].to_numpy()], minlength=len(part)))])
                inside = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.bincount(s["group"].to_numpy(), minlength=ends[-1]).astype(np.int32))) for s in sides]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists, *inside], names=[id_col, "a_ids", "b_ids", "a_in_group", "b_in_group"])

    return docs.select(id_col, text_col).mapInArrow(rows, schema)


def score_alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document n_a, n_b, n_groups, n_links, groups_sha256 (of the groups in decimal), n_best (links whose pair is in as many
    documents as any pair of its A id) and count_sum (documents that hold the pair, over all links)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    chunks = materialise(_chunks(docs, a_path, b_path, id_col, text_col), "alignment")
    counts = materialise(_counts(chunks), "pairs")
    best = counts.groupBy(F.col("a_id").alias("_a")).agg(F.max("n_docs").alias("most"))
    ranked = counts.join(best, counts["a_id"] == best["_a"]).select("a_id", "b_id", F.col("n_docs").alias("count"), (F.col("n_docs") == F.col("most")).alias("best"))
    own = chunks.select("chunk", F.posexplode(F.arrays_zip("a_ids", "b_ids")).alias("pair", "p")).select("chunk", F.col("pair"), F.col("p.a_ids").alias("_a"), F.col("p.b_ids").alias("_b"))
    back = own.join(ranked, (F.col("_a") == F.col("a_id")) & (F.col("_b") == F.col("b_id"))).select(F.col("chunk").alias("into"), "pair", "count", "best")
    left = chunks.drop("a_ids", "b_ids", "n_docs")
    schema = f"{id_col} {id_type}, " + ", ".join(f"{k} {t}" for k, t in _DIGEST) + ", n_best long, count_sum long"

    def scored(stored: pa.Table, known: pa.Table) -> pa.Table:
        row = {c: stored[c].combine_chunks() for c in stored.column_names}
        n_pairs, per_doc = row["n_pairs"][0].as_py(), row["doc_pairs"].flatten().to_numpy()
        pair, times = (_from_planes(row[c][0].as_py(), n_pairs) for c in ("pairs", "times"))
        count, is_best = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
        at = known["pair"].to_numpy()
        count[at], is_best[at] = known["count"].to_numpy(), known["best"].to_numpy().astype(np.int64)
        sums, ends = [], np.concatenate([[0], np.cumsum(per_doc)])
        for weight in (is_best, count):
            running = np.concatenate([[0], np.cumsum(times * weight[pair])])
            sums.append(pa.array(running[ends[1:]] - running[ends[:-1]]))
        columns = [row["doc_id"].flatten(), *[row[k].flatten() for k, _ in _DIGEST], *sums]
        return pa.table(columns, names=[id_col, *[k for k, _ in _DIGEST], "n_best", "count_sum"])

    return left.groupBy("chunk").cogroup(back.groupBy("into")).applyInArrow(scored, schema)
