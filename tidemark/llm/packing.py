"""Packing along a space-filling curve.

Every document's token ids are hashed into a small signed count vector, projected to a few dimensions, and given the
Hilbert key of its grid cell. Documents are range-sorted by that key, so neighbours on the curve are alike, and each range
is packed as one stream cut at the sequence length. What is left at a range's end is cut into lengths that are powers of
two, which need no padding.

Nulls and ties: a null or empty text is just its end id; equal keys are ordered by doc_id, then by the ids, so exact copies
spread over ranges like any other rows; rows with the same doc_id are packed each on its own. An empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import materialise, shuffle_width

HASHED, DIMS, BITS = 256, 4, 8
TOKEN_SCHEMA = "doc_id long, hkey long, doc_tokens long, ids binary"
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """cells: n by dims, integers below 2**bits. Distance along the Hilbert curve, as int64 (bits * dims < 64)."""
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:  # undo the curve's reflections and exchanges, from the coarsest level on
        low = q - 1
        for d in range(dims):
            hit = (x[:, d] & q) != 0
            swap = np.where(hit, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= np.where(hit, low, swap)
            x[:, d] ^= swap
        q >>= 1
    for d in range(1, dims):  # Gray code
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[:, dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[:, d] >> b) & 1)
    return key


def projection(seed: int = 17) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((HASHED, DIMS)) / np.sqrt(HASHED)


def hashed_vector(ids: np.ndarray) -> np.ndarray:
    """Signed counts of hashed ids, of length one."""
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    slot = (h >> np.uint64(32)).astype(np.int64) & (2 * HASHED - 1)
    both = np.bincount(slot, minlength=2 * HASHED)
    v = (both[:HASHED] - both[HASHED:]).astype(np.float64)
    size = np.linalg.norm(v)
    return v / size if size else v


def curve_cells(vectors: np.ndarray, plane: np.ndarray) -> np.ndarray:
    spread = 1 / (1 + np.exp(-np.clip(vectors @ plane * np.sqrt(HASHED) * 1.7, -50, 50)))
    return np.minimum((spread * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def tokenise_with_keys(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, plane = tokens.encoder(tokenizer_path), projection()
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.iloc[a : a + 256]
                ids = [enc.document(t, end_id) for t in part["text"]]
                keys = hilbert_keys(curve_cells(np.array([hashed_vector(x) for x in ids]), plane))
                narrow = [x.astype("<u2").tobytes() if int(x.max()) <= 0xFFFF else b"\0" + x.tobytes() for x in ids]
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "hkey": keys, "doc_tokens": [len(x) for x in ids], "ids": narrow})

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInPandas(rows, TOKEN_SCHEMA)


def unpack_ids(raw: bytes) -> np.ndarray:
    """ids of TOKEN_SCHEMA: 16-bit each, or a zero byte and 32-bit each (an odd length)."""
    return np.frombuffer(raw, "<u4", offset=1) if len(raw) % 2 else np.frombuffer(raw, "<u2").astype("<u4")


def pack_sequences(docs: DataFrame, tokenizer_path: str, end_id: int, length: int = 1024, id_col: str = "doc_id", text_col: str = "text", repeats_apart: bool = False) -> DataFrame:
    """One row per piece (PIECE_SCHEMA); sequence_id is unique, not gapless.

    repeats_apart: documents that come several times (the same id and ids, as mixing gives them out in epochs) are neighbours on
    the curve. Their second rows are packed among themselves, behind the first ones, in sequences with larger numbers than all
    of those, and so on: in order of sequence_id a repeat is a pass over the corpus away from the one before.
    """
    table = materialise(tokenise_with_keys(docs, tokenizer_path, end_id, id_col, text_col), "curve")
    keys = ["hkey", "doc_id", "doc_tokens"]
    ranged = table.repartitionByRange(shuffle_width(docs.sparkSession), *keys).withColumn("epoch", F.lit(0))
    if repeats_apart:  # ranges of the keys hold all rows of a key, so this window moves nothing
        ranged = ranged.withColumn("epoch", F.row_number().over(Window.partitionBy(*keys, "ids").orderBy("ids")) - 1)
    ordered = ranged.sortWithinPartitions("epoch", "hkey", "doc_id", "ids")  # a task that runs again cuts the same pieces

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, epoch = TaskContext.get().partitionId() << 32, 0
        sequence, room = first, length
        held: list[list] = []  # pieces of the open sequence, with their bytes
        done: list[tuple] = []

        def close() -> None:
            done.extend(tuple(p[:-1]) for p in held)
            held.clear()

        def tail() -> None:
            """The open sequence, cut into lengths that are powers of two."""
            nonlocal sequence
            left = length - room
            size, offset = 1 << max(left.bit_length() - 1, 0), 0
            for doc, start, take, _, n, _, _, data in held:
                while take:
                    if offset == size:
                        left, offset, sequence = left - size, 0, sequence + 1
                        size = 1 << (left.bit_length() - 1)
                    k = min(take, size - offset)
                    done.append((doc, start, k, zlib.crc32(data[: 4 * k]), n, sequence, offset))
                    start, take, data, offset = start + k, take - k, data[4 * k :], offset + k
            held.clear()

        for batch in batches:
            for doc_id, raw, turn in zip(batch["doc_id"], batch["ids"], batch["epoch"], strict=True):
                if turn != epoch:
                    tail()
                    epoch, room = int(turn), length
                    sequence = (epoch << 52) | first
                ids = unpack_ids(raw)
                data, n, start = ids.tobytes(), len(ids), 0
                doc = None if pd.isna(doc_id) else int(doc_id)
                while start < n:
                    take = min(room, n - start)
                    part = data[4 * start : 4 * (start + take)]
                    held.append([doc, start, take, zlib.crc32(part), n, sequence, length - room, part])
                    start, room = start + take, room - take
                    if not room:
                        close()
                        sequence, room = sequence + 1, length
            if len(done) >= 20_000:
                yield _piece_frame(done)
                done.clear()
        tail()
        if done:
            yield _piece_frame(done)

    return ordered.select("doc_id", "ids", "epoch").mapInPandas(pieces, PIECE_SCHEMA)


def _piece_frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECE_SCHEMA.split(", ")])
    return out.astype({"doc_id": "Int64"})
