"""Token-ID output: whole texts to compressed, checksummed shards in document order, and back.

Container: a Parquet table in the shared store, one row per segment (shard, seq), written through Spark's committer, so a
lost executor leaves no partial shard. Each row holds the segment's document ids and token counts and one payload of
idcodec, whose blocks are reset and checksummed one by one. Shards follow document order: shard k holds smaller ids than
shard k + 1, and seq orders the segments of a shard.

Nulls and ties: a null text encodes as empty (only the end id); a null id sorts first; rows with equal ids stay apart and
keep the order of their texts. An empty table writes no segment and reads back as no row. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import idcodec, tokens
from .common import shuffle_width, with_prefix_sum

SEGMENT_SCHEMA = "shard int, seq int, n_docs int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, payload binary"
#: Tokens after which a segment ends, at the next document, once half as many again stand behind: no shard ends in a short one.
SEGMENT_TOKENS = idcodec.BLOCK * idcodec.LANES * 2 // 3


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Segments (SEGMENT_SCHEMA) of every row's whole text, in order of id."""
    ranged = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange(shuffle_width(docs.sparkSession), F.col("doc_id"))
        .sortWithinPartitions("doc_id", "text")
    )
    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, shard, seq = tokens.encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        parts: list[np.ndarray] = []
        size = cut = kept = 0  # cut: how many documents the next segment has, once known; kept: their tokens

        def flush(n: int) -> pd.DataFrame:
            counts, own = [len(p) for p in parts[:n]], ids[:n]
            flat = np.concatenate(parts[:n])
            del ids[:n], parts[:n]
            row = (shard, seq, n, sum(counts), own, counts, idcodec.encode(flat))
            return pd.DataFrame([row], columns=["shard", "seq", "n_docs", "n_tokens", "doc_ids", "doc_tokens", "payload"])

        for batch in batches:
            for doc_id, own in zip(batch["doc_id"], enc.documents(batch["text"].tolist(), end_id), strict=True):
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                parts.append(own)
                size += len(own)
                if not cut and size >= SEGMENT_TOKENS:
                    cut, kept = len(parts), size
                if cut and size >= SEGMENT_TOKENS * 3 // 2 and cut < len(parts):
                    yield flush(cut)
                    seq, size = seq + 1, size - kept
                    cut = kept = 0
                    if size >= SEGMENT_TOKENS:
                        cut, kept = len(parts), size
        if ids:
            yield flush(len(ids))

    return ranged.mapInPandas(segments, SEGMENT_SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, **columns: str) -> str:
    encode_documents(docs, tokenizer_path, end_id, **columns).write.option("compression", "none").parquet(path)
    return path


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the written shards: doc_id, start, n_tokens, ids_crc32 (and its ids, on request)."""
    table = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    schema = "shard int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            columns = (batch[c] for c in ("shard", "seq", "doc_ids", "doc_tokens", "payload"))
            for shard, seq, doc_ids, counts, payload in zip(*columns, strict=True):
                ids = idcodec.decode(payload)
                raw = ids.astype("<u4").tobytes()
                ends = np.cumsum(np.asarray(counts, np.int64))
                starts = ends - np.asarray(counts, np.int64)
                out = {
                    "shard": shard,
                    "seq": seq,
                    "doc_id": pd.array([None if pd.isna(x) else int(x) for x in doc_ids], dtype="Int64"),
                    "local": starts,
                    "n_tokens": ends - starts,
                    "ids_crc32": [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)],
                }
                if with_ids:
                    out["ids"] = [ids[a:b].astype(np.int64) for a, b in zip(starts, ends, strict=True)]
                yield pd.DataFrame(out)

    decoded = table.select("shard", "seq", "doc_ids", "doc_tokens", "payload").mapInPandas(documents, schema)
    base = with_prefix_sum(table.select("shard", "seq", "n_tokens"), "shard", ["seq"], "n_tokens", "base").drop("n_tokens")
    out = decoded.join(base, ["shard", "seq"]).withColumn("start", F.col("base") + F.col("local"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
