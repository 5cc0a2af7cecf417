"""Chat formatting as prefix trees: conversations that begin with the same turns share those turns' tokens.

Every turn is written in a template whose control strings can't come from a text, as those in texts are escaped (and can be
read back). The distinct conversations are put in the order of their paths, so that those with common first turns lie next to
each other, and are cut into shards. A task walks its shard in that order, which is depth first: a turn that the conversation
before it has too is not written again. Each node carries its position id (tokens before it on its own path), its place in the
shard's stream of tokens, and the intervals of that stream it may attend to besides itself: its ancestors, joined where they
touch. Where a tree is cut by a shard's end, the next shard starts with the ancestors it needs.

Paths are compared by hashes of whole prefixes, which are xors of hashes of (number, turn), so they come from window sums of
blocks of turns: no conversation is gathered in a row or a window. A path key has one entry for each turn up to the first that
no other conversation shares. Whole copies of a conversation are set aside first and point to the one that is written.

Nulls and ties: null texts and roles are empty; a null turn comes first; turns with equal numbers follow by role, then by a hash
of their content, repeated rows are turns like any other; rows with a null id are one conversation. An empty table gives no
node. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import discard, materialise, shuffle_width

START, END = "<|im_start|>", "<|im_end|>"
#: Turn numbers in a block, the unit of the windows.
BLOCK_BITS = 10
NODES = (
    "shard int, seq long, parent long, depth long, ends string, text string, loss_start int, loss_end int, ids array<int>, loss_first int, loss_last int,"
    " position long, place long, attends array<struct<start: long, end: long>>"
)
_SPELT = re.compile(r"<(\\*)\\\|")


def escaped(text: Column) -> Column:
    """No "<|" is left: a backslash more stands between."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: str) -> str:
    return _SPELT.sub(r"<\1|", text)


def _role_out(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _turns(convs: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    cid = F.when(F.col(conv).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(conv).cast("string")))
    at = F.coalesce(F.col(turn).cast("long"), F.lit(-(2**63)))
    said = [F.coalesce(F.col(c), F.lit("")) for c in (role, text)]
    content = [F.xxhash64(F.lit(seed), *said).alias(f"c{seed}") for seed in (1, 2)]
    return convs.select(cid.alias("cid"), at.alias("at"), said[0].alias("role"), said[1].alias("text"), *content)


def _prefixes(turns: DataFrame) -> DataFrame:
    """cid, rank (of the turn in its conversation) and the hashes of the turn there (h1, h2) and of all turns up to it (p1, p2)."""
    keys = turns.select("cid", F.shiftright("at", BLOCK_BITS).alias("block"), "at", "role", "c1", "c2")
    before = Window.partitionBy("cid").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    block = ["cid", "block"]
    sizes = keys.groupBy(*block).agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select(*block, F.sum("n").over(before).alias("offset")).where("offset > 0")  # conversations of one block have none
    inside = Window.partitionBy(*block).orderBy("at", "role", "c1", "c2")
    ranked = keys.withColumn("rn", F.row_number().over(inside)).join(offsets, block, "left")
    ranked = ranked.withColumn("rank", F.coalesce("offset", F.lit(0)) + F.col("rn") - 1)
    for k in (1, 2):
        ranked = ranked.withColumn(f"h{k}", F.xxhash64(F.lit(k), "rank", "c1", "c2"))
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    stored = materialise(ranked.select(*block, "rank", "h1", "h2", *[F.bit_xor(f"h{k}").over(running).alias(f"r{k}") for k in (1, 2)]), "prefixes")
    sums = stored.groupBy(*block).agg(*[F.bit_xor(f"h{k}").alias(f"x{k}") for k in (1, 2)])
    carried = sums.select(*block, *[F.bit_xor(f"x{k}").over(before).alias(f"b{k}") for k in (1, 2)]).where("b1 is not null")
    whole = stored.join(carried, block, "left")
    out = whole.select("cid", "rank", "h1", "h2", *[F.col(f"r{k}").bitwiseXOR(F.coalesce(f"b{k}", F.lit(0))).alias(f"p{k}") for k in (1, 2)])
    done = materialise(out, "prefixes")
    discard(stored)
    return done


def _placed(prefixes: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """A table with cid, leaf, n_turns, shard and path of one conversation of each content, and (cid, leaf) of all: the leaf is named
    by the content, so that copies need not be looked up."""
    ends = prefixes.groupBy("cid").agg((F.max("rank") + 1).alias("n_turns"), F.max_by(F.struct("p1", "p2"), "rank").alias("last"))
    members = ends.select("cid", "n_turns", F.concat_ws(".", "n_turns", "last.p1", "last.p2").alias("leaf"))
    distinct = members.groupBy("leaf", "n_turns").agg(F.min("cid").alias("cid"))
    own = prefixes.join(distinct.select(F.col("cid").alias("_cid")), F.col("cid") == F.col("_cid"), "left_semi")
    shared = own.groupBy("rank", "p1", "p2").count().where("count > 1").select((F.col("rank") + 1).alias("_rank"), F.col("p1").alias("_p1"), F.col("p2").alias("_p2"))
    parent = (F.col("rank") == F.col("_rank")) & (F.col("p1").bitwiseXOR(F.col("h1")) == F.col("_p1")) & (F.col("p2").bitwiseXOR(F.col("h2")) == F.col("_p2"))
    forks = own.where("rank = 0").unionByName(own.join(shared, parent, "left_semi"))
    paths = forks.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("rank", "p1", "p2"))).alias("path"))
    paths = paths.join(distinct, "cid")
    return materialise(paths.repartitionByRange(shards, "path", "cid").withColumn("shard", F.spark_partition_id()), "paths"), members.drop("n_turns")


def _walk(tokenizer_path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns in order of (shard, conv, turn) to nodes. The stack has a level for each turn of the conversation at hand."""
    enc = tokens.encoder(tokenizer_path, plain=True)
    shard, conv, seq, stream, rank, matched = -1, -1, 0, 0, 0, True
    # a level: digest, seq, position after it, closed intervals of its path, start and end of the open one
    stack: list[tuple] = []
    rows: list[tuple] = []
    size = 0
    for batch in batches:
        for s, c, leaf, n_turns, role, shown, text, answer in zip(*(col.to_pylist() for col in batch.columns), strict=True):
            if s != shard:
                shard, conv, seq, stream = s, -1, 0, 0
                stack.clear()
            if c != conv:
                conv, rank, matched = c, 0, True
            digest, last = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest(), rank == n_turns - 1
            if matched and rank < len(stack) and stack[rank][0] == digest and not last:
                rank += 1
                continue
            if matched:
                del stack[rank:]
                matched = False
            head, body, foot = f"{START}{shown}\n", text, f"{END}\n"
            parts = [np.frombuffer(enc.encode(x), "<u4") for x in (head, body, foot)]
            ids = np.concatenate(parts).astype(np.int32)
            _, parent, position, closed, a, b = stack[-1] if stack else (b"", None, 0, (), stream, stream)
            open_ = ((a, b),) if b > a else ()
            loss = (len(head), len(head) + len(body), len(parts[0]), len(parts[0]) + len(parts[1])) if answer else (None,) * 4
            rows.append((s, seq, parent, rank, leaf if last else None, head + body + foot, *loss[:2], ids, *loss[2:], position, stream, [{"start": x, "end": y} for x, y in closed + open_]))
            span = (closed, a, stream + len(ids)) if b == stream else (closed + open_, stream, stream + len(ids))
            stack.append((digest, seq, position + len(ids), *span))
            seq, stream, rank, size = seq + 1, stream + len(ids), rank + 1, size + len(text)
            if size > 4_000_000 or len(rows) >= 10_000:
                yield _node_batch(rows)
                rows.clear()
                size = 0
    if rows:
        yield _node_batch(rows)


def _node_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
    names = [c.split()[0] for c in re.split(r", (?=\w+ )", re.sub(r"<struct<.*", "", NODES))]
    return pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def write_trees(convs: DataFrame, path: str, tokenizer_path: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> str:
    """Writes path/nodes (NODES; shard and seq give the order, ends names the content that ends there) and path/conversations
    (conv_col, leaf): the name in ends of each conversation's last node."""
    spark, shards = convs.sparkSession, shuffle_width(convs.sparkSession)
    turns = _turns(convs, conv_col, turn_col, role_col, text_col)
    prefixes = _prefixes(turns)
    paths, members = _placed(prefixes, shards)
    placed = paths.select("cid", "leaf", "n_turns", "shard", F.row_number().over(Window.partitionBy("shard").orderBy("path", "cid")).alias("conv"))
    names = convs.select(F.col(conv_col).alias("conv_id"), F.when(F.col(conv_col).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(conv_col).cast("string"))).alias("cid")).distinct()
    names.join(members, "cid").select(F.col("conv_id").alias(conv_col), "leaf").write.parquet(f"{path}/conversations")
    rows = turns.join(placed, "cid").repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "conv", "at", "role", "c1", "c2")
    shown = rows.select("shard", "conv", "leaf", "n_turns", "role", _role_out(F.col("role")).alias("shown"), escaped(F.col("text")).alias("text"), (F.col("role") == "assistant").alias("answer"))
    shown.mapInArrow(lambda batches: _walk(tokenizer_path, batches), NODES).write.parquet(f"{path}/nodes")
    discard(prefixes, paths)
    return path


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes in order to one row for each conversation that ends. A level holds the running hashes of its path: a shared turn is hashed once."""
    shard, stack = -1, []
    for batch in batches:
        out = []
        for s, depth, ends, text, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if s != shard:
                shard, stack = s, []
            del stack[depth:]
            turns, answers, loss_chars, chars = stack[-1] if stack else (hashlib.sha256(), hashlib.sha256(), 0, 0)
            turns, answers = turns.copy(), answers.copy()
            role, _, body = text.removeprefix(START).removesuffix(f"{END}\n").partition("\n")
            turns.update(f"{_role_in(role)}\n{unescape(body)}\n".encode())
            if a is not None:
                said = unescape(text[a:b])
                answers.update(said.encode())
                loss_chars += len(said)
            chars += len(text)
            stack.append((turns, answers, loss_chars, chars))
            if ends is not None:
                out.append((ends, depth + 1, turns.hexdigest(), loss_chars, answers.hexdigest(), chars))
        if out:
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["ends", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_conversations(spark: SparkSession, path: str) -> DataFrame:
    """Per conversation, from the written trees: conv_id, n_turns, turns_sha256 (role and text a line each), loss_chars and
    loss_sha256 of what the loss mask covers, unescaped, and formatted_chars."""
    nodes = spark.read.schema(NODES).parquet(f"{path}/nodes")
    ordered = nodes.repartitionById(shuffle_width(spark), F.col("shard")).sortWithinPartitions("shard", "seq")
    read = ordered.select("shard", "depth", "ends", "text", "loss_start", "loss_end").mapInArrow(_read, "ends string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    named = spark.read.parquet(f"{path}/conversations")
    return named.join(read, named["leaf"] == read["ends"]).drop("leaf", "ends")
