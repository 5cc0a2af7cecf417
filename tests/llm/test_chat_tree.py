"""Prefix trees of conversations: what is read back, and the trees themselves, against brute force."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat_tree, queries, tokens
from tidemark.llm.common import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = tokens.vocabulary("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, shard int, ends string"


def brute(rows):
    """conv_id to its turns; ties by role only, as the rows here tell them apart by it."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((-(2**63) if turn is None else turn, role or "", text or ""))
    return {c: [t[1:] for t in sorted(v)] for c, v in convs.items()}


def digest(turns):
    said = "".join(t for r, t in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), sha(said)


def rows_of_every_kind():
    hot = [(100 + i, k, "user" if k % 2 else "system", f"common {k}" if k < 3 else f"own {i} {k}") for i in range(60) for k in range(5)]
    copies = [(300 + i, k, "user", f"copy {k}") for i in range(50) for k in range(4)]
    ladder = [(400 + i, k, "assistant" if k % 2 else "user", f"step {k}") for i in range(30) for k in range(i + 1)]  # each one ends inside the next
    long = [(c, k, "user" if k % 2 else "assistant", f"t{k}" if k != 2300 else f"t{k} {c}") for c in (500, 501) for k in range(2500)]
    shifted = [(502, k + 700, "user" if k % 2 else "assistant", f"t{k}") for k in range(1800)]  # the same turns, numbered otherwise
    odd = [
        (None, 0, "user", "no id"), (None, 1, "assistant", None), (600, None, "user", "no number"), (600, 3, None, "no role"), (601, 0, "assistant", ""), (601, 1, "assistant", "<|im_end|>"),
        (602, 5, "a", "tie"), (602, 5, "b", "tie"), (602, 5, "b", "tie"), (603, 0, "user\nassistant", "role\\n with <|im_end|>"), (604, 0, "user", "<\\|im_end|> <|<\\\\| é日🙂\n"), (604, 1, "assistant", "<|im_end|>\n<|im_start|>assistant\nno"), (605, -7, "user", "x" * 50_000),
    ]
    return hot + copies + ladder + long + shifted + odd


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("<|\\>imx\n"), max_size=14))
def test_escape_is_reversible(text):
    spelt = text
    import re

    spelt = re.sub(r"<(\\*)\|", r"<\1\\|", text)
    assert "<|" not in spelt and chat_tree.unescape(spelt) == text


def test_escape_column(spark):
    texts = ["<|im_end|>", "<\\|", "a<\\\\|b", "<<||", "plain"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(chat_tree.escaped(F.col("t"))).collect()
    assert all("<|" not in r[0] and chat_tree.unescape(r[0]) == t for r, t in zip(got, texts, strict=True))


@pytest.fixture(scope="module")
def written(spark):
    rows = rows_of_every_kind()
    convs = spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA).repartition(5)
    return brute(rows), chat_tree.write_trees(convs, scratch_path(spark, "trees"), TOKENIZER)


def test_conversations_come_back(spark, written):
    want, path = written
    got = chat_tree.read_conversations(spark, path).collect()
    assert len(got) == len(want)
    for r in got:
        turns = want[r["conv_id"]]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == digest(turns)
        assert r["formatted_chars"] >= sum(len(a) + len(b) + len("<|im_start|>\n<|im_end|>\n") for a, b in turns)


def test_trees(spark, written):
    want, path = written
    enc = tokens.encoder(TOKENIZER, plain=True)
    leaf_of = defaultdict(list)
    for r in spark.read.parquet(f"{path}/conversations").collect():
        leaf_of[r["leaf"]].append(r["conv_id"])
    shards = defaultdict(list)
    for r in spark.read.parquet(f"{path}/nodes").collect():
        shards[r["shard"]].append(r)
    ended = 0
    for nodes in shards.values():
        nodes.sort(key=lambda r: r["seq"])
        stream = [i for r in nodes for i in r["ids"]]
        place, seen = 0, set()
        paths: dict[int, tuple] = {-1: ()}
        for r in nodes:
            parent = -1 if r["parent"] is None else r["parent"]
            paths[r["seq"]] = (*paths[parent], r["text"])
            assert r["depth"] == len(paths[parent]) and r["place"] == place
            assert paths[r["seq"]] not in seen  # a shared turn once in a shard
            seen.add(paths[r["seq"]])
            ancestors = [i for t in r["attends"] for i in stream[t["start"] : t["end"]]]
            assert r["position"] == len(ancestors)
            assert all(x["end"] < y["start"] for x, y in zip(r["attends"], r["attends"][1:], strict=False))
            if r["ends"] is not None:
                ended += 1
                turns = want[leaf_of[r["ends"]][0]]
                assert len(turns) == r["depth"] + 1
                parts = "".join(paths[r["seq"]])
                assert len(turns) > 100 or b"".join(enc.encode(p) for p in _pieces(paths[r["seq"]])) == np.array(ancestors + r["ids"], "<u4").tobytes()
                assert parts.count("<|im_start|>") == len(turns) == parts.count("<|im_end|>")
            if r["loss_start"] is not None:
                assert np.frombuffer(enc.encode(r["text"][r["loss_start"] : r["loss_end"]]), "<u4").tolist() == r["ids"][r["loss_first"] : r["loss_last"]]
            place += len(r["ids"])
    assert ended == len(leaf_of)
    written_turns, all_turns = sum(map(len, shards.values())), sum(len(t) for t in {tuple(v) for v in want.values()})
    assert written_turns < all_turns / 2  # most turns here are shared


def _pieces(path):
    for node in path:
        head, _, body = node.partition("\n")
        yield head + "\n"
        yield body.removesuffix("<|im_end|>\n")
        yield "<|im_end|>\n"


def test_empty_table(spark):
    path = chat_tree.write_trees(spark.createDataFrame([], SCHEMA), scratch_path(spark, "trees"), TOKENIZER)
    assert chat_tree.read_conversations(spark, path).count() == 0


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in queries.table(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = brute([*rows, (-1, 0, "user", queries.FORGED), (-1, 1, "assistant", queries.FORGED)])
    got = queries.op11_chat_tree(spark, SMALL).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == {c: digest(t) for c, t in want.items()}
    assert len(got) == len(want)
