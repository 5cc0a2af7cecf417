"""Fill-in-middle and cross-tokenizer alignment against plain brute force, on odd rows and the smallest tables."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import alignment, fill_middle, queries, tokens
from tidemark.llm.fill_middle import ExceptionIndex

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = tokens.vocabulary("byte_bpe_50k.json"), tokens.vocabulary("piece_bpe_32k.model")
ODD = [
    None, "", " ", "a", "é", "日本語 a", "a  b\n\nc\t", "x<P>y", "<S>", "<M", "<", "a<P", "S>b<S", "🙂🙂 emoji 🙂", "a\0b", "the ▁ mark", "<s> </s> <unk> <0x41>", "end <|endoftext|> now",
    " lead", "trail ", "ﬁ ｆｕｌｌ é", "word " * 4000, "ñandú " * 3000, "same text", "same text", "aaaaaaaaaaaaaaaaaaaaaaaa", "İstanbul ΣΣ\x85　y",
]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.sampled_from("aé日🙂 \n<PSM>"), max_size=30))
def test_exception_index(text):
    index = ExceptionIndex(np.frombuffer(text.encode(), np.uint8))
    chars = np.arange(len(text) + 1)
    want = np.array([len(text[:i].encode()) for i in chars])
    assert index.to_bytes(chars).tolist() == want.tolist()
    assert index.to_chars(want).tolist() == chars.tolist()


def brute_fill(doc_id, text, seed=1):
    text, h = text or "", hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", i, j - i, f"<S>{text[j:]}<P>{text[:i]}<M>{text[i:j]}"
    return n, "psm", i, j - i, f"<P>{text[:i]}<S>{text[j:]}<M>{text[i:j]}"


def test_fill_in_middle_equals_brute_force(spark):
    rows = [(i % 20 if i else None, t, {"a": i}, i) for k in range(6) for i, t in enumerate(ODD, 40 * k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `dotted.name` map<string,int>, n int")
    made = fill_middle.fill_in_middle(docs)
    assert made.columns[:4] == docs.columns
    out = made.withColumn("again", fill_middle.restored(made["output"], made["form"])).collect()
    want = sorted((str(r[0]), str(r[1]), *map(str, brute_fill(r[0], r[1]))) for r in rows)
    assert sorted((str(r["doc_id"]), str(r["text"]), *map(str, (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]))) for r in out) == want
    assert all(r["again"] == (r["text"] or "") and r["dotted.name"] for r in out)
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}
    for r in out:
        if r["form"] != "plain":
            assert r["prefix_bytes"] == len(r["text"][: r["prefix_chars"]].encode())
            assert r["middle_bytes"] == len(r["text"][r["prefix_chars"] : r["prefix_chars"] + r["middle_chars"]].encode())
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0


def brute_align(docs):
    """doc_id and the result columns of score_alignments, by the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_lib, b_lib = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    rows = []
    for doc_id, text in docs:
        groups = []
        if text:
            a = [(i, bytes(letters[c] for c in a_lib.id_to_token(i))) for i in a_lib.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode()) for i in b_lib.encode(text)]
            if b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (a, b)]
                common = sorted(ends[0] & ends[1])
                spots = [np.searchsorted(common, np.cumsum([len(x) for _, x in side])).tolist() for side in (a, b)]
                groups = [([], []) for _ in common]
                for k, side in enumerate((a, b)):
                    for (i, _), g in zip(side, spots[k], strict=True):
                        groups[g][k].append(i)
        rows.append((doc_id, groups))
    count = Counter()
    for _, groups in rows:
        count.update({(x, y) for a, b in groups for x in a for y in b})
    most = defaultdict(int)
    for (x, _), c in count.items():
        most[x] = max(most[x], c)
    out = []
    for doc_id, groups in rows:
        linked = [(x, y) for a, b in groups for x in a for y in b]
        spelt = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        sha = hashlib.sha256(spelt.encode()).hexdigest() if groups else ""
        out.append((doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(linked), sha, sum(count[p] == most[p[0]] for p in linked), sum(count[p] for p in linked)))
    return sorted(map(str, out))


def test_alignment_equals_brute_force_on_odd_rows(spark, monkeypatch):
    rows = [(None if i == 3 else i // 2, t, i) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk int").repartition(3)
    got = alignment.score_alignments(docs, A, B)
    assert sorted(str(tuple(r)) for r in got.collect()) == brute_align([r[:2] for r in rows])
    assert alignment.score_alignments(docs.limit(0), A, B).count() == 0
    counts = {(r["a_id"], r["b_id"]): r["n_docs"] for r in alignment.link_counts(docs, A, B).collect()}
    assert max(counts.values()) > 2
    for r in alignment.alignments(docs, A, B).collect():
        assert sum(r["a_in_group"]) == len(r["a_ids"]) and sum(r["b_in_group"]) == len(r["b_ids"])


def test_chunks_of_any_size_give_the_same(spark):
    import pyarrow as pa

    vocab = alignment.vocabularies(A, B)
    texts = [t for t in ODD if t != "the ▁ mark"]
    whole = alignment._chunk(pa.array(range(len(texts))), texts, 0, vocab)
    for i, t in enumerate(texts):
        alone = alignment._chunk(pa.array([i]), [t], 0, vocab)
        for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "doc_pairs"):
            assert alone[c][0].as_py()[0] == whole[c][0].as_py()[i]


def test_alignment_query_equals_brute_force(spark):
    docs = [tuple(r) for r in queries.table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    assert sorted(str(tuple(r)) for r in queries.op12_alignment(spark, SMALL).collect()) == brute_align(docs)
