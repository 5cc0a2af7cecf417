"""Token output and packing: exact ids, exact round trips, damage found."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import idcodec, packing, token_output, tokens
from tidemark.llm.common import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = ["", " ", "a  b", "a \n b\n\nc", "ÀÉ ñ İstanbul ΣΣ", "x\x85y", "日本 語 a", "it's I'LL don't", "\n\n a", "   ", "a\tb c²3¼ 12345", "é b   c", "<|endoftext|> hi", " lead", "trail ", "Kelvin K ſ", "A.B,c!!! ***"]
TEXTS = [*ODD, None, "word " * 3000, "the same text", "the same text"]


@pytest.mark.parametrize("name", NAMES)
def test_encoder_is_exact(name):
    from tokenizers import Tokenizer

    enc, fresh = tokens.Encoder(tokens.vocabulary(name)), Tokenizer.from_file(tokens.vocabulary(name))
    for text in ODD:
        want = fresh.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == want, repr(text)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB é\n\t .,'s1²日Σ  "), max_size=40))
def test_encoder_is_exact_on_any_text(text):
    for name in NAMES:
        enc = tokens.encoder(tokens.vocabulary(name))
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
def test_added_tokens_are_the_library_s(name):
    from tokenizers import Tokenizer

    path = tokens.vocabulary(name)
    fresh, enc = Tokenizer.from_file(path), tokens.Encoder(path)
    for text in [*ODD, "end <|endoftext|> now", "<|startoftext|>a<|endoftext|>b", "<|ENDOFTEXT|>", "a <|endoftext|", "x  <|endoftext|>\n日本"]:
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == fresh.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 4095, 4096, 4097, 9000])
@pytest.mark.parametrize("kinds", [1, 2, 500, 60_000, 2**32])
def test_codec_round_trip(n, kinds):
    ids = np.random.default_rng(n).integers(0, kinds, n).astype(np.uint32)
    assert np.array_equal(idcodec.decode(idcodec.encode(ids)), ids)


def test_codec_predicts():
    ids = np.tile(np.arange(9, dtype=np.uint32), 2000)
    assert len(idcodec.encode(ids)) < len(ids) / 10


def test_codec_beats_zlib_on_the_same_blocks(spark):
    """Real ids, block by block: context mixing against zlib on two bytes an id."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    enc = tokens.encoder(tokens.vocabulary("word_bpe_49k.json"))
    ids = np.concatenate([enc.document(t, 2) for t in texts])
    zipped = sum(len(zlib.compress(ids[k : k + idcodec.BLOCK].astype("<u2").tobytes(), 9)) for k in range(0, len(ids), idcodec.BLOCK))
    assert len(idcodec.encode(ids)) < 0.85 * zipped


def test_codec_holds_any_number_of_ids(monkeypatch):
    """A group whose table would be too large is coded in halves; ids beyond 16 and 22 bits."""
    monkeypatch.setattr(idcodec, "TABLE", 1 << 16)
    rng = np.random.default_rng(5)
    for ids in (rng.permutation(120_000).astype(np.uint32), rng.integers(0, 2**32, 80_000).astype(np.uint32)):
        assert np.array_equal(idcodec.decode(idcodec.encode(ids)), ids)
    payload = idcodec.encode(ids)
    assert np.array_equal(idcodec.decode(payload, slice(9, 12)), ids[9 * idcodec.BLOCK : 12 * idcodec.BLOCK])


@pytest.mark.parametrize("name", NAMES)
def test_texts_cut_together_are_exact(name, monkeypatch):
    """Texts that are cut together, in one go or in several, give what the library gives for each."""
    from tokenizers import Tokenizer

    enc, fresh = tokens.Encoder(tokens.vocabulary(name)), Tokenizer.from_file(tokens.vocabulary(name))
    odd = [*TEXTS, "\xada \xa1b\xff\xb5\xaa", "é1²b.9..", "A\0b", "'s", "x <|endoftext|>", "last"]
    for texts in (odd, odd[::-1], [], [None], ["'"], ["a"]):
        want = [fresh.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
        for most in (1, 50, 16_000_000):
            monkeypatch.setattr(tokens, "_BATCH", most)
            assert [ids.tolist() for ids in enc.documents(texts, 2)] == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("strevmldSLa'' .9\n\"é"), max_size=14), max_size=4))
def test_contractions_cut_together_are_exact(texts):
    enc = tokens.encoder(tokens.vocabulary("word_bpe_49k.json"))
    want = [enc.tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert [ids.tolist() for ids in enc.documents(texts, 2)] == want


def test_contractions_are_looked_up_once_a_batch():
    enc, asked = tokens.Encoder(tokens.vocabulary("word_bpe_49k.json")), []
    enc.encode = lambda text: asked.append(text) or b""
    assert len(enc.documents(["it's", "They'll go, won't they're 'left'", "'"] * 50, 2)) == 150 and not asked


def test_pieces_are_looked_up_once_a_batch():
    """A batch asks the memory for its different pieces, not for all of them."""
    enc, asked = tokens.Encoder(tokens.vocabulary("word_bpe_49k.json")), []

    class Counting(tokens._Memory):
        def __getitem__(self, piece):
            asked.append(piece)
            return super().__getitem__(piece)

    enc.pieces = Counting(enc.pieces.encode)
    enc.documents(["the same words, the same text"] * 500, 2)
    assert sorted(asked) == sorted({"the", "same", "words", ",", "text"})


def test_codec_takes_followers_from_counts(spark):
    """Real ids: below what their counts alone would take (1.04 bytes an id), as order 1 knows several followers of an id."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()]
    enc = tokens.encoder(tokens.vocabulary("word_bpe_49k.json"))
    ids = np.concatenate(enc.documents(texts, 2))
    assert len(idcodec.encode(ids)) < 0.85 * len(ids)


def test_codec_learns_second_order():
    """What follows 9 depends on what came before it: order 1 alone would take two bits for each three ids."""
    pick = np.random.default_rng(2).integers(0, 2, 40_000)
    ids = np.array([[1, 9, 2], [3, 9, 4]], np.uint32)[pick].ravel()
    payload = idcodec.encode(ids)
    assert np.array_equal(idcodec.decode(payload), ids)
    assert len(payload) < 1.5 * len(pick) / 8


def test_codec_groups_are_even():
    """Blocks beyond LANES make two groups of about the same size, not a full one and a rest."""
    sizes = [len(part) for part, *_ in idcodec._groups(np.zeros(idcodec.BLOCK * (idcodec.LANES + 3) + 1, np.uint32))]
    assert len(sizes) == 2 and max(sizes) - min(sizes) <= 2 * idcodec.BLOCK


def test_codec_finds_any_damage():
    rng = np.random.default_rng(6)
    ids = rng.zipf(1.3, 9000).clip(0, 5000).astype(np.uint32)
    payload = idcodec.encode(ids)
    head = struct.unpack_from("<IIII", payload, 20)[2]
    for at in rng.integers(20 + 16 + head, len(payload), 25):
        damaged = bytearray(payload)
        damaged[at] ^= 1 << int(rng.integers(8))
        try:
            assert np.array_equal(idcodec.decode(bytes(damaged)), ids)  # bits behind a block's last interval
        except ValueError as e:
            assert "checksum" in str(e)


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_PIECES", 40)
    enc = tokens.Encoder(tokens.vocabulary("byte_bpe_50k.json"))
    for k in range(300):
        text = f"word{k} and w{k % 7} 日{k}"
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(enc.pieces) + len(enc.pieces.older) <= 40 and len(enc.chunks) + len(enc.chunks.older) <= 40


def test_codec_blocks_are_independent():
    ids = np.random.default_rng(1).integers(0, 300, 3 * idcodec.BLOCK + 10).astype(np.uint32)
    payload = idcodec.encode(ids)
    assert np.array_equal(idcodec.decode(payload, slice(2, 3)), ids[2 * idcodec.BLOCK : 3 * idcodec.BLOCK])


def test_codec_finds_damage():
    payload = bytearray(idcodec.encode(np.random.default_rng(1).integers(0, 300, 5000).astype(np.uint32)))
    payload[-300] ^= 0x55
    with pytest.raises(ValueError, match="checksum"):
        idcodec.decode(bytes(payload))


def _docs(spark, texts=TEXTS):
    rows = [(None if k == 4 else (7 if k in (8, 9) else 1000 - k), t, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, shard string")


def test_token_output(spark):
    docs = _docs(spark)
    path = token_output.write_tokens(docs, scratch_path(spark, "t"), tokens.vocabulary("word_bpe_49k.json"), 2)
    got = token_output.read_tokens(spark, path).collect()
    enc = tokens.encoder(tokens.vocabulary("word_bpe_49k.json"))
    order = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()))
    start, want = 0, []
    for r in order:
        ids = enc.tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_shards_end_in_no_short_segment(spark, monkeypatch):
    monkeypatch.setattr(token_output, "SEGMENT_TOKENS", 1000)
    docs = spark.createDataFrame([(k, "word " * 149) for k in range(60)] + [(99, "word " * 5000)], "doc_id long, text string").coalesce(1)
    path = token_output.write_tokens(docs, scratch_path(spark, "t"), tokens.vocabulary("word_bpe_49k.json"), 2)
    table = spark.read.parquet(path)
    assert table.count() > 3
    short = table.groupBy("shard").agg({"n_tokens": "min", "seq": "max"}).where("`min(n_tokens)` < 500 and `max(seq)` > 0")
    assert short.count() == 0
    got = sorted(token_output.read_tokens(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    enc = tokens.encoder(tokens.vocabulary("word_bpe_49k.json"))
    want = [enc.tokenizer.encode(r.text, add_special_tokens=False).ids + [2] for r in sorted(docs.collect())]
    assert [list(r.ids) for r in got] == want and [r.start for r in got] == np.cumsum([0, *map(len, want)])[:-1].tolist()


def test_token_output_empty(spark):
    path = token_output.write_tokens(_docs(spark, []), scratch_path(spark, "t"), tokens.vocabulary("word_bpe_49k.json"), 2)
    assert token_output.read_tokens(spark, path).count() == 0


def test_packing(spark):
    docs = _docs(spark)
    pieces = [r.asDict() for r in packing.pack_sequences(docs, tokens.vocabulary("byte_bpe_50k.json"), 0).collect()]
    enc = tokens.encoder(tokens.vocabulary("byte_bpe_50k.json"))
    by_sequence, want = {}, []
    for r in docs.collect():
        ids = enc.tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        want.append((r.doc_id, len(ids)))
    assert sum(p["length"] for p in pieces) == sum(n for _, n in want)
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024 and at & (at - 1) == 0  # full, or a power of two: no padding
    for r in docs.where("doc_id is not null and doc_id <> 992 and doc_id <> 7").collect():
        ids = enc.tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        own = sorted((p for p in pieces if p["doc_id"] == r.doc_id), key=lambda p: p["start"])
        at = 0
        for p in own:
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    assert packing.pack_sequences(_docs(spark, []), tokens.vocabulary("byte_bpe_50k.json"), 0).count() == 0


def test_hilbert_is_a_curve():
    n, dims = 8, 3
    cells = np.stack(np.meshgrid(*[np.arange(n)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = packing.hilbert_keys(cells, bits=3)
    assert sorted(keys) == list(range(n**dims))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()  # each cell's follower is its neighbour
