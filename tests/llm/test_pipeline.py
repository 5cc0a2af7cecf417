"""The corpus pipeline, stage by stage, against what each stage's rule says."""

from __future__ import annotations

from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline
from tidemark.llm import tokens
from tidemark.llm.common import materialise


def words(tag, n=60):
    return " ".join(f"{tag}{k}" for k in range(n))


def make(spark, path):
    rows = [(k, words(f"d{k}x") + ".", "en", f"s{k % 3}", 0) for k in range(30)]
    rows += [(100, words("d3x") + ". more", "en", "s1", 0), (101, "too short", "en", "s1", 0), (102, None, "en", "s1", 0), (103, "A!! B!! C!! D!! " * 20, "en", "s1", 0)]
    rows += [(104, words("sec") + ' token="0123456789abcdef0123456789abcdef" end.', "en", "s2", 0), (105, "Licensed under the X terms here.\n" + words("lic") + ".", "en", None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return rows


def test_stages(spark, tmp_path):
    rows = make(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = materialise(stage(spark, docs, str(tmp_path)), name)
        if name != "sequence_packing":
            assert docs.columns == columns
            seen[name] = {r.doc_id: r for r in docs.collect()}
    ids = {r[0] for r in rows}
    assert set(seen["quality_rules"]) == ids - {101, 102, 103}
    assert seen["quality_rules"][105].text == words("lic") + "." and seen["quality_rules"][105].n_chars == len(words("lic")) + 1
    assert set(seen["near_duplicates"]) == ids - {100, 101, 102, 103}
    secret = seen["secret_scan"]
    assert set(secret) == set(seen["near_duplicates"]) == set(seen["source_mixing"])
    assert secret[104].text == words("sec") + ' token="[SECRET]" end.' and all(secret[k].text == seen["near_duplicates"][k].text for k in secret if k != 104)
    enc = tokens.encoder(tokens.vocabulary("byte_bpe_50k.json"))
    mixed = Counter()
    for r in [*seen["source_mixing"].values()]:
        mixed[r.doc_id] = len(enc.tokenizer.encode(r.text, add_special_tokens=False).ids) + 1
    packed, sequences = defaultdict(int), defaultdict(int)
    for r in docs.collect():
        packed[r.doc_id] += r.length
        sequences[r.sequence_id] += r.length
    assert all(packed[k] % n == 0 and packed[k] >= n for k, n in mixed.items()) and set(packed) == set(mixed)
    assert all(n <= 1024 and n & (n - 1) == 0 for n in sequences.values())


def test_run(spark, tmp_path):
    make(spark, tmp_path)
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(shared.iterdir())
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert len(set(shared.iterdir()) - before) == 1  # the result's own table
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 30
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_repeats_are_far_apart(spark, tmp_path):
    """A small source beside a large one is given out twice; its documents' copies are not neighbours."""
    rows = [(k, words(f"d{k}x", 120) + ".", "en", "small" if k < 40 else "large", 0) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = materialise(corpus_pipeline.source_mixing(spark, docs, ""), "mixed")
    times = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    repeated = {k for k, n in times.items() if n > 1}
    assert len(repeated) >= 20 and set(times) == set(range(400))
    pieces = corpus_pipeline.sequence_packing(spark, mixed, "").collect()
    place = {s: n for n, s in enumerate(sorted({p.sequence_id for p in pieces}))}
    starts = defaultdict(list)
    for p in pieces:
        if p.start == 0:
            starts[p.doc_id].append(place[p.sequence_id])
    assert {k: len(v) for k, v in starts.items()} == dict(times)
    gaps = [max(starts[k]) - min(starts[k]) for k in repeated]
    assert min(gaps) > 10 and sum(gaps) / len(gaps) > len(place) / 3
    for s in place:
        inside = sorted((p.offset, p.length) for p in pieces if p.sequence_id == s)
        assert all(a + n == b for (a, n), (b, _) in zip(inside, inside[1:], strict=False)) and inside[0][0] == 0


def odd_rows():
    rows = [(k, words(f"o{k}x") + ".", "en", ["a", "b", None][k % 3], k, 100 + k, k) for k in range(12)]
    rows += [(None, words("null1") + ".", "en", "a", None, 1, 1), (None, words("null2") + ".", None, None, None, 2, 2), (3, words("same id") + ".", "en", "b", 3, 3, 3)]
    rows += [(20, words("twice") + ".", "en", "a", 4, 4, 4)] * 2 + [(21, None, "en", "a", 5, 5, 5), (22, "", "en", None, 6, 6, 6)]
    return rows


ODD_SCHEMA = "doc_id long, text string, lang string, source string, epoch long, `dotted.name` long, row long"


def test_every_stage_takes_odd_rows_and_names(spark):
    docs = spark.createDataFrame(odd_rows(), ODD_SCHEMA)
    before = {(r["doc_id"], r["text"]): (r["epoch"], r["dotted.name"], r["row"]) for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        if name == "sequence_packing":
            assert {r.doc_id for r in out.collect()} == {r[0] for r in odd_rows()}
            continue
        assert out.columns == docs.columns
        rows = out.collect()
        kept[name] = Counter((r["doc_id"], r["text"]) for r in rows)
        assert all((r["epoch"], r["dotted.name"], r["row"]) == before[r["doc_id"], r["text"]] for r in rows)
    texts = {r[1] for r in odd_rows()}
    assert {t for _, t in kept["quality_rules"]} == texts - {None, ""} and kept["quality_rules"][20, words("twice") + "."] == 2
    assert {t for _, t in kept["near_duplicates"]} == texts and kept["near_duplicates"][20, words("twice") + "."] == 1
    assert kept["secret_scan"] == Counter((r[0], r[1]) for r in odd_rows())
    assert set(kept["source_mixing"]) == {(r[0], r[1]) for r in odd_rows()}


def test_every_stage_takes_no_rows(spark):
    docs = spark.createDataFrame([], ODD_SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0
