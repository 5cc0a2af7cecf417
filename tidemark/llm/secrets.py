"""Secret scans with corpus-wide ownership frequency.

Every whole text is scanned for candidate credentials. Each candidate's hash is then counted over the corpus: in how many
distinct repositories, and of how many distinct owners, it occurs. A value that many owners or repositories carry is a copied
example; one held by few is live-looking. Ownership also decides about the generic candidates, long mixed tokens that no
fixed pattern names: they become findings only when live-looking.

Nulls and ties: a null text is empty; a null repository or owner counts as one unknown repository or owner; rows with equal
ids are scanned and returned each on its own; a value twice in one text counts once for its owner. Empty tables give empty
results, other columns are ignored by the scan and pass through redact.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, packed, unpacked

#: The kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "mixed")
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_MIXED = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: A value of at most so many owners and repositories is live-looking.
MAX_OWNERS, MAX_REPOS = 2, 6
#: Least entropy of a generic token's characters, in bits: random keys of 20 characters have about 4.
MIN_ENTROPY = 3.2
CANDIDATE = "struct<kind:int,start:long,stop:long,value_start:long,hash:string>"
SCAN_SCHEMA = f"row_id long, doc_id long, text_hash long, n_assign long, n_access long, n_hex long, base_spans string, found array<{CANDIDATE}>"


def _is_mixed(value: str) -> bool:
    """A generic token: lower and upper case and digits together and no character too often, as random keys have it and
    words or numbers don't."""
    if not (any(c.islower() for c in value) and any(c.isupper() for c in value) and sum(c.isdigit() for c in value) >= 2):
        return False
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values()) >= MIN_ENTROPY


def scan_text(text: str) -> list[tuple[int, int, int, int, str]]:
    """(kind, start, end, start of the value, the value), by start, then kind; code points, end exclusive."""
    found = []
    if "=" in text or ":" in text:
        found += [(0, m.start(), m.end(), m.start(1), m.group(1)) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m.start(), m.group()) for m in _ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), m.start(), m.group()) for m in _HEX.finditer(text)]
    taken = sorted((s, e) for _, s, e, _, _ in found)
    reach, k = -1, 0  # how far the base spans that start before this token's end reach
    for m in _MIXED.finditer(text):
        while k < len(taken) and taken[k][0] < m.end():
            reach, k = max(reach, taken[k][1]), k + 1
        if reach <= m.start() and _is_mixed(m.group()):
            found.append((3, m.start(), m.end(), m.start(), m.group()))
    return sorted(found, key=lambda x: (x[1], x[0]))


def _spans(found) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e, *_ in found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | str = "source", owner: Column | str = "source") -> tuple[DataFrame, DataFrame]:
    """(scanned rows, ownership): SCAN_SCHEMA with repo and owner, and hash, n_repos, n_owners, live."""
    repo, owner = (F.col(c) if isinstance(c, str) else c for c in (repo, owner))
    source = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"), repo.cast("string").alias("repo"), owner.cast("string").alias("owner"),
    )

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row_id, doc_id, text_hash, text, repo, owner in batch.itertuples(index=False):
                found = scan_text(text) if text else []
                n = [sum(k == x[0] for x in found) for k in range(3)]
                kept = [{"kind": k, "start": s, "stop": e, "value_start": v, "hash": hashlib.sha256(x.encode()).hexdigest()} for k, s, e, v, x in found]
                out.append((row_id, None if pd.isna(doc_id) else int(doc_id), text_hash, *n, _spans(x for x in found if x[0] < 3), kept, repo, owner))
            yield pd.DataFrame(out, columns=["row_id", "doc_id", "text_hash", "n_assign", "n_access", "n_hex", "base_spans", "found", "repo", "owner"]).astype({"doc_id": "Int64"})

    scanned = materialise(source.mapInPandas(rows, SCAN_SCHEMA + ", repo string, owner string"), "secrets")
    each = scanned.where(F.size("found") > 0).select("row_id", "repo", "owner", F.explode("found").alias("c")).select("row_id", "repo", "owner", "c.*")
    # one row per hash, repository and owner first, so that a value in thousands of documents is counted from few rows
    pairs = each.select("hash", F.coalesce("repo", F.lit("")).alias("repo"), F.coalesce("owner", F.lit("")).alias("owner")).distinct()
    ownership = pairs.groupBy("hash").agg(F.countDistinct("repo").alias("n_repos"), F.countDistinct("owner").alias("n_owners"))
    return scanned, ownership.withColumn("live", (F.col("n_owners") <= MAX_OWNERS) & (F.col("n_repos") <= MAX_REPOS))


def repository(docs: DataFrame, source_col: str = "source", lang_col: str = "lang") -> Column:
    """The nearest thing to a repository that a table of documents has: one owner's (source's) documents in one language."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (source_col, lang_col) if c in docs.columns]
    return F.concat_ws("/", *parts)


def find_secrets(docs: DataFrame, **columns: Column | str) -> DataFrame:
    """Per row: row_id, doc_id, counts of the base kinds, base_spans, and findings: all spans with hash, owners and verdict.

    Base findings stay whatever their ownership; a generic one is a finding only if live-looking.
    """
    scanned, ownership = scan(docs, **columns)
    each = scanned.where(F.size("found") > 0).select("row_id", F.explode("found").alias("c")).select("row_id", "c.*")
    judged = each.join(ownership, "hash").where((F.col("kind") < 3) | F.col("live"))
    one = F.struct("start", "kind", "stop", "value_start", "hash", "n_repos", "n_owners", "live")
    per_row = judged.groupBy("row_id").agg(F.sort_array(F.collect_list(one)).alias("findings"))
    return scanned.drop("found", "repo", "owner").join(per_row, "row_id", "left")


def span_string(findings: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(findings, lambda f: F.concat_ws(":", F.get(kinds, f["kind"]), f["start"].cast("string"), f["stop"].cast("string")))
    return F.coalesce(F.array_join(parts, ","), F.lit(""))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]", **keys: Column | str) -> DataFrame:
    """docs with the value of every live-looking finding replaced by mark; widely copied examples stay as they are.

    Rows are matched by id and text, so repeated rows are all redacted. All columns pass through.
    """
    found = find_secrets(docs, id_col=id_col, text_col=text_col, **keys)
    live = F.transform(F.filter("findings", lambda f: f["live"]), lambda f: F.struct(f["value_start"].alias("a"), f["stop"].alias("b")))
    cuts = found.where(F.exists("findings", lambda f: f["live"])).select(F.col("doc_id").alias("cut_id"), F.col("text_hash").alias("cut_hash"), live.alias("cuts"))
    cuts = cuts.groupBy("cut_id", "cut_hash").agg(F.first("cuts").alias("cuts"))
    rows = packed(docs, id=F.col(id_col).cast("long"), hash=F.xxhash64(text_col), text=F.col(text_col))
    rows = rows.join(cuts, F.col("id").eqNullSafe(F.col("cut_id")) & (F.col("hash") == F.col("cut_hash")), "left")

    def piece(start: Column, length: Column) -> Column:
        return F.substring(F.col("text"), start.cast("int") + 1, length.cast("int"))

    def step(z: Column, c: Column) -> Column:
        # overlapping values (a hex string inside an assignment) merge: a cut starts only where the one before has ended
        cut = F.struct(F.concat(z["out"], piece(z["at"], c["a"] - z["at"]), F.lit(mark)).alias("out"), c["b"].alias("at"))
        return F.when(c["a"] >= z["at"], cut).otherwise(F.struct(z["out"].alias("out"), F.greatest(z["at"], c["b"]).alias("at")))

    first = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    clean = F.aggregate("cuts", first, step, lambda z: F.concat(z["out"], piece(z["at"], F.lit(2147483647))))
    return unpacked(rows, docs.columns, **{text_col: F.when(F.col("cuts").isNull(), F.col("text")).otherwise(clean)})
