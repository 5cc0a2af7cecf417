"""Fill-in-middle: a document is cut into prefix, middle and suffix, and written with the middle last.

Cuts are given in code points, texts lie in UTF-8. The two are converted by a sparse index of exceptions: it holds only the
multibyte characters, their positions and how many bytes more than one they take before each of them; a binary search among
them gives what a position is shifted by, and spans of ASCII are plain arithmetic. One index serves a whole Arrow batch.

Nulls and ties: a null text is empty; a null id counts as an empty string in the hash; equal ids are cut by equal hashes, each
row on its own. Empty texts, and texts that hold a marker, stay plain. An empty table gives none. Other columns are kept; those
named like a new column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_CUT = "struct<n: long, prefix_chars: long, middle_chars: long, prefix_bytes: long, middle_bytes: long, output: string>"


class ExceptionIndex:
    """The multibyte characters of UTF-8 bytes."""

    def __init__(self, data: np.ndarray):
        self.at_byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.at_byte]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate([np.zeros(1, np.int64), np.cumsum(excess)])  # excess bytes before the k-th one
        self.at_char = self.at_byte - self.before[:-1]

    def to_bytes(self, chars: np.ndarray) -> np.ndarray:
        """Byte positions of code point positions."""
        return chars + self.before[np.searchsorted(self.at_char, chars)]

    def to_chars(self, places: np.ndarray) -> np.ndarray:
        """Code point positions of byte positions at which a character starts or the bytes end."""
        return places - self.before[np.searchsorted(self.at_byte, places)]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array without nulls, and where each text starts (and the last ends)."""
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def cut_batch(texts: pa.Array, h1: np.ndarray, h2: np.ndarray, plain: np.ndarray, spm: np.ndarray) -> pa.StructArray:
    """texts without nulls. The prefix ends after the smaller of h1 and h2 mod (n + 1) code points, the middle after the larger."""
    if not len(texts):
        return pa.array([], pa.struct([(k, pa.int64()) for k in ("n", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes")] + [("output", pa.string())]))
    data, bounds = _bytes_of(texts)
    index = ExceptionIndex(data)
    first = index.to_chars(bounds)
    n = np.diff(first)
    one, two = h1 % (n + 1), h2 % (n + 1)
    left, right = np.minimum(one, two), np.maximum(one, two)
    a, b = index.to_bytes(first[:-1] + left), index.to_bytes(first[:-1] + right)
    raw, out = data.tobytes(), []
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    for start, i, j, end, as_is, suffix_first in zip(bounds[:-1].tolist(), a.tolist(), b.tolist(), bounds[1:].tolist(), plain.tolist(), spm.tolist(), strict=True):
        if as_is:
            out.append(raw[start:end])
        elif suffix_first:
            out.append(b"".join((s, raw[j:end], p, raw[start:i], m, raw[i:j])))
        else:
            out.append(b"".join((p, raw[start:i], s, raw[j:end], m, raw[i:j])))
    cuts = [pa.array(np.where(plain, 0, v), mask=plain) for v in (left, right - left, a - bounds[:-1], b - a)]
    return pa.StructArray.from_arrays([pa.array(n), *cuts, pa.array(out, pa.binary()).cast(pa.string())], names=["n", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes", "output"])


def _cut(texts: pa.Array, h1: pa.Array, h2: pa.Array, plain: pa.Array, spm: pa.Array) -> pa.Array:
    flat = (x.to_numpy(zero_copy_only=False) for x in (h1, h2, plain, spm))
    return cut_batch(texts, *flat)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """docs and form (plain, psm: prefix, suffix, middle, or spm: suffix, prefix, middle), n, prefix_chars, middle_chars (code
    points), prefix_bytes, middle_bytes and output. The forms and cuts follow from a hash of seed and id."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    p = packed(docs, _text=text, _digest=digest)
    h = [F.conv(F.substring("_digest", 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("_text", F.lit(marker))
    p = p.select("row", "_text", h[0].alias("_h1"), h[1].alias("_h2"), ((F.col("_text") == "") | marked | (h[2] % 100 >= 100 - plain_percent)).alias("_plain"), (h[3] % 100 < spm_percent).alias("_spm"))
    p = p.withColumn("_cut", F.arrow_udf(_cut, _CUT)("_text", "_h1", "_h2", "_plain", "_spm"))
    form = F.when(F.col("_plain"), "plain").when(F.col("_spm"), "spm").otherwise("psm")
    new = {k: F.col(f"_cut.{k}") for k in ("n", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes", "output")}
    return unpacked(p, docs.columns, form=form, **new)


def restored(output: Column, form: Column) -> Column:
    """The text again. No part holds a marker and no marker overlaps itself, so each marker's first place is its own."""
    mark = len(PREFIX)
    rest = F.substring(output, mark + 1, 2**31 - 1)
    second = F.when(form == "psm", SUFFIX).otherwise(PREFIX)
    one = F.when(form == "psm", F.substring_index(rest, SUFFIX, 1)).otherwise(F.substring_index(rest, PREFIX, 1))
    after = F.substr(rest, F.length(one) + F.length(second) + 1)
    two = F.substring_index(after, MIDDLE, 1)
    middle = F.substr(after, F.length(two) + mark + 1)
    whole = F.when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))
    return F.when(form == "plain", output).otherwise(whole)
