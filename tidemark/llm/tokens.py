"""Whole-text encoding with the tokenizers library, one call of its model per distinct piece of text.

A text in Latin-1 letters is cut into the tokenizer's own pieces by one regular expression, and the ids of every piece are
remembered as little-endian 32-bit bytes, so a text's ids are one join of remembered bytes. Other texts are cut where the
tokenizer can never join two characters (at white space, or before a single space), and the library encodes each new chunk.
Texts for which such cuts are not known to be exact, and those that spell an added token, go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Most pieces a worker remembers: two halves, of which the older one is forgotten when the newer one is full.
MAX_PIECES = 900_000
# Characters of Latin-1 whose letter, number and white-space classes are spelt out below.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_NUMBER = "0-9²³¹¼½¾"
_UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xff]")
_WHITE = re.compile(r"[ \t\n\r]+")
#: Most characters of texts that are cut into pieces at once.
_BATCH = 16_000_000
# Where spaces run on so, a cut before each of them isn't exact: the white space before the last one is one piece.
_LONG_SPACE = re.compile(r"  (?:\s|$)")


@lru_cache(1)
def _byte_letters() -> dict[int, str]:
    """Byte-level tokenizers write each byte as one printable letter: itself, or the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(plain))
    return table


@lru_cache(1)
def _byte_tables() -> tuple[bytes, bytes]:
    """For each Latin-1 character its lower-case form, and its kind: 0 white space, 1 letter, 4 other; 2 number and 3 the end of
    a text stand alone; 8 is for what _UNUSUAL finds."""
    characters = [chr(b) for b in range(256)]
    kinds = ((3, r"\0"), (8, _UNUSUAL), (0, r"[\t\n\r ]"), (1, f"[{_LETTER}]"), (2, f"[{_NUMBER}]"), (4, ""))
    return "".join(map(str.lower, characters)).encode("latin-1"), bytes(next(k for k, p in kinds if re.match(p, c)) for c in characters)


class _Memory(dict):
    """piece -> ids as bytes; a miss asks the older half, then the tokenizer."""

    def __init__(self, encode, most: int | None = None):
        super().__init__()
        self.encode, self.most, self.older = encode, most or MAX_PIECES, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("I", self.encode(piece)).tobytes()
        if len(self) >= self.most // 2:
            self.older = self.copy()
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """encode(text) -> the ids of the whole text as little-endian unsigned 32-bit bytes. plain: added tokens are plain text."""

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        added = spec.get("added_tokens") or []
        self.tokenizer.encode_special_tokens = plain
        self.added = [t["content"] for t in added if not (plain and t.get("special"))]  # a text that spells one is cut there by the library
        pre, norm, model = spec.get("pre_tokenizer") or {}, spec.get("normalizer"), spec.get("model") or {}
        bpe = model.get("type") == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
        bpe = bpe and not any(t.get("normalized") for t in added)  # those are looked for in the normalised text
        self.kind = "whole"
        if bpe and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
            self.kind = "spaced"
            pattern = f" ?[{_LETTER}]+| ?[{_NUMBER}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\\s{_LETTER}{_NUMBER}]+|\\s+(?!\\S)|\\s+"
        elif bpe and _drops_space(pre, norm):
            self.kind = "dropped"
            pattern = f"[{_LETTER}]+|[{_NUMBER}]|'s|'t|'re|'ve|'m|'ll|'d|[^\\s{_LETTER}{_NUMBER}]+"
        if self.kind != "whole":
            self.find = re.compile(pattern).findall
        model, letters = self.tokenizer.model, _byte_letters()

        def of_piece(piece: str) -> list[int]:  # without white space, an ASCII piece is written as it is
            plain = piece.isascii() and self.kind == "dropped"
            return [t.id for t in model.tokenize(piece if plain else piece.encode().decode("latin-1").translate(letters))]

        self.pieces = _Memory(of_piece)
        self.chunks = _Memory(self._library)

    def _library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.kind == "whole" or any(a in text for a in self.added):
            return array("I", self._library(text)).tobytes()
        if not _UNUSUAL.search(text):
            found = self.find(text.lower() if self.kind == "dropped" else text)
            return b"".join(map(self.pieces.__getitem__, found))
        if self.kind == "dropped":
            return b"".join(map(self.chunks.__getitem__, _WHITE.split(text)))
        if "\0" in text or _LONG_SPACE.search(text):
            return array("I", self._library(text)).tobytes()
        return b"".join(map(self.chunks.__getitem__, text.replace(" ", "\0 ").split("\0")))

    def document(self, text: str | None, end_id: int) -> np.ndarray:
        """The ids of one document, end_id last."""
        return np.frombuffer(self.encode(text) + array("I", [end_id]).tobytes(), "<u4")

    def documents(self, texts: Sequence[str | None], end_id: int) -> list[np.ndarray]:
        """document() of each text. Many texts in Latin-1 letters are cut together and each of their different pieces looked up once."""
        out: list[np.ndarray | None] = [None] * len(texts)
        own, size = [], 0
        for k, text in enumerate(texts if self.kind == "dropped" else ()):
            if text and not any(a in text for a in self.added) and "\0" not in text:
                own.append(k)
                size += len(text)
            if own and (size >= _BATCH or k == len(texts) - 1):
                for j, ids in zip(own, self._together([texts[j] for j in own], end_id), strict=True):
                    out[j] = ids
                own, size = [], 0
        return [self.document(text, end_id) if ids is None else ids for text, ids in zip(texts, out, strict=True)]

    def _together(self, texts: list[str], end_id: int) -> Iterator[np.ndarray | None]:
        """None stands for a text with other characters."""
        lower, kinds = _byte_tables()
        try:
            raw = ("\0".join(texts) + "\0").encode("latin-1").translate(lower)
            kind = np.frombuffer(raw.translate(kinds), np.uint8)
            usual = not (kind & 8).any()
        except UnicodeEncodeError:
            usual = False
        if not usual:
            fit = [not _UNUSUAL.search(text) for text in texts]
            done = self._together([text for text, f in zip(texts, fit, strict=True) if f], end_id) if any(fit) else iter(())
            return iter([next(done) if f else None for f in fit])
        new = (kind & 2) > 0
        new[1:] |= kind[1:] != kind[:-1]
        new[0] = True
        letters = np.frombuffer(raw, np.uint8)
        marks = np.flatnonzero((letters == ord("'")) & new)  # those that a piece starts with take letters: 's, 're and the like
        one, two = letters[marks + 1], letters[np.minimum(marks + 2, len(raw) - 1)]
        short = np.isin(one, list(b"stmd"))
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        new[marks[short | long] + 1] = False
        new[marks[short] + 2] = True
        new[marks[long] + 3] = True
        shown = kind > 0
        data = np.frombuffer(raw.translate(None, b" \t\n\r"), np.uint8)
        first = np.flatnonzero(new[shown])
        offsets = np.append(first, len(data)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        _, offsets, characters = coded.dictionary.buffers()
        cuts = np.frombuffer(offsets, np.int32, len(coded.dictionary) + 1).tolist()
        characters = str(characters, "latin-1")
        end, get = array("I", [end_id]).tobytes(), self.pieces.__getitem__
        pieces = (characters[a:b] for a, b in zip(cuts, cuts[1:], strict=False))
        ids = [end if piece == "\0" else get(piece) for piece in pieces]
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) >> 2
        which = coded.indices.to_numpy()
        size = sizes.take(which)
        ends = np.cumsum(size, dtype=np.int32)
        at = np.repeat((np.cumsum(sizes, dtype=np.int32) - sizes).take(which) - ends + size, size)
        at += np.arange(len(at), dtype=np.int32)
        return iter(np.split(np.frombuffer(b"".join(ids), "<u4").take(at), ends[data[first] == 0][:-1]))


def _drops_space(pre: dict, norm: dict | None) -> bool:
    """Lower-cases, and splits so that white space never reaches the model."""
    steps = [s.get("type") for s in (pre.get("pretokenizers") or [])]
    norms = [s.get("type") for s in ((norm or {}).get("normalizers") or [])]
    if steps != ["Split", "ByteLevel"] or norms != ["NFC", "Replace", "Lowercase"]:
        return False
    split, level = pre["pretokenizers"]
    pattern = (split.get("pattern") or {}).get("Regex")
    wanted = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    return (
        pattern == wanted and split.get("behavior") == "Removed" and split.get("invert")
        and not level.get("use_regex") and not level.get("add_prefix_space")
    )


class PieceEncoder:
    """The same for a sentencepiece model that adds a space in front.

    Where no piece holds a space after another character, or a line break, nothing joins across the start of a run of spaces
    or a line break, so the model is asked once for each distinct one with what follows it. A model that rewrites texts is
    asked for each whole text.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        probe = " a  ﬁ ｆ\tÉ é \n x "
        faithful = self.model.normalize(probe) == "▁" + probe.replace(" ", "▁")
        self.cut = faithful and all("▁" not in p.lstrip("▁") and "\n" not in p for p in self.names)
        self.find = re.compile(" +[^ \n]*|\n[^ \n]*").findall
        self.space = self.model.piece_to_id("▁")
        self.pieces = _Memory(self._piece, MAX_PIECES // 2)

    def _piece(self, piece: str) -> list[int]:
        if piece[0] == "\n":
            return self.model.encode(piece)[1:]  # without the space in front
        return self.model.encode(piece[1:]) if len(piece) > 1 else [self.space]  # it puts the first space there itself

    def token_bytes(self) -> list[bytes]:
        """The bytes that each id stands for."""
        byte = [self.model.is_byte(i) for i in range(len(self.names))]
        return [bytes([int(p[3:5], 16)]) if b else p.replace("▁", " ").encode() for p, b in zip(self.names, byte, strict=True)]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.cut or "▁" in text:
            return array("I", self.model.encode(text)).tobytes()
        return b"".join(map(self.pieces.__getitem__, self.find(" " + text)))


@lru_cache(4)
def encoder(path: str, plain: bool = False) -> Encoder:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    return Encoder(path, plain)


@lru_cache(2)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def byte_level_tokens(enc: Encoder) -> list[bytes]:
    """The bytes that each id of a byte-level tokenizer stands for."""
    back = {letter: byte for byte, letter in _byte_letters().items()}
    vocab = enc.tokenizer.get_vocab(with_added_tokens=False)
    out = [b""] * (max(vocab.values(), default=-1) + 1)
    for token, i in vocab.items():
        out[i] = bytes(back[c] for c in token)
    return out


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)
