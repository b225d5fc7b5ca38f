"""Token ids of whole texts by the tokenizers library, with a bounded memory of pieces.

A tokenizer with a byte-level or word pre-tokenizer never merges across certain places of a text.
``PieceEncoder`` cuts a chunk of texts there (in Arrow), remembers the ids of the pieces it met lately,
lets the library encode the others, and lays the pieces' ids together (in numpy); the result equals the
library's on the whole text: that of ``encode(text, add_special_tokens=False)``, which turns the literal of a special
token that stands in a text into that token's id. Texts with such a literal, and all texts of a tokenizer whose cutting
rule is not recognised, are given to the library whole.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters beside which a single space or line feed always ends a piece of the byte-level pattern.
_FIRM = "[!-~À-ɏ]"
_FIRM_ONE = frozenset(filter(re.compile(_FIRM).match, map(chr, range(0x250))))
#: A word of plain letters, perhaps with one mark behind it: two pre-tokens at most, whatever stands around.
_WORDISH = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)")
_FIRM_SPACE = re.compile(f"(?<={_FIRM}) (?={_FIRM})")


def byte_letters() -> dict:
    """Translation of latin-1 decoded bytes to the letters that stand for them in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the characters from 256 on, in order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PieceEncoder:
    """``encode(texts)`` gives one bytes value a text: its ids, little-endian, of ``dtype``."""

    def __init__(self, path: str, remembered: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.remembered = remembered
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.rule = cutting_rule(spec)
        self.literals = [t["content"] for t in spec.get("added_tokens") or []]
        #: Pieces and their ids: with rule ``space`` a piece owns the space before it, or starts with a line feed.
        self.known: dict = {}
        self.older: dict = {}  # the generation before: what is still in use moves over
        self.mark = {"space": "\x0b", "white": " \x01 "}.get(self.rule, "")
        self.letters = byte_letters()
        self.space = self.letters[32]
        self.feed = array(self.code, self._plain("\n")).tobytes() if self.rule == "space" else b""
        self.behind = {m: array(self.code, self._plain(m)).tobytes() if m else b"" for m in ("", *".,;:!?")}
        self.mark_id = self._plain(self.mark.strip() or self.mark) if self.mark else []

    def _plain(self, text: str) -> list:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, pieces: list) -> None:
        """Ids of pieces that are cut surely.

        A plain word is a pre-token by itself and goes to the library's model directly; others go
        through the whole tokenizer, some in one call where the marks between them can be told.
        """
        known, spaced = self.known, self.rule == "space"
        rest, words, marks, get, code = [], _WORDISH.fullmatch, self.behind, known.get, self.code
        tokenize = self.tokenizer.model.tokenize
        for p in pieces:
            found = words(p)
            if found is None:
                rest.append(p)
                continue
            word, mark = found.groups()
            ids = get(word) if mark else None
            if ids is None:
                ids = array(code, [t.id for t in tokenize(self._as_letters(word))]).tobytes()
            known[p] = ids + marks[mark]
        for lo in range(0, len(rest), 64):
            part = rest[lo : lo + 64]
            texts = [p if not spaced else p[1:] if p[0] == "\n" else " " + p for p in part]
            if len(self.mark_id) == 1:
                got = array(self.code, self._plain(self.mark.join(texts))).tobytes()
                at = (np.flatnonzero(np.frombuffer(got, self.dtype) == self.mark_id[0]) * self.dtype.itemsize).tolist()
                if len(at) == len(texts) - 1:
                    starts = [0, *[a + self.dtype.itemsize for a in at]]
                    known.update((p, (self.feed if spaced and p[0] == "\n" else b"") + got[a:b]) for p, a, b in zip(part, starts, [*at, len(got)]))
                    continue
            for p, got in zip(part, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                known[p] = (self.feed if spaced and p[0] == "\n" else b"") + array(self.code, got.ids).tobytes()

    def _as_letters(self, word: str) -> str:
        """A plain word as the model's vocabulary writes it."""
        plain = word.isascii()
        if self.rule == "white":
            word = word.lower()
        if not plain:
            word = word.encode().decode("latin-1").translate(self.letters)
        return self.space + word if self.rule == "space" else word

    def _whole(self, text: str) -> bytes:
        return array(self.code, self._plain(text)).tobytes() if text else b""

    def _cut(self, texts: pa.Array) -> pa.Array:
        if self.rule == "white":
            return pc.ascii_split_whitespace(texts)
        # A line feed starts a piece, and the first piece of a text is made one that follows a line feed.
        return pc.split_pattern(pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), ""), " ")

    def _encode(self, texts: pa.Array) -> list:
        cut, size = self._cut(texts), self.dtype.itemsize
        spaced = self.rule == "space"
        pieces = cut.flatten().dictionary_encode()
        offsets = cut.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        unique, which = pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy()
        ids = list(map(self.known.get, unique))
        new = [i for i, v in enumerate(ids) if v is None]
        bad = []
        if new:
            learn = []
            for i in new:
                p = unique[i]
                if p in self.older:
                    self.known[p] = self.older[p]
                elif not p:
                    bad.append(i)
                elif spaced and not (p[p[0] == "\n" :] and p[p[0] == "\n"] in _FIRM_ONE and p[-1] in _FIRM_ONE):
                    bad.append(i)
                else:
                    learn.append(p)
            self._learn(learn)
            for i in new:
                ids[i] = self.known.get(unique[i], b"")
        flat = np.frombuffer(b"".join(ids), self.dtype)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // size
        first = np.cumsum(sizes) - sizes
        lengths = sizes[which]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        data = flat[np.repeat(first[which] - (ends - lengths), lengths) + np.arange(total)].tobytes()
        at = np.concatenate(([0], ends))[offsets] * size
        skip = len(self.feed) if spaced else 0
        out = [data[a + skip : b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        if spaced and bad:
            # A line feed or space of unknown effect stands in these texts: the library gets them whole.
            odd = np.zeros(len(unique), bool)
            odd[bad] = True
            hit = np.concatenate(([0], np.cumsum(odd[which])))[offsets]
            for i in np.flatnonzero(hit[1:] > hit[:-1]).tolist():
                out[i] = self._whole(texts[i].as_py())
        return out

    def encode(self, texts) -> list:
        """``texts``: an Arrow array of strings or a list; nulls are empty."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if self.rule == "whole":
            return [self._whole(t) for t in texts.to_pylist()]
        collecting = gc.isenabled()
        gc.disable()  # many small objects without cycles are made and kept; walking them finds nothing
        try:
            out = []
            for part in in_chunks(texts):
                if len(self.known) > self.remembered:
                    self.older, self.known = self.known, {}
                done = self._encode(part)
                for literal in self.literals:
                    for i in np.flatnonzero(pc.match_substring(part, literal).to_numpy(zero_copy_only=False)).tolist():
                        done[i] = self._whole(part[i].as_py())
                out += done
            return out
        finally:
            if collecting:
                gc.enable()


def in_chunks(texts: pa.Array, rows: int = 1024, size: int = 6 << 20):
    """Slices of at most ``rows`` texts and, but for single texts, about ``size`` bytes."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        upto = min(at + rows, max(at + 1, int(np.searchsorted(ends, done + size, side="right"))))
        yield texts.slice(at, upto - at)
        at = upto


def cutting_rule(spec: dict) -> str:
    """``space``: pieces own one leading space; ``white``: white space is dropped; else ``whole``."""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if any(t.get("normalized") or t.get("lstrip") or t.get("rstrip") or not t.get("content") for t in spec.get("added_tokens") or []):
        return "whole"
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
        return "space"
    first = (pre.get("pretokenizers") or [{}])[0] if pre.get("type") == "Sequence" else {}
    if first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and "\\s" in str(first.get("pattern")):
        return "white"
    return "whole"


def row_chunks(batch: pa.RecordBatch, column: int, rows: int = 1024, size: int = 4 << 20):
    """Slices of a batch by its texts (``column``); Python objects are made for one slice at a time."""
    at = 0
    for part in in_chunks(pc.fill_null(batch.column(column), ""), rows, size):
        yield batch.slice(at, len(part))
        at += len(part)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder for each Python worker and file; workers are reused by Spark."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def crc_of_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
