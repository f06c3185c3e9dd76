"""Exact tokenizer output from a bounded cache of white-space pieces.

Both vocabularies used here split a text before any merge, and no token crosses a single blank between
two non-blank characters. So a text's ids are the ids of its pieces in a row. Pieces repeat, so each
one is encoded by the tokenizers library once and then looked up.

* ``word`` style (white space is dropped): cut at every blank, tab and line end. Unicode composition and
  lower-casing never look across white space.
* ``byte`` style (a blank belongs to the word after it): cut before a blank or line end that stands alone
  between two non-blank characters. Texts with longer runs of white space are cut only at the single ones.

A new piece of plain characters is cut into its units here and only the merges are left to the library's
model, which saves the library's general pipeline; any other piece takes that pipeline.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

from .common import WORKER_CACHES

_ALONE = re.compile(r"(?<=\S)(?= \S)")
#: How each style cuts a piece into the units that merges work on.
_UNITS = {
    "word": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "byte": r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
}
#: Visible ASCII and Latin-1 letters: every Unicode version cuts, composes and lower-cases these alike.
_PLAIN = re.compile(r"[ \n]?[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_ENCODERS: dict[tuple[str, str], PieceEncoder] = {}
WORKER_CACHES.append(_ENCODERS)


class PieceEncoder:
    """Ids of texts. The cache is emptied when it holds ``max_pieces`` pieces or ``max_chars`` characters."""

    def __init__(self, path: str, style: str, max_pieces: int = 500_000, max_chars: int = 16_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.style, self.max_pieces, self.max_chars = style, max_pieces, max_chars
        self.units = regex.compile(_UNITS[style])
        self.model = self.tokenizer.model
        # The library's spelling of each byte, read off it: two-byte letters give the bytes from 0x80 on.
        shown = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelt = {chr(b): shown(chr(b))[0][0] for b in [10, *range(32, 127), *range(0xC0, 0x100)]}
        self.merged: dict[str, bytes] = {}
        self._clear()

    def _clear(self) -> None:
        self.pending: list[str] = []
        pending = self.pending

        class Index(dict):
            def __missing__(self, piece: str) -> int:
                self[piece] = place = len(self)
                pending.append(piece)
                return place

        self.index, self.chars, self.used = Index(), 0, 0
        self.first = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int32)
        self.odd = np.zeros(1 << 16, bool)
        self.flat = np.zeros(1 << 18, np.uint32)

    def _spell(self, key: str) -> str:
        """The text that a key of the cache stands for."""
        if self.style == "word":
            return key
        return key[2:] if key.startswith("\n\n") else key if key.startswith("\n") else " " + key

    def _is_odd(self, key: str) -> bool:
        """True for a piece next to a longer run of white space: its text must be cut the careful way."""
        if self.style == "word" or key.startswith("\n\n"):
            return False
        body = key[1:] if key.startswith("\n") else key
        return not body or body[0].isspace() or body[-1].isspace()

    def _merge(self, unit: str) -> bytes:
        spelt = unit.replace(" ", self.spelt[" "]).replace("\n", self.spelt["\n"]) if unit.isascii() else "".join(map(self.spelt.__getitem__, unit))
        ids = self.merged[unit] = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
        return ids

    def _encode_new(self, keys: list[str]) -> tuple[list[bytes], np.ndarray]:
        """(ids of each piece as unsigned 32-bit integers, whether its text must be cut the careful way); bytes objects cost the garbage collector nothing."""
        if len(self.merged) > self.max_pieces:
            self.merged.clear()
        word, known, merge, cut = self.style == "word", self.merged.get, self._merge, self.units.findall
        pieces = keys if word else [" " + k if k[:1] != "\n" else self._spell(k) for k in keys]
        found, other = [], []
        for piece, plain in zip(pieces, map(_PLAIN.fullmatch, pieces)):
            if plain is None or "<|" in piece:
                other.append(len(found))
                found.append(b"")
                continue
            if word:
                piece = piece.lower()
            # letters alone are one unit, in the byte style with the blank before them
            if (piece if word or piece[0] != " " else piece[1:]).isalpha():
                found.append(known(piece) or merge(piece))
                continue
            units = cut(piece)
            found.append(b"".join([known(u) or merge(u) for u in units]))
        for k, e in zip(other, self.tokenizer.encode_batch_fast([pieces[k] for k in other], add_special_tokens=False)):
            found[k] = array("I", e.ids).tobytes()
        odd = np.zeros(len(keys), bool)
        for k in other:  # plain pieces have no white space inside
            odd[k] = self._is_odd(keys[k])
        return found, odd

    def _learn(self) -> None:
        keys = list(self.pending)
        self.pending.clear()
        if not keys:
            return
        lo, hi = len(self.index) - len(keys), len(self.index)
        while hi > len(self.count):
            self.first, self.count, self.odd = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count, self.odd))
        for at in range(0, len(keys), 20_000):
            part = keys[at:at + 20_000]
            found, odd = self._encode_new(part)
            lens = np.fromiter(map(len, found), np.int32, len(found)) // 4
            flat = np.frombuffer(b"".join(found), np.uint32)
            while self.used + len(flat) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used:self.used + len(flat)] = flat
            where = slice(lo + at, lo + at + len(part))
            self.count[where] = lens
            self.first[where] = self.used + np.cumsum(lens) - lens
            self.odd[where] = odd
            self.used += len(flat)
            self.chars += sum(map(len, part))
        assert hi == lo + len(keys)

    def _pieces(self, text: str) -> list[str]:
        if self.style == "word":
            return text.replace("\n", " ").replace("\t", " ").split(" ")
        found = text.replace("\n", " \n").split(" ")
        found[0] = "\n\n" + found[0]
        return found

    def places(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(places in the cache of all pieces in a row, number of pieces per text)."""
        self._make_room()
        rows, every = [], []
        for text in texts:
            found = self._pieces(text)
            rows.append(len(found))
            every += found
        at = np.fromiter(map(self.index.__getitem__, every), np.int64, len(every))
        return self._settled(at, np.array(rows, np.int64), texts.__getitem__)

    def _make_room(self) -> None:
        if len(self.index) > self.max_pieces or self.chars > self.max_chars:
            self._clear()

    def _settled(self, at: np.ndarray, rows: np.ndarray, text) -> tuple[np.ndarray, np.ndarray]:
        self._learn()
        if self.style == "byte" and len(at) and (odd := self.odd[at]).any():
            ends = np.cumsum(rows)
            bad = np.unique(np.searchsorted(ends, np.flatnonzero(odd), "right"))
            parts, last = [], 0
            for k in bad.tolist():
                found = ["\n\n" + x for x in _ALONE.split(text(k))]
                parts += [at[last:ends[k] - rows[k]], np.fromiter(map(self.index.__getitem__, found), np.int64, len(found))]
                last, rows[k] = ends[k], len(found)
            at = np.concatenate([*parts, at[last:]])
            self._learn()
        return at, rows

    def _ids(self, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lens = self.count[at].astype(np.int64)
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.first[at] - (ends - lens), lens) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(rows)])]
        return ids, np.diff(bounds)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids per text)."""
        return self._ids(*self.places(texts))


def encoder(path: str, style: str) -> PieceEncoder:
    """One encoder for each Python worker and vocabulary file; its cache serves all tasks of the worker."""
    key = (path, style)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, style)
    return _ENCODERS[key]
