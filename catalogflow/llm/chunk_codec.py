"""Encoding and decoding by content-defined chunks.

A rolling hash over the bytes of each text sets chunk ends, so equal passages give equal chunks wherever they
stand. Within a task, a chunk is encoded once and its ids are used for every document that holds it; the store is
bounded in bytes and emptied when full. Chunk ends fall inside words, so a chunk keeps only the ids between its
first and last safe cut (a place no token crosses, see ``pieces``). At each join the text from the last
safe cut of one chunk to the first safe cut of a later one is encoded again; a chunk without a safe cut is added to
the window, which grows until both of its ends agree with the ids of the whole text.

Null texts count as empty: no ids, and the checksums of nothing. Repeated rows give repeated rows. Very long texts
are many chunks. An empty table gives no rows. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORKER_CACHES, python_ready, read_table, slices, text_bytes, whole_text
from .pieces import PieceEncoder, encoder

_SAFE = {"word": re.compile(r"[ \n\t]"), "byte": re.compile(r"(?<=\S)(?= \S)")}
_WINDOW = 24
_CODECS: dict[tuple[str, str, int, int], ChunkCodec] = {}
WORKER_CACHES.append(_CODECS)


def chunk_ends(raw: np.ndarray, offsets: np.ndarray, bits: int) -> np.ndarray:
    """Sorted chunk ends of all texts: ends of texts, and places where the rolling hash of the last bytes ends in zeros."""
    gear = np.random.default_rng(20240705).integers(0, 1 << 32, 256, np.uint32)
    value = gear[raw]
    rolled = value.copy()
    for back in range(1, _WINDOW):
        rolled[back:] += value[:-back] << np.uint32(back)
    ends = np.flatnonzero(rolled >> np.uint32(32 - bits) == 0) + 1
    # a cut waits for the next first byte of a character
    for _ in range(3):
        inside = ends < len(raw)
        ends = ends + (inside & ((raw[np.minimum(ends, len(raw) - 1)] & 0xC0) == 0x80))
    return np.unique(np.concatenate([ends, offsets[1:]]))


class ChunkCodec:
    def __init__(self, model: PieceEncoder, bits: int, store_bytes: int):
        self.model, self.bits, self.store_bytes = model, bits, store_bytes
        size = model.tokenizer.get_vocab_size(with_added_tokens=True)
        self.names = np.array([model.tokenizer.id_to_token(i) or "" for i in range(size)], object)
        self.safe = _SAFE[model.style]
        self._clear()

    def _clear(self) -> None:
        self.chunks: dict[bytes, tuple[str, bytes | None, str]] = {}
        self.held = 0

    def _parts(self, text: str) -> tuple[str, str | None, str]:
        """(before the first safe cut, between first and last, after the last); without any: (text, None, '')."""
        first = self.safe.search(text)
        if first is None:
            return text, None, ""
        if self.model.style == "word":
            last = max(text.rfind(" "), text.rfind("\n"), text.rfind("\t"))
        else:
            last = [m.start() for m in self.safe.finditer(text)][-1]
        return text[:first.start()], text[first.start():last], text[last:]

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text."""
        if self.held > self.store_bytes:
            self._clear()
        ends = chunk_ends(raw, offsets, self.bits)
        data = raw.tobytes()
        keys, a = [], 0
        for b in ends.tolist():
            keys.append(data[a:b])
            a = b
        chunks = self.chunks
        new = [k for k in dict.fromkeys(keys) if k not in chunks]
        parts = [self._parts(k.decode("utf-8", "replace")) for k in new]
        ids, lens = self.model.encode([p[1] or "" for p in parts])
        at = 0
        for key, (head, body, tail), n in zip(new, parts, lens.tolist()):
            chunks[key] = (head, None if body is None else ids[at:at + n].tobytes(), tail)
            at += n
            self.held += 2 * len(key) + 4 * n + 300
        # joins: windows of text that no chunk answers for
        plan: list[list[bytes | int]] = []
        windows: list[str] = []
        place, counts = 0, np.searchsorted(ends, offsets, "right")
        starts = np.searchsorted(ends, offsets[:-1], "right")
        stops = np.where(offsets[1:] > offsets[:-1], counts[1:], starts)
        for lo, hi in zip(starts.tolist(), stops.tolist()):
            row: list[bytes | int] = []
            window = ""
            for place in range(lo, hi):
                head, body, tail = chunks[keys[place]]
                window += head
                if body is not None:
                    row += [len(windows), body]
                    windows.append(window)
                    window = tail
            row.append(len(windows))
            windows.append(window)
            plan.append(row)
        ids, lens = self.model.encode(windows)
        stop = np.cumsum(lens)
        begin = ((stop - lens) * 4).tolist()
        stop = (stop * 4).tolist()
        joined = ids.astype("<u4", copy=False).tobytes()
        return [np.frombuffer(b"".join([x if isinstance(x, bytes) else joined[begin[x]:stop[x]] for x in row]), "<u4") for row in plan]

    def decode(self, ids: np.ndarray) -> str:
        """The library's ``decode(ids, skip_special_tokens=False)``: names with blanks between them, or its byte decoder."""
        if self.model.tokenizer.decoder is None:
            return " ".join(self.names[ids].tolist())
        return self.model.tokenizer.decode(ids.tolist(), skip_special_tokens=False)


def codec(path: str, style: str, bits: int, store_bytes: int) -> ChunkCodec:
    key = (path, style, bits, store_bytes)
    if key not in _CODECS:
        _CODECS[key] = ChunkCodec(encoder(path, style), bits, store_bytes)
    return _CODECS[key]


def _digests(path: str, style: str, bits: int, store_bytes: int):
    def run(batches):
        model = codec(path, style, bits, store_bytes)
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for lo, hi in slices(offsets):
                found = model.encode(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array([len(x) for x in found], pa.int64()),
                     pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in found]),
                     pa.array([hashlib.sha256(model.decode(x).encode("utf-8", "surrogatepass")).hexdigest() for x in found])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _ids(path: str, style: str, bits: int, store_bytes: int):
    def run(batches):
        model = codec(path, style, bits, store_bytes)
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for lo, hi in slices(offsets):
                found = model.encode(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array([x.view(np.int32) for x in found], pa.list_(pa.int32())),
                     pa.array([model.decode(x) for x in found], pa.string())], ["doc_id", "ids", "decoded"])
    return run


def encode_documents(docs: DataFrame, path: str, style: str, bits: int = 10, store_bytes: int = 64 << 20) -> DataFrame:
    """doc_id, ids and decoded text of every document; chunks are of 2 ** ``bits`` bytes on average."""
    python_ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        _ids(path, style, bits, store_bytes), "doc_id long, ids array<int>, decoded string")


def encoding_digests(docs: DataFrame, path: str, style: str, bits: int = 10, store_bytes: int = 64 << 20) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document, with no id leaving the Python stage."""
    python_ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        _digests(path, style, bits, store_bytes), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the 49,408-word vocabulary."""
    import public_tokenizers

    return encoding_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), "word")
