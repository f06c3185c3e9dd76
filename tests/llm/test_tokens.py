"""Encoders, token files, chunk codec and packing against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from catalogflow.llm import chunk_codec, packing, token_output
from catalogflow.llm.common import shared_folder
from catalogflow.llm.pieces import PieceEncoder

FILES = {"word": public_tokenizers.path("word_bpe_49k.json"), "byte": public_tokenizers.path("byte_bpe_50k.json")}
ODD = ["a", "b", "É", "'s", "'ll", " ", "  ", "\n", "\n\n", "\t", "\r\n", "1", "23", ".", "<|endoftext|>", "\x1c", "\x85", " ", "é", "é", " ́",
       "Σ", "İ", "ß", "漢字", "　", "🙂", "!", "<|startoftext|>", "​", "ﬁ", "×", "_", "word", "Wörter,"]


@pytest.fixture(scope="module", params=["word", "byte"])
def style(request):
    return request.param


@pytest.fixture(scope="module")
def library(style):
    return Tokenizer.from_file(FILES[style])


def mixed(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(14))) for _ in range(n)] + ["", " ", "\n", " a", "a ", "\n\n"]


def test_pieces_give_the_ids_of_the_library(style, library):
    texts = mixed(6000)
    model = PieceEncoder(FILES[style], style, max_pieces=700)  # small: the cache is emptied on the way
    for at in range(0, len(texts), 500):
        part = texts[at:at + 500]
        ids, lens = model.encode(part)
        ends = np.cumsum(lens)
        assert [ids[e - n:e].tolist() for e, n in zip(ends, lens)] == [e.ids for e in library.encode_batch_fast(part, add_special_tokens=False)]


def test_chunks_give_the_ids_of_the_library(style, library):
    rng = random.Random(3)
    shared = "".join(rng.choice(ODD) for _ in range(400))
    texts = [*mixed(300, 2), *["".join(rng.choice(ODD) for _ in range(300)) + shared + "tail" for _ in range(20)], "x" * 5000, "no-blank-" * 900]
    for bits in (3, 6, 10):
        model = chunk_codec.ChunkCodec(PieceEncoder(FILES[style], style), bits, 50_000)
        for _ in range(2):
            raw = [t.encode() for t in texts]
            found = model.encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
            expected = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
            assert [f.tolist() for f in found] == expected
            assert [model.decode(f) for f in found] == [library.decode(e, skip_special_tokens=False) for e in expected]


def test_equal_passages_share_chunks():
    rng = np.random.default_rng(0)
    passage = rng.integers(97, 123, 20_000).astype(np.uint8)
    a, b = (np.concatenate([rng.integers(97, 123, n).astype(np.uint8), passage]) for n in (301, 77))
    chunks = [Counter(np.diff(chunk_codec.chunk_ends(x, np.array([0, len(x)]), 8), prepend=0).tolist()) for x in (a, b)]
    assert sum((chunks[0] & chunks[1]).values()) > 40


def ids_of(text, end=None, style="word"):
    ids = Tokenizer.from_file(FILES[style]).encode(text or "", add_special_tokens=False).ids
    return np.array(ids + ([] if end is None else [end]), "<u4")


def test_digests_of_the_codec(docs, rows, no_docs):
    library = Tokenizer.from_file(FILES["word"])
    found = Counter(tuple(r) for r in chunk_codec.encoding_digests(docs, FILES["word"], "word").collect())
    expected = Counter()
    for doc_id, text, *_ in rows:
        ids = ids_of(text)
        decoded = library.decode(ids.tolist(), skip_special_tokens=False)
        expected[(doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())] += 1
    assert found == expected
    assert chunk_codec.encoding_digests(no_docs, FILES["word"], "word").count() == 0
    row = chunk_codec.encode_documents(docs, FILES["word"], "word").filter("doc_id = 7").first()
    assert row["ids"] == ids_of(rows[0][1]).tolist()


def test_token_files_round_trip(spark, docs, rows, no_docs):
    folder = shared_folder(spark, "test-tokens")
    token_output.write_tokens(docs, folder, FILES["byte"], "byte", 0)
    found = [tuple(r) for r in token_output.token_index(spark, folder).orderBy("start").collect()]
    assert [r[0] for r in found] == sorted([r[0] for r in rows], key=lambda i: (i is not None, i or 0))
    sizes = Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in ((r[0], ids_of(r[1], 0, "byte")) for r in rows))
    assert Counter((r[0], r[2], r[3]) for r in found) == sizes
    assert [r[1] for r in found] == np.concatenate([[0], np.cumsum([r[2] for r in found])[:-1]]).tolist()
    part = token_output.read_tokens(spark, folder, ["doc_id", "ids"], 20, 60)
    assert {r["doc_id"] for r in part.collect()} == {r[0] for r in rows if r[0] and 20 <= r[0] <= 60}
    assert "ids" not in token_output.read_tokens(spark, folder, ["doc_id", "n_tokens"])._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    empty = shared_folder(spark, "test-tokens")
    token_output.write_tokens(no_docs, empty, FILES["byte"], "byte", 0)
    assert token_output.token_index(spark, empty).count() == 0


def test_token_files_are_laid_out_as_asked(spark, docs):
    import pyarrow.parquet as pq

    folder = shared_folder(spark, "test-layout")
    token_output.write_tokens(docs, folder, FILES["byte"], "byte", 0)
    paths = [p.removeprefix("file:") for p in spark.read.parquet(folder).inputFiles()]
    group = pq.ParquetFile("/" + paths[-1].lstrip("/")).metadata.row_group(0)
    columns = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
    assert columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index


def best_fit_decreasing(lengths, capacity):
    """Number of sequences that the classical rule needs, piece by piece."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fit = [k for k, gap in enumerate(gaps) if gap >= length]
        if fit:
            gaps[min(fit, key=gaps.__getitem__)] -= length
        else:
            gaps.append(capacity - length)
    return len(gaps)


def test_packing_places_every_piece_once(docs, rows, no_docs):
    capacity = 256
    found = packing.pack(docs, FILES["word"], "word", 1, capacity).toPandas()
    expected = Counter()
    total = 0
    for doc_id, text, *_ in rows:
        ids = ids_of(text, 1)
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start:start + capacity]
            expected[(doc_id, piece, start, len(part), zlib.crc32(part.tobytes()))] += 1
    ids = [None if x != x else int(x) for x in found.doc_id]
    assert Counter(zip(ids, found.piece, found.start, found.length, found.ids_crc32)) == expected
    found = found.sort_values(["sequence_id", "offset"])
    assert (found.groupby("sequence_id").length.cumsum() - found.length == found.offset).all()
    assert found.groupby("sequence_id").length.sum().max() <= capacity
    assert -(-total // capacity) <= found.sequence_id.nunique() <= best_fit_decreasing(found.length.tolist(), capacity)
    assert packing.pack(no_docs, FILES["word"], "word", 1, capacity).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_each_piece_once_and_fills_up(seed):
    rng = np.random.default_rng(seed)
    capacity = 64
    counts = rng.integers(0, 30, capacity + 1) * (rng.random(capacity + 1) < 0.5)
    counts[0] = 0
    length, first, number, sequence, offset = packing.packing_plan(counts, capacity)
    assert (np.bincount(length, number, capacity + 1) == counts).all()
    level, used = Counter(), {}
    for l, f, n, s, o in zip(length.tolist(), first.tolist(), number.tolist(), sequence.tolist(), offset.tolist()):
        used.setdefault(l, []).append((f, n))
        for q in range(s, s + n):
            level[q] += l
    assert max(level.values(), default=0) <= capacity
    for l, parts in used.items():
        assert [f for f, _ in sorted(parts)] == np.concatenate([[0], np.cumsum([n for _, n in sorted(parts)])[:-1]]).tolist()
    lengths = np.repeat(np.arange(capacity + 1), counts).tolist()
    assert -(-sum(lengths) // capacity) <= len(level) <= 1.01 * best_fit_decreasing(lengths, capacity)


def test_plan_prefers_exact_complements():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 25, 15, 50, 30, 20]] = [3, 1, 1, 1, 1, 1, 2]
    *_, sequence, _ = packing.packing_plan(counts, 100)
    # 60+40, 60+25+15, 60+20+20 are full; 50+30 is left
    assert len(np.unique(sequence)) == 4
