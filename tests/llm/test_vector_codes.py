"""Dual-tree Lloyd against plain loops."""

from __future__ import annotations

import numpy as np
import pytest

from catalogflow.llm import vector_codes


def lloyd(x: np.ndarray, parts: int, entries: int, rounds: int):
    """(codes, errors, codebooks) of whole-number rows, entry by entry."""
    x = x.reshape(len(x), parts, -1).astype(object)
    book = [[x[k, p].copy() for k in range(min(entries, len(x)))] for p in range(parts)]

    def nearest(p):
        return [min(range(len(book[p])), key=lambda e: (int(((row - book[p][e]) ** 2).sum()), e)) for row in x[:, p]]

    for _ in range(rounds):
        for p in range(parts):
            own = nearest(p)
            for e in range(len(book[p])):
                rows = [x[k, p] for k in range(len(x)) if own[k] == e]
                if rows:
                    book[p][e] = np.array([sum(c) // len(rows) for c in zip(*rows)], object)
    codes = np.array([nearest(p) for p in range(parts)]).T
    errors = [sum(int(((x[k, p] - book[p][codes[k, p]]) ** 2).sum()) for p in range(parts)) for k in range(len(x))]
    return codes, errors, book


@pytest.mark.parametrize("rows,width,entries,block", [(300, 32, 64, 64), (40, 16, 64, 2048), (500, 48, 5, 130), (1, 16, 64, 16), (90, 20, 7, 33)])
def test_against_loops(spark, monkeypatch, rows, width, entries, block):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", block)
    rng = np.random.default_rng(rows)
    x = rng.normal(size=(rows, width)).round(1) * 0.05
    x[rows // 2:] = x[: rows - rows // 2]  # ties and repeated rows
    frame = spark.createDataFrame([(1000 - k, x[k].tolist(), k % 3 if k % 4 else None) for k in range(rows)], "vec_id long, embedding array<double>, label int")
    coded, book = vector_codes.compressed(frame.repartition(3), entries=entries)
    filled = -(-width // 16) * 16
    whole = np.zeros((rows, filled), np.int64)
    whole[:, :width] = np.floor(x * 256)
    codes, errors, want = lloyd(whole[::-1], 16, entries, 2)
    assert book.tolist() == [[e.tolist() for e in p] for p in want]
    got = {r.vec_id: (r.code, r.error) for r in coded.collect()}
    assert got == {1000 - (rows - 1) + k: ("".join(f"{c:02x}" for c in codes[k]), errors[k]) for k in range(rows)}


def test_walk_prunes_and_agrees():
    """Sums and counts from whole nodes equal those of the rows, on clustered data, where most rows go with a whole node."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-5000, 5000, (4, 20, 6))
    own = rng.integers(0, 20, (4, 1000))
    points = (np.take_along_axis(centres, own[:, :, None], axis=1) + rng.integers(-20, 20, (4, 1000, 6))).astype(np.int32)
    tree = vector_codes.grown(points, 16)
    sums, counts, near = vector_codes.walked(tree, centres, True)
    distance = ((points[:, :, None].astype(np.int64) - centres[:, None]) ** 2).sum(axis=3)
    want = distance.argmin(axis=2)
    assert (np.take_along_axis(want, tree["order"].astype(np.int64), axis=1) == near).all()
    for p in range(4):
        for e in range(20):
            assert counts[p, e] == (want[p] == e).sum() and (sums[p, e] == points[p][want[p] == e].sum(axis=0)).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [0.5] * 32
    rows = [(5, good, 1), (5, good, 1), (None, good, None), (1, None, 2), (2, [nan] * 32, 2), (3, [inf] + [0.0] * 31, 2), (4, [None] + [0.0] * 31, 2), (6, [], 1),
            (7, [1.0], 1), (8, [1e30, -1e30] * 16, 3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "'x' AS code", "0 AS error")
    coded, book = vector_codes.compressed(frame)
    got = sorted(((r.vec_id, r.code, r.error) for r in coded.collect()), key=str)
    assert [g[0] for g in got] == [5, 5, 8, None] and {g[2] for g in got} == {0}
    assert book.shape == (16, 4, 2) and abs(book).max() == 1 << 26
    empty, none = vector_codes.compressed(frame.filter("false"))
    assert empty.count() == 0 and none.size == 0
    with pytest.raises(ValueError):
        vector_codes.compressed(frame, entries=257)


def test_query_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = vector_codes.op12_vector_codes(spark, str(tmp_path))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and got.count() == 0
