"""Nearest neighbours and sharding."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from corpus_rows import SF_DIR
from pyspark.sql import functions as F

from catalogflow.llm import neighbours, queries, sharding


def test_recall_against_brute_force(spark):
    found = queries.QUERIES["op4_nearest_neighbours"](spark, SF_DIR).toPandas()
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").toPandas()
    ids, x = table.vec_id.to_numpy(), np.stack(table.embedding).astype(float)
    norms = np.sqrt((x * x).sum(axis=1))
    hits = total = 0
    for query, part in found.sort_values("rank").groupby("query_id"):
        at = np.flatnonzero(ids == query)[0]
        score = (x * x[at]).sum(axis=1) / (norms * norms[at])
        others = np.flatnonzero(ids != query)
        best = others[np.lexsort((ids[others], -score[others]))][:5]
        hits += len(set(ids[best]) & set(part.vec_id))
        total += 5
        assert part["rank"].tolist() == [1, 2, 3, 4, 5]
        assert np.allclose(part.score, [score[np.flatnonzero(ids == v)[0]] for v in part.vec_id], atol=1e-12)
    assert found.query_id.nunique() == (ids % 50 == 0).sum()
    assert hits / total >= 0.9


@pytest.mark.parametrize("size", [10, 400])
def test_odd_vectors(spark, monkeypatch, size):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 64)
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=8).round(3).tolist(), "x") for k in range(size)]
    same = [1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    rows += [(1000 + k, same, None) for k in range(7)]
    rows += [(2000, None, None), (2050, [0.0] * 8, None), (2100, [float("nan")] + [1.0] * 7, None), (2150, [None] + [1.0] * 7, None),
             (2200, [float("inf")] + [1.0] * 7, None), (None, same, None), (2250, [], None), (2300, [1.0, 2.0], None), (2301, [2.0, 4.1], None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    found = neighbours.nearest(frame, F.col("vec_id") % 50 == 0, 5).collect()
    by = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    assert by[1000] [:5]== [1001, 1002, 1003, 1004, 1005]
    assert by[2300] == [2301]
    assert not {2000, 2050, 2100, 2150, 2200, 2250} & (set(by) | {v for x in by.values() for v in x})
    assert all(q not in vs for q, vs in by.items())
    assert neighbours.nearest(frame.filter("false"), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_rows_that_share_the_querys_id_are_candidates(spark):
    rows = [(50, [1.0, 0.0]), (50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 1.0])]
    found = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 50, 5).orderBy("rank").collect()
    # the query is the smallest vector of its id, [0, 1]; only its own row is left out
    assert [(r["vec_id"], round(r["score"], 3)) for r in found] == [(1, 0.707), (50, 0.0), (50, 0.0)]


def test_fewer_candidates_than_asked(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    found = [tuple(r) for r in neighbours.nearest(frame, F.col("vec_id") == 0, 5).orderBy("rank").collect()]
    assert [r[:3] for r in found] == [(0, 1, 2), (0, 2, 1)]
    assert found[0][3] == pytest.approx(2 ** -0.5) and found[1][3] == 0


def test_table_is_full_even_and_stable():
    names = [f"s{k}" for k in range(10)]
    table = sharding.lookup_table(names, 1009)
    counts = Counter(table)
    assert set(counts) == set(range(10)) and max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 9)
    assert moved / 1009 < 0.15
    assert sharding.lookup_table(["one"], 2) == [0, 0]
    for bad in ((names, 1000), ([], 7), (names, 7)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_turns_by_hand():
    names, size = ["a", "b", "c"], 13
    orders = []
    for name in names:
        d = hashlib.md5(name.encode()).hexdigest()
        orders.append([(int(d[:8], 16) % size + j * (int(d[8:16], 16) % (size - 1) + 1)) % size for j in range(size)])
    table = {}
    while len(table) < size:
        for k in range(3):
            if len(table) < size:
                table[next(s for s in orders[k] if s not in table)] = k
    assert sharding.lookup_table(names, size) == [table[s] for s in range(size)]


def test_placement_of_odd_rows(spark, docs, rows, no_docs, tmp_path):
    placed = sharding.place(docs, F.col("doc_id"), sharding.SHARDS, sharding.SLOTS)
    assert placed.columns == [*docs.columns, "slot", "shard"]
    table = sharding.lookup_table(sharding.SHARDS, sharding.SLOTS)
    found = placed.collect()
    assert len(found) == len(rows)
    for r in found:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:8], 16) % sharding.SLOTS
        assert (r["slot"], r["shard"]) == (slot, sharding.SHARDS[table[slot]])
    assert sharding.place(no_docs, F.col("doc_id"), sharding.SHARDS, sharding.SLOTS).count() == 0
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    folder = str(tmp_path / "shards")
    sharding.write_shards(docs, F.col("doc_id"), sharding.SHARDS[:3], 13, folder, 2)
    assert spark.read.parquet(folder).count() == len(rows)
