"""Curation, joins, reports and lifecycle: against plain Python, also with one hot key."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from catalogflow.operators import aggregates, curate, joins, lifecycle

ORDER = ("source_pos", "page_no", "item_pos")


def rows_of(n: int, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    keys = ["hot"] * (n // 3) + [None, ""] * (n // 12) + [f"k{rng.randrange(n // 4 + 1)}" for _ in range(n // 2)]
    rng.shuffle(keys)
    return [(i % 3, i // 20, i, k) for i, k in enumerate(keys)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "source_pos INT, page_no INT, item_pos INT, key STRING")


def python_first(rows, keep_blank):
    seen, out = set(), []
    for r in sorted(rows):
        if not r[3]:
            if keep_blank:
                out.append(r)
        elif r[3] not in seen:
            seen.add(r[3])
            out.append(r)
    return sorted(out, key=str)


@pytest.mark.parametrize("blank_keys", ["drop", "keep"])
def test_first_wins_with_hot_key(spark, blank_keys):
    rows = rows_of(600)
    got = curate.first_wins(frame(spark, rows), "key", ORDER, blank_keys)
    assert sorted((tuple(r) for r in got.collect()), key=str) == python_first(rows, blank_keys == "keep")
    again = curate.first_wins(got, "key", ORDER, blank_keys)
    assert again.exceptAll(got).isEmpty() and got.exceptAll(again).isEmpty()


def test_first_wins_cuts_before_the_shuffle(spark):
    plan = curate.first_wins(frame(spark, rows_of(60)), "key", ORDER, "keep")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=80, unique=True))
def test_block_number_equals_row_number(spark, ordinals):
    df = spark.createDataFrame([(o % 3 if o % 7 else None, o) for o in ordinals], "k INT, o BIGINT")
    got = {(r.k, r.o): r.row_no for r in curate.block_number(df, ["k"], "o", shift=4).collect()}
    want = {}
    for key in {k for k, _ in got}:
        for i, o in enumerate(sorted(o for k, o in got if k == key), 1):
            want[(key, o)] = i
    assert got == want and len(got) == len(ordinals)


def test_row_window(spark):
    df = spark.range(100).withColumnRenamed("id", "pos")
    take = lambda o, n: sorted(r.pos for r in curate.row_window(df, "pos", o, n).collect())
    assert take(10, 5) == list(range(10, 15))
    assert take(95, 0) == list(range(95, 100))
    assert take(float("nan"), 3) == [0, 1, 2]
    assert len(take(-1, -1)) == 100


def test_ranks(spark):
    df = spark.createDataFrame([("q", i, u) for i, u in enumerate(["a", "a", "", "", "b", "c"])], "q STRING, pos INT, u STRING")
    after = curate.rank_after_filter(df, ["q"], "u", ["pos"], F.col("pos") > 0, 4).orderBy("rank").collect()
    assert [(r.rank, r.u) for r in after] == [(1, "a"), (2, ""), (3, ""), (4, "b")]
    before = curate.rank_before_filter(df, ["q"], ["pos"], F.col("u") != "", 5).orderBy("rank").collect()
    assert [(r.rank, r.u) for r in before] == [(1, "a"), (2, "a"), (5, "b")]


def test_sort_uses_locale_order(spark):
    df = spark.createDataFrame([("B-2", 5), ("a_1", 5), ("A1", 5), ("b-1", 5), (None, None)], "product_number STRING, final_price_yen BIGINT")
    got = [r.product_number for r in curate.sort_ssd(df).collect()]
    assert got == ["a_1", "A1", "b-1", "B-2", None]


def test_plan_keeps_every_query(spark):
    plan = spark.createDataFrame([("a",), ("b",), ("c",)], "query STRING")
    items = spark.createDataFrame([("a", 1), ("a", 2), ("z", 3)], "query STRING, rank INT")
    got = joins.plan_with_results(plan, items, false_columns=("sponsored",)).collect()
    assert sorted((r.query, r.rank or 0) for r in got) == [("a", 1), ("a", 2), ("b", 0), ("c", 0)]
    assert {r.query for r in got if r.sponsored is False} == {"b", "c"}


def test_stop_after_blocked(spark):
    data = [("r", 0, "ok"), ("r", 1, "blocked"), ("r", 1, "transport_error"), ("r", 2, "ok"), ("s", 0, "blocked"), ("s", 0, "ok"), ("s", 1, "ok")]
    df = spark.createDataFrame(data, "run STRING, idx INT, status STRING")
    got = sorted((r.run, r.idx) for r in aggregates.stop_after_blocked(df, "run", "idx").collect())
    assert got == [("r", 0), ("r", 1), ("r", 1), ("s", 0), ("s", 0), ("s", 1)]


def test_retention_keeps_newest_stamps_and_covers_listing(spark):
    stamps = [f"2024-01-0{d}_00-00-00" for d in range(1, 7)]
    files = [(f"/o/mem_{s}.{e}", False) for s in stamps for e in ("csv", "jsonl")] + [("/o/notes.csv", False), (f"/o/{stamps[0]}.csv", False)]
    dirs = [(f"/o/{s}", True) for s in stamps] + [("/o/x_" + stamps[0], True)]
    df = spark.createDataFrame(files + dirs, "path STRING, is_dir BOOLEAN")
    marks = lifecycle.retention_marks(df, 2).collect()
    kept = {r.path for r in marks if not r.removable}
    gone = {r.path for r in marks if r.removable}
    assert len(gone) == 4 * 2 + 4 and len(kept) == 2 * 2 + 2 + 1
    assert "/o/x_" + stamps[0] in kept
    assert kept | gone == {p for p, _ in files + dirs} - {"/o/notes.csv", f"/o/{stamps[0]}.csv"}
    assert lifecycle.keep_count(0) == lifecycle.keep_count(float("nan")) == 3 and lifecycle.keep_count(2.9) == 2


def test_upload_and_expiry(spark):
    paths = spark.createDataFrame([("a",), ("a",), ("b",)], "path STRING")
    assert [r.path for r in lifecycle.upload_set(paths, spark.createDataFrame([("a",)], "path STRING")).collect()] == ["a"]
    now = F.lit("2024-03-31 00:00:00").cast("timestamp")
    df = spark.sql("SELECT timestamp'2024-03-01 00:00:00' AS m, false AS d UNION ALL SELECT timestamp'2024-03-02 00:00:01', false UNION ALL SELECT timestamp'2020-01-01 00:00:00', true")
    assert sorted(r[0] for r in df.select(lifecycle.is_expired("m", "d", now)).collect()) == [False, False, True]
