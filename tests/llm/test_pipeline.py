"""The corpus pipeline stage by stage."""

from __future__ import annotations

from collections import Counter
from pathlib import Path
from urllib.parse import urlparse

import pyarrow.parquet as pq
import pytest
from corpus_rows import SF_DIR

import corpus_pipeline
from catalogflow.llm import common


def test_stages_follow_each_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows, counts = docs, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / name)
        stage(spark, rows, SF_DIR).write.parquet(out)
        rows = spark.read.parquet(out)
        counts.append(rows.count())
        if k < 4:
            assert rows.columns == docs.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    passed = {r["doc_id"] for r in spark.read.parquet(str(tmp_path / "quality")).select("doc_id").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in passed for i in good) / len(good) > 0.99
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i not in passed for i in bad) / len(bad) > 0.9
    exact = [r["text"].lower() for r in spark.read.parquet(str(tmp_path / "exact")).collect()]
    assert len(set(exact)) == len(exact)
    assert counts[0] > counts[1] > counts[2] > counts[3] == counts[4] <= counts[5]
    suffix = {r["doc_id"] for r in spark.read.parquet(str(tmp_path / "suffix")).select("doc_id").collect()}
    assert suffix == {r["doc_id"] for r in rows.select("doc_id").collect()}


def test_stages_take_odd_rows(spark, docs, no_docs, tmp_path):
    sf_dir = str(tmp_path)
    spark.createDataFrame([(7, 1, 0), (17, 0, 0), (27, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    for frame in (docs, no_docs):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            found = stage(spark, frame, sf_dir)
            assert k == 4 or found.schema == frame.schema
            assert found.count() >= (0 if frame is no_docs else 1)


@pytest.mark.parametrize("name", ["exact", "near"])
def test_stages_are_stable(spark, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    a, b = (Counter((r["doc_id"], r["text"]) for r in stage(spark, docs, "").collect()) for _ in range(2))
    assert a == b


@pytest.mark.parametrize("name", ["exact", "near"])
def test_stages_leave_no_copy_of_the_texts(spark, docs, name):
    root = Path(urlparse(common.shared_folder(spark, "any")).path).parent
    before = set(root.iterdir()) if root.exists() else set()
    dict(corpus_pipeline.STAGES)[name](spark, docs, "").count()
    left = [f for folder in set(root.iterdir()) - before for f in folder.rglob("*.parquet") if f.is_file()]
    assert left and not any("text" in pq.read_schema(f).names for f in left)
