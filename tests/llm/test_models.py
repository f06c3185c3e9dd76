"""The two byte networks: gradients, held-out accuracy and every odd input."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from corpus_rows import SF_DIR

from catalogflow.llm import bytenet, language, quality, queries


def layout(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def test_windows_cover_the_whole_text():
    raw, offsets = layout(["", "abc", "x" * 600])
    x, count = bytenet.lay_out(raw, offsets, 256, 5)
    assert count.tolist() == [1, 1, 3]
    rows = np.split(x, np.cumsum(count)[:-1] * 256)
    assert [bytes(r[r < 256].astype(np.uint8)) for r in rows] == [b"", b"abc", b"x" * 600]


def test_pooled_answers_and_gradients():
    filters = bytenet.Filters.new((2, 3), 4, 0)
    raw, offsets = layout(["hello world", "quality" * 20])
    x, _ = bytenet.lay_out(raw, offsets, 32, filters.widest)
    top, where = filters.pooled(x, 32, places=True)
    again, _ = filters.pooled(x, 32)
    assert np.allclose(top, again)
    symbols = np.append(x, [256, 256, 256])
    for w in range(len(top)):
        for f in range(4):
            place = where[w, f]
            assert np.isclose(top[w, f], sum(filters.tables[0][j, symbols[place + j], f] for j in range(2)), atol=1e-5)
            assert np.isclose(top[w, f], max(sum(filters.tables[0][j, symbols[w * 32 + i + j], f] for j in range(2)) for i in range(32)), atol=1e-5)
    gradient = filters.gradients(x, where, np.ones_like(top))
    moved = [t.copy() for t in filters.tables]
    filters.tables = [t + 1e-3 * g for t, g in zip(filters.tables, gradient)]
    later, _ = filters.pooled(x, 32)
    assert later.sum() > top.sum()
    assert all(a.shape == b.shape for a, b in zip(moved, gradient))


def test_a_pattern_late_in_a_long_text_counts():
    clean = ["good plain words in a row " * k for k in range(1, 30)]
    noisy = [t + "$$$ ### " * 20 for t in clean]
    model = quality.fit([t.encode() for t in clean + noisy], np.array([1.0] * 29 + [0.0] * 29), epochs=30)
    long = "good plain words in a row " * 3000
    scores = model.score(*layout([long, long + "$$$ ### " * 400]))
    assert scores[0] > 0.6 and scores[1] < scores[0]


def test_the_sample_is_bounded_by_rows_and_whole_in_text(spark):
    """Rows that repeat a chosen id teach once; long texts teach whole."""
    long = "long words all through " * 5000
    docs = spark.createDataFrame([(k % 40, "a text" + str(k % 40), None) for k in range(4000)] + [(77, long, "x")], "doc_id long, text string, y string")
    rows = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(77, 1)], "doc_id long, y int")
    texts, y = quality.labelled_sample(rows, docs, 100)
    assert len(texts) == 41 and sum(y) == 21 and long.encode() in texts
    assert len(quality.labelled_sample(rows, docs, 5)[0]) == 10
    assert quality.labelled_sample(rows.filter("false"), docs, 5) == ([], [])


@pytest.fixture(scope="module")
def scored(spark):
    frame = queries.QUERIES["op1_quality_classifier"](spark, SF_DIR).toPandas()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas()
    return frame, labels


def test_quality_on_the_held_out_fold(spark, scored):
    frame, labels = scored
    assert len(frame) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert [zlib.crc32(str(i).encode()) % 5 == 0 for i in frame.doc_id] == frame.held_out.tolist()
    assert frame.score.between(0, 1).all() and (frame.predicted == (frame.score >= 0.3)).all()
    joined = frame[frame.held_out].merge(labels, on="doc_id")
    bad, good = joined[joined.quality == 0].score.to_numpy(), joined[joined.quality == 1].score.to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.98
    assert (good >= 0.3).mean() > 0.97 and (bad < 0.3).mean() > 0.8


def test_language_on_the_held_out_fold(spark):
    frame = queries.QUERIES["op2_language_id"](spark, SF_DIR).toPandas()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas()
    assert len(frame) == len(docs)
    assert [zlib.crc32(str(i).encode()) % 3 == 1 for i in frame.doc_id] == frame.held_out.tolist()
    joined = frame[frame.held_out].merge(docs, on="doc_id")
    assert (joined.lang == joined.lang_pred).mean() > 0.97
    assert frame.score.between(0, 1).all()


def test_quality_of_odd_rows(spark, docs, rows, no_docs):
    labels = spark.createDataFrame([(7, 1), (17, 0), (27, 1), (27, 0), (None, 1), (37, None), (999_999, 0)], "doc_id long, quality int")
    model = quality.train_quality(docs, labels, epochs=2)
    found = quality.scored(docs, model, ["doc_id", "text"]).collect()
    assert len(found) == len(rows) and all(0 <= r["_score"] <= 1 for r in found)
    assert len({r["_score"] for r in found if not r["_row"]["text"]}) == 1
    assert quality.scored(no_docs, model).count() == 0
    kept = quality.quality_filter(docs, model, 0.0)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    blank = quality.train_quality(docs, labels.filter("false"))
    assert {r["_score"] for r in quality.scored(docs, blank, ["doc_id"]).collect()} == {0.5}
    assert quality.train_quality(no_docs, labels) is not None
    one = quality.train_quality(docs, labels.filter("quality = 1"), epochs=1)
    assert all(0 <= r["_score"] <= 1 for r in quality.scored(docs, one, ["doc_id"]).collect())


def test_language_of_odd_rows(docs, rows, no_docs):
    model = language.train_language(docs, epochs=1)
    assert model.languages == ["de", "en"]
    found = language.predict_language(docs, model).collect()
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append(t)
    assert len(found) == len(rows)
    for r in found:
        if len(texts[r["doc_id"]]) == 1:
            assert (r["lang_pred"] == "und") == (not language.has_letter(texts[r["doc_id"]][0]))
    assert not any(map(language.has_letter, [None, "", "123 !? ٣", "²"])) and all(map(language.has_letter, ["1a", "漢", "ª"]))
    blank = language.train_language(docs.filter("lang IS NULL"))
    assert {r["lang_pred"] for r in language.predict_language(docs, blank).collect()} == {"und"}
    assert language.predict_language(no_docs, model).count() == 0
