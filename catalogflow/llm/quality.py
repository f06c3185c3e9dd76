"""Quality classifier: a byte convolution over overlapping chunks of the whole text, one probability per document.

Segments of ``segment`` bytes are pooled by maximum; a chunk is two neighbouring segments, so chunks overlap by half and
cover the whole text. A document's features are the largest and the mean rectified answer of every filter over
its chunks; a logistic unit combines them.

The model is fitted on the whole texts of at most ``per_class`` labelled documents of each class (those with the smallest id hash); every document
is scored whole. Rows that repeat a chosen id teach once.
Null and empty texts are a chunk of padding and get a score too. Labels that are null, or of documents that do not
exist, teach nothing; a document labelled twice counts with its larger label. Without labelled rows every score is 0.5. Repeated
rows get equal scores. Columns besides doc_id and text are not read by the score.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytenet import Adam, Filters, lay_out
from .common import held_out, pack_row, python_ready, read_table, release_caches, slices, text_bytes, unpack_row, whole_text

THRESHOLD = 0.3


@dataclass
class QualityModel:
    filters: Filters
    weights: np.ndarray
    bias: np.ndarray
    segment: int

    def _features(self, top: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """Chunk answers and document features from segment maxima."""
        last = np.zeros(len(top), bool)
        last[np.cumsum(count) - 1] = True
        following = np.where(last, np.arange(len(top)), np.minimum(np.arange(len(top)) + 1, len(top) - 1))
        right = top[following] > top
        chunk = np.maximum(np.where(right, top[following], top), 0)
        starts = np.cumsum(count) - count
        most = np.maximum.reduceat(chunk, starts)
        mean = np.add.reduceat(chunk, starts) / count[:, None]
        return chunk, right, following, most, mean

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x, count = lay_out(raw, offsets, self.segment, self.filters.widest)
        top, _ = self.filters.pooled(x, self.segment)
        *_, most, mean = self._features(top, count)
        logit = np.concatenate([most, mean], axis=1).astype(np.float64) @ self.weights + self.bias[0]
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def fit(texts: list[bytes], labels: np.ndarray, *, segment: int = 256, width: int = 5, number: int = 16,
        epochs: int = 12, batch: int = 48, rate: float = 0.02, seed: int = 7) -> QualityModel:
    """The network trained by minibatch gradients; both classes weigh the same."""
    filters = Filters.new((width,), number, seed)
    rng = np.random.default_rng(seed)
    weights = rng.normal(0, 0.1, 2 * number)
    model = QualityModel(filters, weights, np.zeros(1), segment)
    if not len(texts):
        weights[:] = 0
        return model
    positive = labels.mean()
    weight = np.where(labels == 1, 0.5 / max(positive, 1e-9), 0.5 / max(1 - positive, 1e-9))
    steps = Adam([*filters.tables, filters.bias, weights, model.bias], rate, 1e-5)
    for epoch in range(epochs):
        steps.rate = rate * (1 - epoch / epochs)
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            offsets = np.concatenate([[0], np.cumsum([len(texts[k]) for k in pick])])
            x, count = lay_out(np.frombuffer(b"".join(texts[k] for k in pick), np.uint8), offsets, segment, width)
            top, where = filters.pooled(x, segment, places=True)
            chunk, right, following, most, mean = model._features(top, count)
            z = np.concatenate([most, mean], axis=1).astype(np.float64)
            p = 1 / (1 + np.exp(-np.clip(z @ weights + model.bias[0], -40, 40)))
            g = (p - labels[pick]) * weight[pick] / len(pick)
            dz = g[:, None] * weights
            row = np.repeat(np.arange(len(pick)), count)
            is_most = chunk == most[row]
            dchunk = np.where(is_most, dz[row, :number], 0) + dz[row, number:] / count[row][:, None]
            dchunk = np.where(chunk > 0, dchunk, 0)
            dtop = np.where(right, 0, dchunk)
            moved = np.where(right, dchunk, 0)
            np.add.at(dtop, following, moved)
            steps.step([*filters.gradients(x, where, dtop), dtop.sum(axis=0).astype(np.float32), z.T @ g, np.array([g.sum()])])
    return model


def labelled_sample(rows: DataFrame, docs: DataFrame, per_class: int) -> tuple[list[bytes], list]:
    """Whole texts and labels of at most ``per_class`` rows (doc_id, y) of each class, a top-n of ids for each class.

    One text of each id: of rows that share a chosen id the one with the smallest hash. What reaches the driver is bounded by classes times ``per_class`` texts.
    """
    classes = sorted(r["y"] for r in rows.select("y").distinct().collect())
    if not classes:
        return [], []
    rows = reduce(DataFrame.union, [rows.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in classes])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text"))
    # at most per_class rows of two numbers for each class: small by its bound
    sample = texts.join(F.broadcast(rows), "doc_id").groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    found = sample.select("text", "y").orderBy(F.xxhash64("text"), "y").collect()
    return [bytes(r["text"]) for r in found], [r["y"] for r in found]


def train_quality(docs: DataFrame, labels: DataFrame, per_class: int = 800, **settings) -> QualityModel:
    """Model from ``labels`` (doc_id, quality 0 or 1) and their documents."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("y"))
    texts, y = labelled_sample(rows, docs, per_class)
    return fit(texts, np.array(y, np.float64), **settings)


def _score(model: QualityModel):
    def run(batches):
        release_caches()
        for batch in batches:
            raw, offsets = text_bytes(batch.column("_text"))
            for lo, hi in slices(offsets):
                scores = model.score(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([batch.column("_row").slice(lo, hi - lo), pa.array(scores)], ["_row", "_score"])
    return run


def scored(docs: DataFrame, model: QualityModel, keep: list[str] | None = None) -> DataFrame:
    """``_row`` (the columns named, all by default) and ``_score`` of every row."""
    python_ready(docs.sparkSession)
    rows = docs.select(pack_row(docs.select(*keep) if keep else docs), whole_text().alias("_text"))
    kind = rows.schema["_row"].dataType.simpleString()
    return rows.mapInArrow(_score(model), f"_row {kind}, _score double")


def quality_filter(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, with the columns they came with."""
    return unpack_row(scored(docs, model).filter(F.col("_score") >= threshold), docs.columns)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; rows of the held-out fold teach nothing."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = train_quality(docs, labels.filter(~held_out(5, 0)))
    rows = scored(docs, model, ["doc_id"])
    return rows.select(F.col("_row.doc_id").alias("doc_id"), F.col("_score").alias("score")).select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
