"""Language identification: byte filters of several widths, max pooling and softmax over fixed-length windows.

Every window of ``window`` bytes gets log-probabilities of the learned languages; a text's language is the one
with the largest mean over all its windows, its score that language's share after softmax of the means.

The model is fitted on the whole texts of at most ``per_class`` documents of each language (those with the smallest id hash); every
text is read whole. A null text, or one without a letter, is ``und`` with
score 0. Rows without a language teach nothing; without any such row every text is ``und``. Ties go to the language that comes first
by name. Repeated rows get equal answers. Columns besides doc_id and text are not read by a prediction.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytenet import PAD, Adam, Filters, lay_out
from .common import held_out, python_ready, read_table, slices, text_bytes
from .quality import labelled_sample

UNKNOWN = "und"
_ASCII_LETTER = re.compile(r"[A-Za-z]")


@dataclass
class LanguageModel:
    languages: list[str]
    filters: Filters
    weights: np.ndarray
    bias: np.ndarray
    window: int

    def predict(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, score) of each text."""
        x, count = lay_out(raw, offsets, self.window, self.filters.widest)
        top, _ = self.filters.pooled(x, self.window)
        logs = _log_softmax(np.maximum(top, 0) @ self.weights + self.bias)
        starts = np.cumsum(count) - count
        mean = _log_softmax(np.add.reduceat(logs, starts, axis=0) / count[:, None])
        best = mean.argmax(axis=1)
        return best, np.exp(mean[np.arange(len(best)), best]).astype(np.float64)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def fit(texts: list[bytes], labels: list[str], *, window: int = 256, widths: tuple[int, ...] = (2, 3, 4), number: int = 8,
        epochs: int = 6, batch: int = 128, rate: float = 0.02, seed: int = 11) -> LanguageModel:
    """The network trained on windows, each with the language of its text."""
    languages = sorted(set(labels))
    filters = Filters.new(widths, number, seed)
    rng = np.random.default_rng(seed)
    weights = rng.normal(0, 0.1, (number * len(widths), max(1, len(languages)))).astype(np.float32)
    model = LanguageModel(languages, filters, weights, np.zeros(max(1, len(languages)), np.float32), window)
    if not languages:
        return model
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    x, count = lay_out(np.frombuffer(b"".join(texts), np.uint8), offsets, window, filters.widest)
    x = x.reshape(-1, window)
    y = np.repeat(np.array([languages.index(k) for k in labels]), count)
    used = (x != PAD).sum(axis=1) >= 16
    x, y = x[used], y[used]
    share = np.bincount(y, minlength=len(languages)) / max(1, len(y))
    weight = 1 / (len(languages) * np.maximum(share, 1e-9))
    steps = Adam([*filters.tables, filters.bias, model.weights, model.bias], rate, 1e-5)
    for epoch in range(epochs):
        steps.rate = rate * (1 - epoch / epochs)
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            flat = x[pick].ravel()
            top, where = filters.pooled(flat, window, places=True)
            hidden = np.maximum(top, 0)
            p = np.exp(_log_softmax(hidden @ model.weights + model.bias))
            p[np.arange(len(pick)), y[pick]] -= 1
            g = (p * weight[y[pick]][:, None] / len(pick)).astype(np.float32)
            dtop = np.where(top > 0, g @ model.weights.T, 0)
            # a filter that hangs over the end of a window would see the next sampled window: leave those places out
            dtop = np.where(where % window <= window - filters.widest, dtop, 0)
            steps.step([*filters.gradients(flat, where, dtop), dtop.sum(axis=0).astype(np.float32), hidden.T @ g, g.sum(axis=0)])
    return model


def train_language(docs: DataFrame, per_class: int = 200, **settings) -> LanguageModel:
    """Model from the text and non-null ``lang`` of ``docs``."""
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("lang").alias("y"))
    texts, y = labelled_sample(rows, docs.filter(F.col("lang").isNotNull()), per_class)
    return fit(texts, y, **settings)


def has_letter(text: str | None) -> bool:
    return text is not None and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def _predict(model: LanguageModel):
    names = np.array(model.languages or [UNKNOWN], object)

    def run(batches):
        for batch in batches:
            text = batch.column("text")
            raw, offsets = text_bytes(text)
            for lo, hi in slices(offsets):
                best, score = model.predict(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                known = np.array([has_letter(t) for t in text.slice(lo, hi - lo).to_pylist()], bool)
                known &= bool(model.languages)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.where(known, names[best], UNKNOWN).tolist(), pa.string()),
                     pa.array(np.where(known, np.clip(score, 0, 1), 0.0))], ["doc_id", "lang_pred", "score"])
    return run


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    python_ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _predict(model), "doc_id long, lang_pred string, score double")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows of the held-out fold teach nothing."""
    docs = read_table(spark, sf_dir, "documents")
    model = train_language(docs.select("doc_id", "text", "lang").filter(~held_out(3, 1)))
    return predict_language(docs, model).select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")
