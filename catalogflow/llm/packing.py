"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

The plan is made on the histogram of piece lengths (at most ``capacity`` numbers, however large the corpus):
for the longest length that is left, the gap to the capacity is filled exactly by one, two or three lengths
found through sums under their remaining counts; what has no exact complement takes the longest length that
fits, again and again. Each decision covers as many sequences as the counts allow. Documents are then matched
to the plan by their ordinal among pieces of their length, which is a count per stored part plus the counts of
the parts before it: no length, however common, meets in one task.

Null and empty texts give one piece, the end id alone. Rows that share an id are packed each on their own. Very long texts
are cut into full pieces and a rest. An empty table gives no rows. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import python_ready, read_table, slices, stored_table, text_bytes, whole_text
from .pieces import encoder
from .token_output import with_end

PIECES = "part int, nth long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, style: str, end_id: int, capacity: int):
    def run(batches):
        model, part = encoder(path, style), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            text = batch.column("text")
            _, offsets = text_bytes(text)
            for lo, hi in slices(offsets):
                ids, lens = with_end(*model.encode(text.slice(lo, hi - lo).to_pylist()), end_id)
                first = np.cumsum(lens) - lens
                pieces = -(-lens // capacity)
                row = np.repeat(np.arange(hi - lo), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(lens[row] - start, capacity)
                data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                at = (first[row] + start) * 4
                sums = [zlib.crc32(data[a:a + 4 * n]) for a, n in zip(at.tolist(), length.tolist())]
                # ordinal of each piece among those of its length in this part
                order = np.argsort(length, kind="stable")
                heads = np.flatnonzero(np.diff(length[order], prepend=-1))
                nth = np.empty(len(row), np.int64)
                nth[order] = np.arange(len(row)) - np.repeat(heads, np.diff(heads, append=len(row)))
                nth += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), part, np.int32)), pa.array(nth), batch.column("doc_id").slice(lo, hi - lo).take(pa.array(row)),
                     pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(sums, pa.int64())],
                    ["part", "nth", "doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def token_pieces(docs: DataFrame, path: str, style: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces of at most ``capacity`` ids with their checksum and their ordinal among pieces of equal length."""
    python_ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return rows.mapInArrow(_cut(path, style, end_id, capacity), PIECES)


def packing_plan(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, ...]:
    """(length, first ordinal, number, first sequence, offset) of each step, sorted by length and ordinal.

    ``counts[l]`` is the number of pieces of length l. A step says: pieces of ``length`` with ordinals from
    ``first ordinal`` on, ``number`` of them, go one each into sequences from ``first sequence`` on at ``offset``.
    """
    left, used = counts.astype(np.int64).copy(), np.zeros(capacity + 1, np.int64)
    left[0] = 0
    steps: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def exact(gap: int) -> list[int] | None:
        """One, two or three lengths that sum to the gap, the longest first."""
        if left[gap]:
            return [gap]
        have = left[:gap + 1] > 0
        low = np.arange(1, gap // 2 + 1)
        pairs = low[have[low] & have[gap - low] & ((low * 2 != gap) | (left[low] > 1))]
        if len(pairs):
            return [gap - int(pairs[0]), int(pairs[0])]
        for a in np.flatnonzero(have)[::-1].tolist():
            if a * 3 < gap:
                break
            rest = gap - a
            low = np.arange(max(1, rest - a), rest // 2 + 1)
            ok = have[low] & have[rest - low]
            for b in low[ok].tolist():
                combination = [a, rest - b, b]
                if all(left[x] >= combination.count(x) for x in combination):
                    return combination
        return None

    def take(bins: int, lengths: list[int], first: int, offset: int) -> None:
        for x in lengths:
            steps.append((x, int(used[x]), bins, first, offset))
            used[x] += bins
            left[x] -= bins
            offset += x

    def fill(bins: int, first: int, level: int) -> None:
        """Fill ``bins`` sequences that all hold ``level`` ids: exact complements while they last, then best fit."""
        work = [(bins, first, level)]
        while work:
            bins, first, level = work.pop()
            gap = capacity - level
            if not gap or not bins:
                continue
            lengths = exact(gap)
            if lengths is None:
                fit = np.flatnonzero(left[:gap + 1])
                if not len(fit):
                    continue
                lengths = [int(fit[-1])]
            times = min(bins, *(int(left[x]) // lengths.count(x) for x in lengths))
            take(times, lengths, first, level)
            work.append((bins - times, first + times, level))
            work.append((times, first, level + sum(lengths)))

    for length in range(capacity, 0, -1):
        # sequences led by this length; a length may also complete its own kind, so counts are read again
        while left[length]:
            bins, gap = int(left[length]), capacity - length
            own = gap // length
            if own:
                bins = max(1, bins // (own + 1))
            first = sequences
            take(bins, [length], first, 0)
            sequences += bins
            fill(bins, first, length)
    plan = np.array(sorted(steps), np.int64).reshape(-1, 5)
    return tuple(plan.T)


def _place(plan: tuple[np.ndarray, ...], capacity: int):
    length, first, _, sequence, offset = plan
    span = 1 + max(int(first.max(initial=0)), 1)
    keys = length * span + np.minimum(first, span - 1)

    def run(batches):
        for batch in batches:
            size = batch.column("length").to_numpy(zero_copy_only=False)
            nth = batch.column("ordinal").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, size * span + np.minimum(nth, span - 1), "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(sequence[at] + nth - first[at]), pa.array(offset[at])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, path: str, style: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    spark = docs.sparkSession
    pieces = stored_table(token_pieces(docs, path, style, end_id, capacity), "pieces")
    by_part = pieces.groupBy("part", "length").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = by_part.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    plan = packing_plan(counts, capacity)
    rows = pieces.join(by_part, ["part", "length"]).withColumn("ordinal", F.col("before") + F.col("nth"))
    python_ready(spark)
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "ordinal").mapInArrow(
        _place(plan, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4,096 tokens."""
    import public_tokenizers

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), "word", 1, 4096)
