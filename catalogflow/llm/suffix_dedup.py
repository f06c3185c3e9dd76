"""Removal of passages that occur earlier in the corpus, by external induced sorting of suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (smaller id, or earlier in its document).

1. Every string of that length (a window) belongs to the k-mer in it with the smallest hash. Neighbouring windows with the same k-mer form
   a unit. Equal windows have equal k-mers, so they lie in units of one k-mer. Units with equal bytes (a 64-bit hash besides
   the k-mer's) are settled at once: all but the earliest go. A task settles its own copies before anything is shuffled.
2. A k-mer that is left with one unit repeats nothing. The bytes of all other units are cut from their texts and dealt into shards by
   k-mer. Units of a k-mer that together hold more than ``hot`` bytes are settled window by window, by 128 bits of hash: equal windows have equal
   k-mers, so their earliest is known without sorting. A task settles its own copies first; no bytes of such windows are shuffled.
3. Each shard sorts the suffixes of its units (see ``induced``): its queues go to a scratch file of the task beyond ``queue_bytes``. Runs of
   suffixes with ``length`` bytes in common keep their earliest member.
4. Removed runs meet their document again, which is cut by them.

Null texts count as empty. Null ids come before all others. Rows that share an id are ordered by the hash of their text; such rows with
equal texts count as one document and are cut alike. Texts shorter than ``length`` keep all bytes. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LEAN_BYTES, pack_row, python_ready, read_table, release_caches, slices, stored_table, text_bytes, whole_text
from .induced import repeats
from .near_dedup import _BASE, _mix, _powers

K, PIECE = 32, 1 << 22
#: Bytes of a shard, from which the number of shards follows; about 60 bytes of memory are needed for each. A k-mer whose units hold more than
#: HOT_BYTES would make its shard larger than the others, so its windows are settled by digest.
SHARD_BYTES, HOT_BYTES = 4 << 20, 512 << 10
_SECOND = 0xC2B2AE3D27D4EB4F
UNITS = "settled boolean, kmer long, content long, doc long, tie long, start long, windows int"
MARKS = "settled boolean, kmer long, doc long, tie long, start long, windows int"
WINDOWS = "settled boolean, high long, low long, doc long, tie long, start long, windows int"
#: Windows of hot k-mers that a task holds at a time.
HOT_WINDOWS = 1 << 18
CUTS = "key long, doc long, tie long, start long, body binary"


class Hashes:
    """Hashes of byte ranges in constant time, from prefix sums."""

    def __init__(self, raw: np.ndarray, base: int):
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(base, len(raw)), out=self.sums[1:])
        self.back = _powers(pow(base, -1, 1 << 64), len(raw) + 1)

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return _mix((self.sums[hi] - self.sums[lo]) * self.back[lo])


def units_of(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, first window in raw, number of windows, k-mer hash, content hash) of each unit; at most ``PIECE`` bytes."""
    number = np.maximum(0, np.diff(offsets) - length + 1)
    if not number.sum():
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    k = min(K, length)
    hashes = Hashes(raw, _BASE)
    at = np.arange(len(raw) - k + 1)
    kmers = hashes.of(at, at + k)
    least = (kmers >> np.uint64(24) << np.uint64(24)) | at.astype(np.uint64)
    span, have = length - k + 1, 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    text = np.repeat(np.arange(len(number)), number)
    start = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number) + offsets[:-1][text]
    place = (least[start] & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.ones(len(text), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    windows = np.diff(first, append=len(text))
    begin = start[first]
    content = Hashes(raw, _SECOND).of(begin, begin + windows + length - 1)
    return text[first], begin, windows, kmers[place[first]], content


def _pieces(offsets: np.ndarray, length: int):
    """(rows lo and hi, byte from, byte to) of parts of at most PIECE bytes; parts of one long text overlap by length - 1."""
    for lo, hi in slices(offsets, LEAN_BYTES):
        a, b = int(offsets[lo]), int(offsets[hi])
        if b - a <= PIECE:
            yield lo, hi, a, b
            continue
        while True:
            yield lo, hi, a, min(a + PIECE, b)
            if a + PIECE >= b:
                break
            a += PIECE - length + 1


def _units(length: int):
    def run(batches):
        release_caches()
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            docs = batch.column("doc").to_numpy(zero_copy_only=False)
            ties = batch.column("tie").to_numpy(zero_copy_only=False)
            for lo, hi, a, b in _pieces(offsets, length):
                bounds = np.clip(offsets[lo:hi + 1], a, b) - a
                text, begin, windows, kmer, content = units_of(raw[a:b], bounds, length)
                if not len(text):
                    continue
                doc, tie, start = docs[lo + text], ties[lo + text], begin + a - offsets[lo + text]
                key = _mix(kmer + content * np.uint64(_SECOND))
                order = np.lexsort((start, tie, doc, key))
                same = np.zeros(len(order), bool)
                same[1:] = (kmer[order[1:]] == kmer[order[:-1]]) & (content[order[1:]] == content[order[:-1]]) & (windows[order[1:]] == windows[order[:-1]])
                settled = np.zeros(len(order), bool)
                settled[order] = same
                # settled units only pass through: spread them evenly
                kmer = np.where(settled, _mix(begin.astype(np.uint64) + np.uint64(a)), kmer)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(settled), pa.array(kmer.view(np.int64)), pa.array(content.view(np.int64)), pa.array(doc), pa.array(tie),
                     pa.array(start), pa.array(windows.astype(np.int32))],
                    ["settled", "kmer", "content", "doc", "tie", "start", "windows"])
    return run


def _marks(batches):
    """From units in order: later copies of a unit (settled), and all first ones of k-mers with several different units."""
    names = ["settled", "kmer", "doc", "tie", "start", "windows"]
    waiting = None  # the last first unit seen, if it opened its k-mer; and the key of the last row
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
        settled, n = cols["settled"], batch.num_rows
        prior = {c: np.concatenate([[last[c] if last else 0], cols[c][:-1]]) for c in ("kmer", "content", "windows", "settled")}
        new_kmer = (cols["kmer"] != prior["kmer"]) | (settled != prior["settled"].astype(bool))
        if last is None:
            new_kmer[0] = True
        new_unit = new_kmer | (cols["content"] != prior["content"]) | (cols["windows"] != prior["windows"])
        first = np.flatnonzero(new_unit & ~settled)
        copies = settled | ~new_unit
        opens = new_kmer[first]
        wanted = ~opens
        wanted[:-1] |= ~opens[1:]
        if len(first):
            if waiting is not None and not opens[0]:
                yield pa.RecordBatch.from_arrays([pa.array([waiting[c]], t) for c, t in zip(names, (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()))], names)
            end = first[-1]
            waiting = {c: cols[c][end] for c in names} if opens[-1] else None
            if waiting is not None:
                wanted[-1] = False
        pick = np.zeros(n, bool)
        pick[first[wanted]] = True
        kept = np.flatnonzero(copies | pick)
        yield pa.RecordBatch.from_arrays([pa.array(copies[kept])] + [pa.array(cols[c][kept]) for c in names[1:]], names)
        last = {c: cols[c][-1] for c in ("kmer", "content", "windows", "settled")}


def _cut_units(length: int):
    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            lists = batch.column("units")
            of = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
            inner = lists.flatten()
            start, windows, kmer = (inner.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            a = offsets[of] + start
            b = a + windows + length - 1
            data = raw.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(kmer), batch.column("doc").take(pa.array(of)), batch.column("tie").take(pa.array(of)), pa.array(start),
                 pa.array([data[x:y] for x, y in zip(a.tolist(), b.tolist())], pa.binary())],
                ["key", "doc", "tie", "start", "body"])
    return run


def _hot_windows(length: int):
    """Windows of hot k-mers with their digests: later copies among those held (settled, as runs), and the first of each."""
    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            data = raw.tobytes()
            docs, ties = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tie"))
            lists = batch.column("units")
            unit_of = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
            inner = lists.flatten()
            unit_start, unit_windows = (inner.field(k).to_numpy(zero_copy_only=False) for k in range(2))
            bounds = np.concatenate([[0], np.cumsum(unit_windows, dtype=np.int64)])
            for lo, hi in slices(bounds, HOT_WINDOWS):
                times = unit_windows[lo:hi]
                of = np.repeat(unit_of[lo:hi], times)
                start = np.repeat(unit_start[lo:hi] - bounds[lo:hi], times) + np.arange(bounds[lo], bounds[hi])
                at = offsets[of] + start
                digest = np.frombuffer(b"".join(hashlib.blake2b(data[x:x + length], digest_size=16).digest() for x in at.tolist()), np.int64).reshape(-1, 2)
                high, low = digest[:, 0], digest[:, 1]
                doc, tie = docs[of], ties[of]
                order = np.lexsort((start, tie, doc, low, high))
                settled = np.zeros(len(order), bool)
                settled[order[1:]] = (high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])
                first = np.flatnonzero(~settled)
                # settled windows side by side are one run
                opens = settled.copy()
                opens[1:] &= ~(settled[:-1] & (of[1:] == of[:-1]) & (start[1:] == start[:-1] + 1))
                head = np.flatnonzero(opens)
                number = np.add.reduceat(settled.astype(np.int32), head) if len(head) else np.empty(0, np.int32)
                for flag, rows, count in ((True, head, number), (False, first, np.ones(len(first), np.int32))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), flag)), *[pa.array(x[rows]) for x in (high, low, doc, tie, start)], pa.array(count.astype(np.int32))],
                        ["settled", "high", "low", "doc", "tie", "start", "windows"])
    return run


def _later(batches):
    """From windows in order of digest and place: all but the first of each digest."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        high, low = (batch.column(c).to_numpy() for c in ("high", "low"))
        same = np.zeros(batch.num_rows, bool)
        same[1:] = (high[1:] == high[:-1]) & (low[1:] == low[:-1])
        same[0] = last == (high[0], low[0])
        last = (high[-1], low[-1])
        yield batch.select(["doc", "tie", "start", "windows"]).filter(pa.array(same))


def _sort_shard(length: int, queue_bytes: int):
    def run(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        raw, offsets = text_bytes(table.column("body"))
        sizes = np.diff(offsets)
        doc, tie, start = (table.column(c).to_numpy() for c in ("doc", "tie", "start"))
        text = np.zeros(len(raw) + len(sizes) + 3, np.uint16)
        begin = offsets[:-1] + np.arange(len(sizes))
        text[np.repeat(np.arange(len(sizes)), sizes) + np.arange(len(raw))] = raw.astype(np.uint16) + 1
        found = np.flatnonzero(repeats(text, length, queue_bytes))
        unit = np.searchsorted(begin, found, "right") - 1
        new = np.ones(len(found), bool)
        new[1:] = (np.diff(found) != 1) | (np.diff(unit) != 0)
        head = np.flatnonzero(new)
        run_of = unit[head]
        at = start[run_of] + found[head] - begin[run_of]
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[run_of]), pa.array(tie[run_of]), pa.array(at), pa.array(np.diff(head, append=len(found)).astype(np.int32))],
            ["doc", "tie", "start", "windows"])
    return run


def _remove(batches):
    for batch in batches:
        raw, offsets = text_bytes(batch.column("_text"))
        lists = batch.column("_cuts")
        number = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
        at = np.concatenate([[0], np.cumsum(number)]).tolist()
        inner = lists.flatten()
        lo, hi = inner.field(0).to_numpy(), inner.field(1).to_numpy()
        kept, texts, removed, spans = [], [], [], []
        for k in range(batch.num_rows):
            text = raw[offsets[k]:offsets[k + 1]]
            edge = np.zeros(len(text) + 1, np.int32)
            np.add.at(edge, lo[at[k]:at[k + 1]], 1)
            np.add.at(edge, hi[at[k]:at[k + 1]], -1)
            gone = np.cumsum(edge[:-1]) > 0
            kept.append(text[~gone].tobytes())
            texts.append(kept[-1].decode("utf-8", "ignore"))
            removed.append(int(gone.sum()))
            spans.append(int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), pa.array([hashlib.sha256(x).hexdigest() for x in kept]), pa.array(texts, pa.string()),
             pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())],
            ["_row", "_sha256", "_kept", "_bytes", "_removed", "_spans"])


def repeated_runs(docs: DataFrame, length: int = 100, queue_bytes: int = 128 << 20, hot: int = HOT_BYTES) -> DataFrame:
    """doc, tie, start, windows: runs of windows that also start earlier; ``docs`` has doc, tie, text and no pair twice."""
    units = docs.select("doc", "tie", "text").mapInArrow(_units(length), UNITS)
    units = units.repartition("kmer").sortWithinPartitions("settled", "kmer", "content", "windows", "doc", "tie", "start")
    marks = stored_table(units.mapInArrow(_marks, MARKS), "marks")
    asked = marks.filter("NOT settled")
    crowded = stored_table(asked.groupBy("kmer").agg(F.sum(F.col("windows") + length - 1).alias("bytes")).filter(F.col("bytes") > hot).select("kmer"), "crowded")
    rest = asked.join(crowded, "kmer", "left_anti")
    size = rest.agg(F.coalesce(F.sum(F.col("windows") + length - 1), F.lit(0))).first()[0]

    def texts_of(units: DataFrame) -> DataFrame:
        units = units.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "windows", "kmer")).alias("units"))
        return docs.join(units, ["doc", "tie"]).select("doc", "tie", "text", "units")

    found = marks.filter("settled").select("doc", "tie", "start", "windows")
    if not crowded.isEmpty():
        windows = stored_table(texts_of(asked.join(crowded, "kmer", "left_semi")).mapInArrow(_hot_windows(length), WINDOWS), "windows")
        found = found.union(windows.filter("settled").select("doc", "tie", "start", "windows"))
        later = windows.filter("NOT settled").repartition("high", "low").sortWithinPartitions("high", "low", "doc", "tie", "start")
        found = found.union(stored_table(later.mapInArrow(_later, "doc long, tie long, start long, windows int"), "later"))
    cuts = texts_of(rest).mapInArrow(_cut_units(length), CUTS)
    shards = max(1, -(-size // SHARD_BYTES))
    cuts = cuts.repartition(shards, "key").sortWithinPartitions("doc", "tie", "start")
    runs = stored_table(cuts.mapInArrow(_sort_shard(length, queue_bytes), "doc long, tie long, start long, windows int"), "runs")
    return found.union(runs)


def without_repeats(docs: DataFrame, columns: list[str], length: int = 100, **settings) -> DataFrame:
    """``_row`` (the columns named), ``_sha256`` of the bytes kept, ``_kept`` text, ``_bytes``, ``_removed``, ``_spans`` of every row."""
    python_ready(docs.sparkSession)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    unique = ids.groupBy("doc_id").count().filter("count > 1").isEmpty()
    rows = docs.select(pack_row(docs.select(*columns)), whole_text().cast("binary").alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"))
    rows = rows.withColumn("tie", F.lit(0).cast("long") if unique else F.xxhash64("text"))
    texts = rows.select("doc", "tie", "text")
    runs = repeated_runs(texts if unique else texts.dropDuplicates(["doc", "tie"]), length, **settings)
    cuts = runs.groupBy("doc", "tie").agg(F.collect_list(F.struct(
        F.col("start").alias("a"), (F.col("start") + F.col("windows") + length - 1).alias("b"))).alias("_cuts"))
    joined = rows.withColumnRenamed("text", "_text").join(cuts, ["doc", "tie"], "left")
    kind = rows.schema["_row"].dataType.simpleString()
    return joined.select("_row", "_text", "_cuts").mapInArrow(
        _remove, f"_row {kind}, _sha256 string, _kept string, _bytes long, _removed long, _spans long")


def remove_repeats(docs: DataFrame, length: int = 100, **settings) -> DataFrame:
    """The rows with their text cut; bytes of a character of which a part went go too, ``n_chars`` is counted anew."""
    rows = without_repeats(docs, docs.columns, length, **settings)
    new = {"text": F.col("_kept"), "n_chars": F.length("_kept").cast("long")}
    return rows.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of what is left of every document without its repeated strings of 100 bytes."""
    rows = without_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    return rows.select(F.col("_row.doc_id").alias("doc_id"), F.col("_bytes").alias("n_bytes"), F.col("_removed").alias("n_removed"),
                       F.col("_spans").alias("n_spans"), F.col("_sha256").alias("kept_sha256"))


#: Strings of 100 bytes as hexadecimal text, told apart by their 128-bit digest.
ORACLE = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
places AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS byte, CASE WHEN i + 100 <= n THEN substr(h, 2 * i + 1, 200) END AS str
    FROM (SELECT *, unnest(range(n)) AS i FROM texts)),
judged AS (SELECT doc_id, i, byte, str IS NOT NULL AND row_number() OVER (PARTITION BY md5_number(str) ORDER BY doc_id, i) > 1 AS again FROM places),
covered AS (SELECT doc_id, i, byte, max(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM judged),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM covered),
cut AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
    coalesce(string_agg(byte, '' ORDER BY i) FILTER (NOT gone), '') AS kept FROM runs GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM texts LEFT JOIN cut USING (doc_id)
"""
