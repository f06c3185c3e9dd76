"""Exact similarity join of documents by the Jaccard measure of their word n-grams, with PartEnum signatures.

1. Sizes fall into bands so narrow that similar sets lie in the same or in neighbouring bands. In a band the similarity bounds the Hamming
   distance of two sets by some k (``band_rule``). Their features are dealt by hash into ``first`` parts; by the pigeonhole one part holds at most
   ``spare`` of the differences. That part is dealt into ``second`` smaller ones, and for every way of leaving out ``spare`` of them
   the features of the others make one signature: sets that are similar enough share at least one, whatever the data. A set signs for its own band and for the next.
2. Equal sets are one node. Nodes with an equal signature form a bucket. Each is compared with two centres of its bucket; buckets that this
   does not connect are gone through pair by pair, dealt as pairs of blocks over many tasks.
3. A pair is first tested by a lower bound of its distance (counts of features per bin, a few bytes per set), then exactly: both sets are moved
   once for the pair and intersected.
4. Classes are the connected components of the links. ``every=True`` gives every link between different sets, not only those that connect.

Nothing is capped. Work that is not proportional to the data: strangers that share a signature (ten features or more, or two thirds of a
small set) are compared by their counts with each other.

Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return, with A to Z lower-cased. Texts of
fewer words than an n-gram have one feature, all their words; null, empty and blank texts have none and link with nothing. Features are 64-bit hashes,
sets are told apart by 128 bits. Repeated rows and rows that share an id are documents each. A class is named by its smallest id; a class without any id has a
null name. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LEAN_BYTES, drop_tables, located, python_ready, read_table, release_caches, slices, stored_table, text_bytes
from .components import components

WORDS, PERCENT = 3, 90
#: Features that a signature should cover, or this share of a smaller set.
COVERED, SHARE = 10, 0.66
#: Members that a task compares with as many others.
BLOCK = 1024
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
SKETCH = "doc_id long, _at struct<file:string,row:long>, n int, node binary, h long, signatures array<long>"
SETS = "h long, node binary, n int, features binary, counts binary"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def hashed_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, number of words per text)."""
    n = len(raw)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    inside = ~_SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], ~inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | np.concatenate([~inside[1:], [True]]))) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
    words = _mix((sums[ends] - sums[starts]) * _powers(_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))
    return words, np.bincount(rows, minlength=len(offsets) - 1)


def feature_sets(raw: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(features of all texts, ascending in each, number per text): the distinct n-grams of ``size`` words."""
    words, counts = hashed_words(raw, offsets)
    number = np.where(counts > 0, np.maximum(1, counts - size + 1), 0)
    text = np.repeat(np.arange(len(counts)), number)
    place = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    at = (np.cumsum(counts) - counts)[text] + place
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    grams = np.zeros(len(text), np.uint64)
    for j in range(size):
        part = _mix(padded[at + j] + np.uint64((2 * j + 1) * _BASE & (1 << 64) - 1))
        grams = grams * np.uint64(0xD6E8FEB86659FD93) + np.where(place + j < counts[text], part, np.uint64(j + 1))
    grams = _mix(grams)
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    return grams[new], np.bincount(text[new], minlength=len(counts))


@cache
def bands(percent: int, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """(smallest, largest size) of the bands up to the one of ``largest`` and the next."""
    low, high = [1], [100 // percent]
    while low[-1] <= largest:
        low.append(high[-1] + 1)
        high.append(low[-1] * 100 // percent)
    return np.array(low), np.array(high)


@cache
def band_rule(percent: int, low: int, high: int) -> tuple[int, int, int]:
    """(first, second, spare) of the signatures of a band whose pairs have sets of at most ``high`` features, the smaller at least ``low * percent / 100``.

    Similar sets a, b differ in at most (|a| + |b|)(100 - percent)/(100 + percent) features. Of all divisions that keep the
    pigeonhole, the one with the fewest signatures whose cover is large enough; (0, 0, 0) where only equal sets are similar.
    """
    k = 2 * high * (100 - percent) // (100 + percent)
    if k == 0:
        return 0, 0, 0
    smallest = max(1, low * percent // 100)
    found = []
    for spare in range(min(k, 4) + 1):
        first = -(-(k + 1) // (spare + 1))
        for second in range(spare + 1, spare + 5):
            cover = smallest / first * (second - spare) / second
            enough = cover >= min(COVERED, SHARE * smallest)
            found.append((not enough, first * math.comb(second, spare) if enough else -cover, (first, second, spare)))
    return min(found)[2]


def _chunks(features: np.ndarray, counts: np.ndarray, first: np.ndarray, second: int, salt: int) -> np.ndarray:
    """Sum of the hashed features in every part of every set, an array of (parts of all sets, second)."""
    base = np.cumsum(first) - first
    h = _mix(features + np.uint64(salt * _BASE & (1 << 64) - 1))
    part = ((h >> np.uint64(32)) * np.repeat(first, counts).astype(np.uint64)) >> np.uint64(32)
    small = ((h & np.uint64(0xFFFFFFFF)) * np.uint64(second)) >> np.uint64(32)
    cell = (np.repeat(base, counts) + part.astype(np.int64)) * second + small.astype(np.int64)
    sums = np.zeros(int(first.sum()) * second, np.uint64)
    np.add.at(sums, cell, _mix(features ^ np.uint64(0xA0761D6478BD642F)))
    return sums.reshape(-1, second)


def signatures(features: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(signatures of all sets one after the other, number per set): those of a set's own band and of the next, where a similar set may lie."""
    low, high = bands(percent, 1 << int(max(1, counts.max(initial=1))).bit_length())
    band = np.searchsorted(low, counts, "right") - 1
    ends = np.cumsum(counts)
    found, owner = [], []
    for tag in np.unique(np.concatenate([band, band + 1])[np.concatenate([counts, counts]) > 0]).tolist():
        first, second, spare = band_rule(percent, int(low[tag]), int(high[tag]))
        which = np.flatnonzero((counts > 0) & ((band == tag) | (band == tag - 1) & (counts * 100 >= percent * low[tag])))
        if not first or not len(which):
            continue
        own = counts[which]
        at = np.repeat(ends[which] - own - (np.cumsum(own) - own), own) + np.arange(own.sum())
        sums = _chunks(features[at], own, np.full(len(which), first), second, 1)
        for number, kept in enumerate(combinations(range(second), second - spare)):
            part = np.tile(np.arange(first, dtype=np.uint64), len(which))
            label = _mix(part * np.uint64(1 << 20) + np.uint64(number) + np.uint64((tag + 1) * _BASE & (1 << 64) - 1))
            found.append(_mix(sums[:, kept].sum(axis=1, dtype=np.uint64) + label))
            owner.append(np.repeat(which, first))
    if not found:
        return np.empty(0, np.uint64), np.zeros(len(counts), np.int64)
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order], np.bincount(owners, minlength=len(counts))


def bin_counts(features: np.ndarray) -> np.ndarray:
    """How many features fall into each of a power of two of bins, at most 255: the differences bound the distance of two sets from below."""
    bins = 1 << min(12, max(5, len(features).bit_length() - 2))
    counts = np.bincount((features >> np.uint64(20)).astype(np.int64) & (bins - 1), minlength=bins)
    return np.minimum(counts, 255).astype(np.uint8)


def _digest(features: np.ndarray) -> bytes:
    return hashlib.blake2b(features.tobytes(), digest_size=16).digest()


def _texts(batches, columns: list[str]):
    """(lower bound, upper bound of a slice of rows, features, number per row, batch) of slices of bounded text."""
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        for lo, hi in slices(offsets, LEAN_BYTES):
            yield [batch.column(c).slice(lo, hi - lo) for c in columns], raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]


def _sketch(size: int, percent: int):
    def run(batches):
        release_caches()
        for kept, raw, offsets in _texts(batches, ["doc_id", "_at"]):
            features, counts = feature_sets(raw, offsets, size)
            keys, number = signatures(features, counts, percent)
            ends = np.cumsum(counts).tolist()
            nodes = [_digest(features[b - a:b]) for a, b in zip(counts.tolist(), ends)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(counts.astype(np.int32)), pa.array(nodes, pa.binary()), pa.array(np.array([int.from_bytes(x[:8], "little", signed=True) for x in nodes], np.int64)),
                 pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(number)]).astype(np.int32), pa.array(keys.view(np.int64)))],
                ["doc_id", "_at", "n", "node", "h", "signatures"])
    return run


def _sets(size: int):
    def run(batches):
        release_caches()
        for kept, raw, offsets in _texts(batches, ["h", "node"]):
            features, counts = feature_sets(raw, offsets, size)
            own = [features[b - a:b] for a, b in zip(counts.tolist(), np.cumsum(counts).tolist())]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(counts.astype(np.int32)), pa.array([x.tobytes() for x in own], pa.binary()), pa.array([bin_counts(x).tobytes() for x in own], pa.binary())],
                ["h", "node", "n", "features", "counts"])
    return run


def _folded(counts: np.ndarray, bins: int) -> np.ndarray:
    return counts.reshape(-1, bins).sum(axis=0, dtype=np.int32)


def _near(percent: int):
    """Of pairs (a, b, n, m, their counts) those whose distance the counts do not rule out."""
    def run(batches):
        for batch in batches:
            good = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n", "m", "a_counts", "b_counts"))):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                bins = min(len(x), len(y))
                good.append(int(np.abs(_folded(x, bins) - _folded(y, bins)).sum()) * (100 + percent) <= (n + m) * (100 - percent) or max(n, m) > 255 * bins)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))
    return run


def _intersect(percent: int):
    def run(batches):
        for batch in batches:
            keep, both = [], []
            for x, y in zip(batch.column("a_features").to_pylist(), batch.column("b_features").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                joint = len(np.intersect1d(x, y, assume_unique=True))
                both.append(joint)
                keep.append(100 * joint >= percent * (len(x) + len(y) - joint))
            rows = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(both, pa.int64())], ["a", "b", "joint"])
            yield rows.filter(pa.array(keep, pa.bool_()))
    return run


def _inside(percent: int):
    """From members in order of their blocks: pairs (a, b) of different roots that sizes and counts do not rule out."""
    names = ("key", "p", "q")

    def pairs(parts):
        table = pa.Table.from_batches(parts)
        h, n, side, root = (table.column(c).to_numpy() for c in ("h", "n", "side", "root"))
        n, crossing = n.astype(np.int64), table.column("p")[0].as_py() != table.column("q")[0].as_py()
        counts = [np.frombuffer(x, np.uint8) for x in table.column("counts").to_pylist()]
        bins = min(map(len, counts))
        matrix = np.stack([_folded(x, bins) for x in counts])
        left, right = [], []
        for i in range(len(h) - 1):
            rest = np.arange(i + 1, len(h))
            good = (root[rest] != root[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))
            rest = rest[good & (side[rest] != side[i]) if crossing else good]
            if not len(rest):
                continue
            least = np.abs(matrix[rest] - matrix[i]).sum(axis=1)
            rest = rest[(least * (100 + percent) <= (n[rest] + n[i]) * (100 - percent)) | (np.maximum(n[rest], n[i]) > 255 * bins)]
            left.append(np.full(len(rest), h[i]))
            right.append(h[rest])
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches):
        held, block = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in names]
            new = np.zeros(batch.num_rows, bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                now = tuple(c[lo] for c in columns)
                if block is not None and now != block:
                    yield pairs(held)
                    held = []
                block = now
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield pairs(held)
    return run


def _both(pairs: DataFrame, sets: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The pairs with columns of either side's set, ``a_`` and ``b_`` before their names."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("h").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side)
    return pairs


def _linked(pairs: DataFrame, sets: DataFrame, percent: int, folders: list[str]) -> DataFrame:
    """Of pairs (a, b) of hashes the similar ones as (a, b, joint) with the nodes' full digests, stored."""
    near = _both(pairs, sets, ("n", "counts")).select("a", "b", F.col("a_n").alias("n"), F.col("b_n").alias("m"), "a_counts", "b_counts")
    near = stored_table(near.mapInArrow(_near(percent), "a long, b long").distinct(), "near", folders)
    whole = _both(near, sets, ("node", "features")).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"), "a_features", "b_features")
    return stored_table(whole.mapInArrow(_intersect(percent), "a binary, b binary, joint long"), "linked", folders)


def _links(docs: DataFrame, nodes: DataFrame, percent: int, size: int, every: bool, block: int, folders: list[str]) -> DataFrame:
    spark = nodes.sparkSession
    entries = nodes.select(F.explode("signatures").alias("key"), "h", "n")
    shared = entries.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).filter("lo != hi")
    shared = stored_table(shared, "shared", folders)
    members = stored_table(entries.join(shared, "key"), "members", folders)
    # the sets of all that share a signature, read from their texts once
    wanted = nodes.join(members.select("h").distinct(), "h", "left_semi").select("_at", "h", "node")
    texts = docs.select("_at", "text").join(wanted, "_at").select("h", "node", "text")
    sets = stored_table(texts.mapInArrow(_sets(size), SETS), "sets", folders)
    links, roots = None, sets.select("h", F.col("h").alias("root"))
    if not every:
        stars = members.select("h", F.explode(F.array("lo", "hi")).alias("c")).filter("h != c").select(F.least("h", "c").alias("a"), F.greatest("h", "c").alias("b"))
        links = _linked(stars.distinct(), sets, percent, folders)
        named = components(links.select("a", "b"), folders).withColumnRenamed("root", "r")
        first = F.conv(F.hex(F.substring("r", 1, 8)), 16, -10).cast("long")
        roots = stored_table(sets.join(named, "node", "left").select("h", F.coalesce(first, F.col("h")).alias("root")), "roots", folders)
    # buckets that are not connected yet; of those with the same members the one with the smallest key
    rooted = members.select("key", "h", "n").join(roots.groupBy("h").agg(F.min("root").alias("root")), "h")
    apart = rooted.groupBy("key").agg(
        F.count(F.lit(1)).alias("m"), F.expr("bit_xor(xxhash64(h))").alias("x"), F.expr("bit_xor(xxhash64(h, 1))").alias("y"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    apart = apart.filter("lo != hi" if every else "m > 2 AND lo != hi").groupBy("m", "x", "y").agg(F.min("key").alias("key"))
    apart = apart.select("key", F.ceil(F.col("m") / block).cast("int").alias("g"))
    rooted = rooted.join(apart, "key").join(sets.groupBy("h").agg(F.first("counts").alias("counts")), "h")
    rooted = stored_table(rooted.withColumn("at", F.expr("cast(pmod(xxhash64(h, 7), g) AS int)")), "apart", folders)
    cost = rooted.agg(F.coalesce(F.sum(F.col("g") * F.col("g") / F.lit(1.0)), F.lit(0.0))).first()[0]
    dealt = rooted.select("*", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("other")).select(
        "key", F.least("at", "other").alias("p"), F.greatest("at", "other").alias("q"), (F.col("at") <= F.col("other")).alias("side"), "h", "n", "root", "counts")
    # a number of partitions that goes with the pairs of blocks, so that small blocks with many comparisons are not merged by their bytes
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(20_000, int(cost / (4 * block))))
    dealt = dealt.repartition(parts, "key", "p", "q").sortWithinPartitions("key", "p", "q")
    pairs = stored_table(dealt.mapInArrow(_inside(percent), "a long, b long").distinct(), "pairs", folders)
    more = _linked(pairs, sets, percent, folders)
    return more if links is None else links.union(more)


def _sketched(docs: DataFrame, percent: int, size: int, folders: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with their place; doc_id, node and n of every row; one row per node with its signatures). Sketches go as soon as both are stored."""
    spark, own = docs.sparkSession, []
    python_ready(spark)
    placed = located(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", "_at", "text")
    sketched = stored_table(placed.mapInArrow(_sketch(size, percent), SKETCH), "sketches", own)
    rows = stored_table(sketched.select("doc_id", "node", "n"), "rows", folders)
    nodes = sketched.filter("n > 0").groupBy("node").agg(
        F.first("h").alias("h"), F.first("n").alias("n"), F.min("_at").alias("_at"), F.first("signatures").alias("signatures"))
    nodes = stored_table(nodes, "nodes", folders)
    drop_tables(spark, own)
    return placed, rows, nodes


def jaccard_join(docs: DataFrame, percent: int = PERCENT, size: int = WORDS, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(every link between different sets, documents with their set): (a, b, joint) and (doc_id, node, n); documents without a word have no node."""
    folders: list[str] = []
    placed, rows, nodes = _sketched(docs, percent, size, folders)
    links = stored_table(_links(placed, nodes, percent, size, True, block, folders).distinct(), "links")
    rows = stored_table(rows.select("doc_id", F.when(F.col("n") > 0, F.col("node")).alias("node"), "n"), "documents")
    drop_tables(docs.sparkSession, folders)
    return links, rows


def jaccard_components(docs: DataFrame, percent: int = PERCENT, size: int = WORDS, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id that links lead to) of every row. Stored; steps on the way are dropped."""
    folders: list[str] = []
    placed, rows, nodes = _sketched(docs, percent, size, folders)
    links = _links(placed, nodes, percent, size, False, block, folders)
    roots = components(links.select("a", "b"), folders)
    rows = rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "node")
    some = rows.filter("n_shingles > 0").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = some.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = some.join(named, "root").select("doc_id", "n_shingles", "component_id")
    out = out.union(rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    out = stored_table(out, "components")
    drop_tables(docs.sparkSession, folders)
    return out


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and class of every document: links from 90 % of three-word shingles in common."""
    return jaccard_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = r"""
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM words
), kinds AS (SELECT md5(array_to_string(list_sort(s), chr(10))) AS kind, len(s) AS n, min(doc_id) AS least, any_value(s) AS s FROM sets WHERE len(s) > 0 GROUP BY ALL),
grams AS (SELECT kind, n, unnest(s) AS g FROM kinds),
pairs AS (
    SELECT a.kind AS a, b.kind AS b FROM grams a JOIN grams b ON a.g = b.g AND a.kind != b.kind AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.kind, b.kind, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
    SELECT kind, kind AS other FROM kinds UNION SELECT reach.kind, pairs.b FROM reach JOIN pairs ON pairs.a = reach.other
), named AS (SELECT reach.kind, min(kinds.least) AS component_id FROM reach JOIN kinds ON kinds.kind = reach.other GROUP BY reach.kind)
SELECT doc_id, len(s)::BIGINT AS n_shingles, CASE WHEN len(s) = 0 THEN doc_id ELSE component_id END AS component_id
FROM sets LEFT JOIN named ON named.kind = md5(array_to_string(list_sort(s), chr(10)))
"""
