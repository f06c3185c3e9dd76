"""Near-duplicate groups by order MinHash over five-word k-mers, verified by banded alignment of words.

1. One pass reads every text: lower-cased words, their digest, and for each of ``TABLES`` tables the k-mers (labelled
   by occurrence) with the smallest hashes, kept in text order, as a key of two k-mers. ``SINGLE`` more tables have the one smallest
   three-word k-mer as a key; texts of at most ``SHORT`` words also have the smallest two-word k-mers.
2. Texts with equal words are one node. Nodes with an equal key form a bucket: under a third of the keys each is compared with the centre of
   its bucket, the smallest node, which buckets of the same texts mostly share. A bucket (of any key) whose members are not all connected by then is
   gone through pair by pair (``_settle``), matched members included. Pairs that are connected already, or that a bound from their
   lengths or from counts of their words (half a byte a word) rules out, are not aligned; of the others each distinct pair is, and its texts are moved
   once for it: first a few of each text, then the pairs that those have not connected. Large buckets are dealt as pairs of blocks over many tasks.
   Words are not stored: a node keeps the place of one of its rows, and pairs fetch the text there, whose words are hashed again.
   A size class of a bucket with more than ``NEAREST`` such pairs a member gives no pairs: its members' words meet in tasks (``_join``), which align
   what is not connected yet, nearest first, and give links alone, fewer than members. A pair of several such buckets belongs to one of them.
3. A link needs an edit similarity of ``SIMILARITY`` or more: 1 - edit distance in words / length of the longer text.
   The alignment is banded: it keeps to the diagonals that this allows, as bit vectors, after a bound from the words in common.
4. Groups are the connected components of the links.

Null texts count as empty. Texts without a word count as one word, their own bytes; texts of fewer than five
words have one k-mer, all their words. Of a group the smallest id stays, null ids last; of rows that share it, the smallest locator.
Repeated rows fall into one group. An empty table gives no rows. Other columns are carried along unread.
Words are runs of ASCII letters and digits, ``_`` and all bytes beyond ASCII. Texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import (
    LEAN_BYTES, drop_tables, from_files, located, pack_row, python_ready, read_table, release_caches, slices, stored_table, text_bytes, unpack_row,
    whole_text,
)
from .components import components

K, TABLES, LEVELS, SIMILARITY = 5, 10, (2, 3, 4), 0.8
#: Keys of one k-mer: their number of words, their tables, and the most words of a text that has keys of two words too.
SINGLE_K, SINGLE, SHORT_K, SHORT = 3, 20, 2, 48
#: Members of a bucket that a task compares with as many others.
BLOCK = 1024
#: Candidates of a text that are aligned before the others, those with the most words in common; with more than these a member, words meet instead of pairs.
NEAREST = 4
#: Members, and words, of a bucket with many candidates that a task aligns with as many others.
DENSE_BLOCK, DENSE_WORDS = 512, 4 << 20
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
SKETCH = "doc_id long, _at struct<file:string,row:long>, node binary, h long, n int, counts binary, keys array<long>"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, number of words per text); a text without a word has one, all its bytes."""
    n = len(raw)
    inside = _WORD[raw]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[(offsets[1:] - 1)[offsets[1:] > 0]] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    bare = np.setdiff1d(np.arange(len(offsets) - 1), rows)
    if len(bare):
        rows = np.concatenate([rows, bare])
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        starts = np.concatenate([starts, offsets[bare]])[order]
        ends = np.concatenate([ends, offsets[bare + 1]])[order]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
    back = _powers(_INVERSE, n + 1)
    return _mix((sums[ends] - sums[starts]) * back[starts]), np.bincount(rows, minlength=len(offsets) - 1)


def _stored_form(words: np.ndarray) -> np.ndarray:
    """Words as texts are compared by them: half of their hashes."""
    return (words >> np.uint64(32)).astype("<u4")


def words_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The words of each text of a column, lower-cased before."""
    raw, offsets = text_bytes(column)
    for lo, hi in slices(offsets, LEAN_BYTES):
        words, counts = word_hashes(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        yield from np.split(_stored_form(words), np.cumsum(counts)[:-1])


def _kmers(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(text, hash, hash with occurrence label) of every k-mer, number of k-mers per text."""
    first = np.cumsum(counts) - counts
    number = np.maximum(1, counts - k + 1)
    text = np.repeat(np.arange(len(counts)), number)
    place = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    at = first[text] + place
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    kmers = np.zeros(len(text), np.uint64)
    for j in range(k):
        part = padded[at + j] * np.uint64((2 * j + 3) * 0x2545F4914F6CDD1D & (1 << 64) - 1)
        kmers += np.where(place + j < counts[text], part, np.uint64(j + 1))
    kmers = _mix(kmers)
    # occurrence labels: the how-manieth time a text has this k-mer
    order = np.argsort((text.astype(np.uint64) << np.uint64(40)) | (kmers >> np.uint64(24)), kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = (text[order][1:] == text[order][:-1]) & (kmers[order][1:] == kmers[order][:-1])
    heads = np.flatnonzero(~same)
    labels = np.empty(len(order), np.uint64)
    labels[order] = (np.arange(len(order)) - np.repeat(heads, np.diff(heads, append=len(order)))).astype(np.uint64)
    labelled = _mix(kmers + labels * np.uint64(0xD6E8FEB86659FD93))
    return text, kmers, labelled, number


def single_keys(words: np.ndarray, counts: np.ndarray, k: int, tables: int) -> np.ndarray:
    """Keys of every text, an array of (texts, tables): the smallest labelled k-mer under as many hashes."""
    *_, labelled, number = _kmers(words, counts, k)
    starts = np.cumsum(number) - number
    keys = np.empty((len(counts), tables), np.uint64)
    for t in range(tables):
        salt = np.uint64((64 * k + t + 1) * 0xA0761D6478BD642F & (1 << 64) - 1)
        value = (labelled ^ salt) * _MIX[1]
        value ^= value >> np.uint64(32)
        keys[:, t] = _mix(np.minimum.reduceat(value, starts) + salt)
    return keys


def text_keys(words: np.ndarray, counts: np.ndarray, tables: int = TABLES) -> tuple[np.ndarray, np.ndarray]:
    """(all keys of one text after the other, number of keys per text)."""
    keys = np.concatenate([sketches(words, counts, tables, LEVELS[:1]), single_keys(words, counts, SINGLE_K, SINGLE)], axis=1)
    short = np.flatnonzero(counts <= SHORT)
    number = np.full(len(counts), keys.shape[1])
    if not len(short):
        return keys.ravel(), number
    more = single_keys(words[np.repeat(counts <= SHORT, counts)], counts[short], SHORT_K, SINGLE)
    number[short] += SINGLE
    wide = np.zeros((len(counts), keys.shape[1] + SINGLE), np.uint64)
    wide[:, :keys.shape[1]] = keys
    wide[short, keys.shape[1]:] = more
    return wide[np.arange(wide.shape[1]) < number[:, None]], number


def sketches(words: np.ndarray, counts: np.ndarray, tables: int = TABLES, levels: tuple[int, ...] = LEVELS) -> np.ndarray:
    """Keys of every text, an array of (texts, tables * levels); the levels of a table lie side by side."""
    texts = len(counts)
    text, kmers, labelled, number = _kmers(words, counts, K)
    starts = np.cumsum(number) - number
    keys = np.empty((texts, tables * len(levels)), np.uint64)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    for t in range(tables):
        value = (labelled ^ np.uint64((t + 1) * 0xA0761D6478BD642F & (1 << 64) - 1)) * _MIX[1]
        value ^= value >> np.uint64(32)
        chosen = np.empty((texts, levels[-1]), np.int64)
        for j in range(levels[-1]):
            least = np.minimum.reduceat(value, starts)
            hit = np.flatnonzero(value == np.repeat(least, number))
            hit = hit[np.concatenate([[True], text[hit][1:] != text[hit][:-1]])]
            chosen[:, j] = np.where(least == none, len(kmers), hit)
            value[hit] = none
        shown = np.concatenate([kmers, np.zeros(1, np.uint64)])
        for level, size in enumerate(levels):
            places = np.sort(chosen[:, :size], axis=1)
            key = np.full(texts, np.uint64(t + 1))
            for j in range(size):
                key = _mix(key * np.uint64(_BASE) + shown[places[:, j]])
            keys[:, t * len(levels) + level] = key
    return keys


def bin_counts(words: np.ndarray) -> np.ndarray:
    """How many words fall into each of a power of two of bins, at most 255."""
    bins = 1 << min(12, max(5, len(words).bit_length() - 1))
    return np.minimum(np.bincount(words & np.uint32(bins - 1), minlength=bins), 255).astype(np.uint8)


def folded(counts: np.ndarray, bins: int) -> np.ndarray:
    return counts.reshape(-1, bins).sum(axis=0, dtype=np.int32)


def _sketch(tables: int):
    def run(batches):
        release_caches()
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for lo, hi in slices(offsets, LEAN_BYTES):
                part = raw[offsets[lo]:offsets[hi]]
                words, counts = word_hashes(part, offsets[lo:hi + 1] - offsets[lo])
                keys, number = text_keys(words, counts, tables)
                ends = np.cumsum(counts)
                short = _stored_form(words)
                rows = [(a, b) for a, b in zip((ends - counts).tolist(), ends.tolist())]
                nodes = [hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest() for a, b in rows]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("_at").slice(lo, hi - lo), pa.array(nodes, pa.binary()),
                     pa.array([int.from_bytes(x[:8], "big", signed=True) for x in nodes], pa.int64()),
                     pa.array(counts.astype(np.int32)), pa.array([bin_counts(short[a:b]).tobytes() for a, b in rows], pa.binary()),
                     pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(number)]).astype(np.int32), pa.array(keys.view(np.int64)))],
                    ["doc_id", "_at", "node", "h", "n", "counts", "keys"])
    return run


def edit_within(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edit distance of two word arrays if it is at most ``most``.

    Bit vectors over the band: along column j (a word of the shorter text) bit p stands for row j + p - most (a word of the longer one), and
    ``up`` and ``down`` say where a column's distances rise or fall from row to row. A column costs a few operations on whole numbers of
    2 * most + 1 bits, which is also all the memory besides one number per different word. What lies outside the band counts as one edit
    more than its neighbour, so distances are never too small, and right where they are at most ``most``. The main diagonal's distance only
    grows; once the ends cannot be met within ``most`` edits any more, the walk stops.
    """
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    n, m = len(a), len(b)
    if n - m > most or not m:
        return n if n <= most else None
    places: dict[int, int] = {}
    for row, word in enumerate(a.tolist()):
        places[word] = places.get(word, 0) | 1 << row
    full = (1 << 2 * most + 1) - 1
    middle, up, down, score, worst = 1 << most, full >> most << most, 0, 0, most + n - m
    find = places.get
    for j, word in enumerate(b.tolist()):
        equal = find(word, 0)
        equal = (equal >> j - most if j >= most else equal << most - j) & full
        level = (((equal & up) + up) ^ up) | equal | down
        if not level & middle:
            score += 1
            if score > worst:
                return None
        right = down | full & ~(level | up)
        left = level & up
        level = (level & full) >> 1
        up = left | full & ~(level | right)
        down = level & right
    rest = ((1 << n - m) - 1) << most
    score += (up & rest).bit_count() - (down & rest).bit_count()
    return score if score <= most else None


def _rising(values: np.ndarray) -> np.ndarray:
    """Places of a longest strictly rising part."""
    if len(values) < 2 or (np.diff(values) > 0).all():
        return np.arange(len(values))
    tails, last, before = [], [], []
    for k, v in enumerate(values.tolist()):
        at = bisect_left(tails, v)
        before.append(last[at - 1] if at else -1)
        if at == len(tails):
            tails.append(v)
            last.append(k)
        else:
            tails[at], last[at] = v, k
    out, k = [], last[-1]
    while k >= 0:
        out.append(k)
        k = before[k]
    return np.array(out[::-1])


def distance_at_most(a: np.ndarray, b: np.ndarray) -> int:
    """Edits of one alignment, so never less than the distance: it goes through the three-word runs that occur once in either text."""
    places = []
    for x in (a, b):
        runs = x[:-2] * np.uint64(_BASE) + x[1:-1] * np.uint64(0xD6E8FEB86659FD93) + x[2:]
        value, first, count = np.unique(runs, return_index=True, return_counts=True)
        places.append((value[count == 1], first[count == 1]))
    _, i, j = np.intersect1d(places[0][0], places[1][0], assume_unique=True, return_indices=True)
    p, q = places[0][1][i], places[1][1][j]
    order = np.argsort(p)
    p, q = p[order], q[order]
    good = (a[p] == b[q])
    keep = _rising(q[good])
    p, q = np.concatenate([[-1], p[good][keep], [len(a)]]), np.concatenate([[-1], q[good][keep], [len(b)]])
    gap_a, gap_b = np.diff(p) - 1, np.diff(q) - 1
    cost = int(np.maximum(gap_a, gap_b)[gap_a != gap_b].sum())
    level = np.flatnonzero((gap_a == gap_b) & (gap_a > 0))
    size = gap_a[level]
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return cost + int((a[np.repeat(p[level] + 1, size) + within] != b[np.repeat(q[level] + 1, size) + within]).sum())


#: Words of a pair that is aligned at once; longer ones are tested by cheaper bounds first.
SHORT_PAIR = 300


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    longer = max(len(a), len(b))
    most = int((1 - similarity) * longer + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    if longer <= SHORT_PAIR:
        return edit_within(a, b, most) is not None
    # words in common, each as often as both have it: the distance is at least the rest of the longer text
    x, y = np.sort(a), np.sort(b)
    joint = np.sort(np.concatenate([np.unique(x), np.unique(y)]))
    values = joint[1:][joint[1:] == joint[:-1]]
    counts = [np.searchsorted(z, values, "right") - np.searchsorted(z, values, "left") for z in (x, y)]
    if longer - int(np.minimum(*counts).sum()) > most:
        return False
    # most pairs are settled by one good alignment; the others walk the whole band
    if distance_at_most(a.astype(np.uint64), b.astype(np.uint64)) <= most:
        return True
    return edit_within(a, b, most) is not None


def _verify(similarity: float):
    def run(batches):
        for batch in batches:
            good = [similar(x, y, similarity) for x, y in zip(words_of(batch.column("a_text")), words_of(batch.column("b_text")))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))
    return run


def _bounded(similarity: float):
    """Of pairs (a, b, n, m, their counts) those whose words in common do not rule them out."""
    def run(batches):
        for batch in batches:
            good = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n", "m", "a_counts", "b_counts"))):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                bins = min(len(x), len(y))
                # the distance is at least the longer text less the words in common, each as often as both have it
                least = max(n, m) - (n + m - int(np.abs(folded(x, bins) - folded(y, bins)).sum())) // 2
                good.append(least <= int((1 - similarity) * max(n, m) + 1e-9))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))
    return run


def _candidates(crossing: bool, side: np.ndarray, up: np.ndarray, root: np.ndarray, n: np.ndarray, counts: list, similarity: float) -> tuple[np.ndarray, ...]:
    """Pairs of a block's members (``crossing``: between its two sides) that are not connected yet and that lengths and words in common do not rule out,
    each with the least share of the longer text's words that edits must take, in thousandths.

    Pairs of which both are ``up`` belong to the next size class.
    """
    bins = min(map(len, counts))
    matrix = np.stack([folded(x, bins) for x in counts])
    left, right, gaps = [], [], []
    for i in range(len(n) - 1):
        rest = np.arange(i + 1, len(n))
        good = (root[rest] != root[i]) & ~(up[rest] & up[i])
        rest = rest[good & (side[rest] != side[i]) if crossing else good]
        longer = np.maximum(n[rest], n[i])
        edits = ((1 - similarity) * longer + 1e-9).astype(np.int64)
        near = np.abs(n[rest] - n[i]) <= edits
        rest, longer, edits = rest[near], longer[near], edits[near]
        if len(rest):
            least = longer - (n[rest] + n[i] - np.abs(matrix[rest] - matrix[i]).sum(axis=1)) // 2
            good = least <= edits
            left.append(np.full(good.sum(), i))
            right.append(rest[good])
            gaps.append(1000 * least[good] // longer[good])
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right, gaps))


def _blocks(batches, names: tuple[str, ...]):
    """The rows of each block as one table; rows come in order of the columns that name their block."""
    held, block = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy() for c in names]
        new = np.zeros(batch.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            now = tuple(c[lo] for c in cols)
            if block is not None and now != block:
                yield pa.Table.from_batches(held)
                held = []
            block = now
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


BLOCK_NAMES = ("key", "size", "p", "q")


def _block_candidates(table: pa.Table, similarity: float) -> tuple[np.ndarray, ...]:
    root, n, side, up = (table.column(c).to_numpy() for c in ("root", "n", "side", "up"))
    p, q = (table.column(c)[0].as_py() for c in ("p", "q"))
    return _candidates(p != q, side, up, root, n.astype(np.int64), [np.frombuffer(x, np.uint8) for x in table.column("counts").to_pylist()], similarity)


def _settle(similarity: float):
    """From members in order of their blocks: pairs (a, b, gap) to be aligned, or, of a block with many, its bucket and size class (a, size)."""
    def run(batches):
        for table in _blocks(batches, BLOCK_NAMES):
            h, (i, j, gap) = table.column("h").to_numpy(), _block_candidates(table, similarity)
            if len(i) > NEAREST * table.num_rows:
                a, b, gap, size = [table.column("key")[0].as_py()], [0], [0], [table.column("size")[0].as_py()]
            else:
                a, b, size = np.minimum(h[i], h[j]), np.maximum(h[i], h[j]), [None] * len(i)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(gap, pa.int64()), pa.array(size, pa.int32())], ["a", "b", "gap", "size"])
    return run


def _join(similarity: float):
    """From members with their words in order of their blocks: links (a, b) that connect what similar members connect.

    Candidates go nearest first; a pair that links have connected by then is not aligned, nor is one that the first of the units that both
    are in (``units``: of every unit its number and whether the member is ``up`` there) aligns.
    """
    def run(batches):
        for table in _blocks(batches, BLOCK_NAMES):
            i, j, gap = _block_candidates(table, similarity)
            order = np.argsort(gap, kind="stable")
            i, j = i[order], j[order]
            _, label = np.unique(table.column("root").to_numpy(), return_inverse=True)
            unit, nodes = table.column("unit")[0].as_py(), table.column("node").to_pylist()
            units = [{u["unit"]: u["up"] for u in own} for own in table.column("units").to_pylist()]
            words, links = [np.frombuffer(x, "<u4") for x in table.column("words").to_pylist()], []
            for lo in range(0, len(i), 4096):
                x, y = i[lo:lo + 4096], j[lo:lo + 4096]
                apart = label[x] != label[y]
                for a, b in zip(x[apart].tolist(), y[apart].tolist()):
                    if label[a] == label[b]:
                        continue
                    there = units[b]
                    if unit != min(u for u, up in units[a].items() if u in there and not (up and there[u])):
                        continue
                    if similar(words[a], words[b], similarity):
                        links.append((nodes[a], nodes[b]))
                        label[label == label[b]] = label[a]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], ["a", "b"])
    return run


def _both(pairs: DataFrame, texts: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The pairs (a, b) with columns of either side's text, ``a_`` and ``b_`` before their names."""
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("h").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side)
    return pairs


def _aligned(pairs: DataFrame, texts: DataFrame, rows: DataFrame, similarity: float, folders: list[str]) -> DataFrame:
    """Of distinct pairs (a, b) of short names the similar ones as nodes, stored. Texts are moved once for each pair, from the ``rows`` given."""
    whole = _both(pairs, texts, ("node", "_at"))
    for side in ("a", "b"):
        whole = whole.join(rows.select(F.col("_at").alias(f"{side}__at"), F.col("text").alias(f"{side}_text")), f"{side}__at")
    whole = whole.select(*[F.col(f"{x}_node").alias(x) for x in "ab"], *[F.lower(f"{x}_text").alias(f"{x}_text") for x in "ab"])
    return stored_table(whole.mapInArrow(_verify(similarity), "a binary, b binary"), "verified", folders)


def _short(node: str) -> Column:
    """A node's short name: the first half of its digest. Texts are told apart by the whole of it; that two of one bucket share a half is as unlikely as one in 2^64."""
    return F.conv(F.hex(F.substring(node, 1, 8)), 16, -10).cast("long")


def _dealt_rows(sized: DataFrame) -> int:
    return int(sized.agg(F.coalesce(F.sum(F.col("g").cast("long")), F.lit(0))).first()[0])


def _dealt(sized: DataFrame, parts: int) -> DataFrame:
    """Members of the buckets in order of the pairs of blocks that are compared, dealt over ``parts`` tasks or more.

    The number goes with the comparisons, so that small blocks with many of them are not merged by their bytes.
    """
    spark, carried = sized.sparkSession, [c for c in sized.columns if c not in ("own", "m", "g", "at")]
    dealt = sized.select("*", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("other")).select(
        F.least("at", "other").alias("p"), F.greatest("at", "other").alias("q"), (F.col("at") <= F.col("other")).alias("side"),
        (F.col("own") != F.col("size")).alias("up"), *carried)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(20_000, parts))
    return dealt.repartition(parts, *BLOCK_NAMES).sortWithinPartitions(*BLOCK_NAMES)


def _worded(batches):
    """Texts with their words in the place of the text."""
    for batch in batches:
        words = pa.array([x.tobytes() for x in words_of(batch.column("text"))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("node"), batch.column("units"), words], ["h", "node", "units", "words"])


def _joined(sized: DataFrame, texts: DataFrame, rows: DataFrame, similarity: float, block: int, folders: list[str]) -> DataFrame:
    """Links of the members of crowded buckets, stored. Their words meet in blocks that are bounded in members and in words."""
    sized = sized.withColumn("unit", F.xxhash64("key", "size"))
    units = sized.groupBy("h").agg(F.collect_list(F.struct("unit", (F.col("own") != F.col("size")).alias("up"))).alias("units"))
    units = units.join(texts.select("h", "node", "_at"), "h").join(rows, "_at").select("h", "node", "units", F.lower("text").alias("text"))
    units = units.mapInArrow(_worded, "h long, node binary, units array<struct<unit:long,up:boolean>>, words binary")
    most = F.floor(F.lit(DENSE_WORDS) / F.pow(F.lit(1.26), F.col("size") + 2))
    blocks = F.ceil(F.col("m") / F.greatest(F.lit(1), F.least(F.lit(min(block, DENSE_BLOCK)), most))).cast("int")
    members = sized.withColumn("g", blocks).withColumn("at", F.expr("cast(pmod(xxhash64(h), g) AS int)"))
    parts = _dealt_rows(members) // DENSE_BLOCK
    return stored_table(_dealt(members.join(units, "h"), parts).mapInArrow(_join(similarity), "a binary, b binary"), "joined", folders)


def similar_links(
    sketched: DataFrame, rows: DataFrame, similarity: float = SIMILARITY, folders: list[str] | None = None, block: int = BLOCK, done_with: Sequence[str] = (),
) -> DataFrame:
    """Verified links (a, b) between nodes with different words, which connect all that similar nodes with a common key connect.

    ``rows`` (_at, text) are those that the sketches were made of. The folders of stored steps are added to ``folders``; ``block`` is the number of members that a task compares with as many others. Steps are dropped
    as soon as a later one holds what is still needed of them, and so are the folders ``done_with``, which hold the rows given.
    """
    folders = [] if folders is None else folders
    spark = sketched.sparkSession
    nodes = sketched.groupBy("node").agg(F.first("keys").alias("keys"), F.first("n").alias("n"), F.first("h").alias("h"))
    entries = stored_table(nodes.select(F.explode(F.array_distinct("keys")).alias("key"), "h", "n"), "entries", spent := [])
    # buckets are summed up before their members meet: a key that many texts share is one row per task there
    centres = entries.groupBy("key").agg(F.min("h").alias("c"), F.max("h").alias("hi")).filter("c != hi")
    members = stored_table(entries.join(centres.select("key", "c"), "key"), "members", members_at := [])
    drop_tables(spark, spent)
    # nearly every text shares some key: picking those that do would move all counts once more
    texts = sketched.groupBy("node").agg(
        F.first("h").alias("h"), F.first("n").alias("n"), F.first("counts").alias("counts"), F.min("_at").alias("_at"))
    texts = stored_table(texts, "texts", folders)
    drop_tables(spark, done_with)
    # near copies share most of their keys, so a third of the buckets connects them; what these leave apart is gone through below, under every key
    pairs = members.filter("key % 3 = 0 AND h != c").select(F.col("c").alias("a"), F.col("h").alias("b")).distinct()
    near = _both(pairs, texts, ("n", "counts")).select("a", "b", F.col("a_n").alias("n"), F.col("b_n").alias("m"), "a_counts", "b_counts")
    near = stored_table(near.mapInArrow(_bounded(similarity), "a long, b long").distinct(), "near", folders)
    links = _aligned(near, texts, rows, similarity, folders)
    # buckets that are not connected yet; of those with the same members the one with the smallest key
    roots = components(links, folders).select(_short("node").alias("h"), _short("root").alias("root"))
    rooted = members.select("key", "h", "n").join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))
    rooted = stored_table(rooted, "rooted", rooted_at := [])
    drop_tables(spark, members_at)
    marks = F.expr("bit_xor(xxhash64(h))").alias("x"), F.expr("bit_xor(xxhash64(h, 1))").alias("y")
    apart = rooted.groupBy("key").agg(F.count(F.lit(1)).alias("m"), *marks, F.min("root").alias("lo"), F.max("root").alias("hi"))
    apart = apart.filter("lo != hi").groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key")
    # similar texts are in the same or in neighbouring size classes: a member joins its own and the class below (``up``)
    size = F.floor(F.log("n") / F.log(F.lit(1.001 / similarity))).cast("int")
    sized = rooted.join(apart, "key").withColumn("own", size)
    sized = sized.select("key", "h", "n", "root", "own", F.explode(F.array(F.col("own"), F.col("own") - 1)).alias("size"))
    blocks = sized.groupBy("key", "size").agg(
        F.min("own").alias("least"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("m"))
    blocks = blocks.filter("lo != hi AND least = size").select("key", "size", "m", F.ceil(F.col("m") / block).cast("int").alias("g"))
    sized = sized.join(blocks, ["key", "size"]).join(texts.select("h", "counts"), "h")
    sized = stored_table(sized.withColumn("at", F.expr("cast(pmod(xxhash64(h), g) AS int)")), "blocks", folders)
    drop_tables(spark, rooted_at)
    pairs = _dealt(sized, _dealt_rows(sized) // (4 * block)).mapInArrow(_settle(similarity), "a long, b long, gap long, size int")
    pairs = stored_table(pairs.groupBy("a", "b", "size").agg(F.min("gap").alias("gap")), "pairs", folders)
    many = pairs.filter("size IS NOT NULL").select(F.col("a").alias("key"), "size")
    pairs = pairs.filter("size IS NULL").drop("size")
    crowded = not many.isEmpty()
    if crowded:
        links = links.union(_joined(sized.join(many, ["key", "size"], "left_semi"), texts, rows, similarity, block, folders))
    # first the nearest few of every text, which connect most of a group; then every pair that is not connected by those
    ends = pairs.select("a", "b", "gap", F.explode(F.array("a", "b")).alias("h"))
    nearest = Window.partitionBy("h").orderBy("gap", "a", "b")
    first = ends.withColumn("_n", F.row_number().over(nearest)).filter(F.col("_n") <= NEAREST).select("a", "b").distinct()
    first = stored_table(first, "first", folders)
    links = links.union(_aligned(first, texts, rows, similarity, folders))
    if not crowded and first.isEmpty():
        return links
    roots = components(links, folders).select(_short("node").alias("h"), _short("root").alias("root"))
    rest = pairs.select("a", "b").join(first, ["a", "b"], "left_anti")
    for side in ("a", "b"):
        rest = rest.join(roots.select(F.col("h").alias(side), F.col("root").alias(f"{side}_root")), side, "left")
    rest = rest.filter(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")
    return links.union(_aligned(rest, texts, rows, similarity, folders)).distinct()


def near_groups(docs: DataFrame, tables: int = TABLES, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """doc_id, _at (file and row), links, root of every row; rows of a group share the root. Stored; steps on the way are dropped."""
    spark, folders = docs.sparkSession, []
    python_ready(spark)
    rows = located(docs, F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    sketched = rows.select("doc_id", "_at", F.lower("text").alias("text")).mapInArrow(_sketch(tables), SKETCH)
    sketched = stored_table(sketched, "sketches", sketches_at := [])
    placed = stored_table(sketched.select("doc_id", "_at", "node"), "placed", folders)
    links = similar_links(sketched, rows.select("_at", "text"), similarity, folders, block, sketches_at)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    roots = components(links, folders).join(degree, "node")
    groups = placed.join(roots, "node", "left").select(
        "doc_id", "_at", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    groups = stored_table(groups, "groups")
    drop_tables(spark, folders)
    return groups


def _keepers(groups: DataFrame) -> DataFrame:
    return groups.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_at")).alias("keeper"), F.count(F.lit(1)).alias("group_size"))


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, group_id (id of the row that stays), group_size, links (of its text to others), kept."""
    groups = near_groups(docs, **settings)
    return groups.join(_keepers(groups), "root").select(
        "doc_id", F.col("keeper.doc_id").alias("group_id"), "group_size", "links", (F.col("keeper._at") == F.col("_at")).alias("kept"))


def near_dedup(docs: DataFrame, **settings) -> DataFrame:
    """One row of each group, with all columns; rows that come from no file are stored first, so that each has a place."""
    docs = from_files(docs)
    kept = _keepers(near_groups(docs, **settings)).select("keeper._at")
    rows = located(docs, pack_row(docs))
    return unpack_row(rows.join(kept, "_at", "left_semi"), docs.columns)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
