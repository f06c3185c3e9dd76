"""Product codes of vectors by dual-tree Lloyd in whole numbers.

Components become ``floor(256 * x)``; vectors are cut into ``parts`` equal parts, each with a codebook of its own. One pass deals the rows into blocks and
stores, for every part of a block, a tree: rows in tree order, and for every node its box and the sum of its rows (``grown``). A round of Lloyd reads
the stored trees and walks each together with a tree over the entries (``walked``), level by level and all parts at once. Bounds between
two boxes drop pairs of nodes that cannot hold a nearest pair; where one entry is left for a node, its cached sum and count go to that entry whole;
leaves with several entries left compare every row in whole numbers. Tasks send one row per codebook cell; the sums make the next codebook.
What the driver holds is the codebook: entries times components, whatever the number of rows.

Rows whose vector is null, empty, or holds null or non-finite components take no part, nor do vectors of another length than that of the row
with the smallest id. Lengths that ``parts`` does not divide are filled up with zeros. Components are held to plus or minus 2^26, so
that every distance fits 64 bits. Nearest entries tie to the lower index; the first codebook takes the smallest ids, rows that repeat an id in the order of their vectors, null ids
last, and is smaller where there are fewer rows. Repeated rows are rows each; other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_tables, python_ready, read_table, release_caches, stored_table

PARTS, ENTRIES, ROUNDS, SCALE, MOST = 16, 64, 2, 256, 1 << 26
BLOCK_ROWS, LEAF_ROWS = 2048, 16


def whole_numbers(lists: pa.Array, width: int) -> np.ndarray:
    """floor(256 * x) of vectors of one length, zeros added up to ``width``."""
    values = np.asarray(lists.flatten(), np.float64).reshape(len(lists), -1)
    out = np.zeros((len(lists), width), np.int32)
    out[:, :values.shape[1]] = np.clip(np.floor(values * SCALE), -MOST, MOST)
    return out


def _edges(rows: int, depth: int) -> np.ndarray:
    """Where the nodes of a level of ``2 ** depth`` nodes begin and end."""
    return (rows * np.arange((1 << depth) + 1, dtype=np.int64)) >> depth


def grown(points: np.ndarray, leaf: int) -> dict[str, np.ndarray]:
    """Trees over the rows of every part, an array of (parts, rows, width), split at the median of the widest side.

    ``order`` and ``points`` are in tree order; ``low``, ``high`` and ``sums`` hold the nodes of all levels, root first.
    """
    parts, rows, width = points.shape
    depth = max(0, (max(1, rows) - 1) // leaf).bit_length()
    order = np.tile(np.arange(rows), (parts, 1))
    points = points.copy()
    for level in range(depth):
        edges, middle = _edges(rows, level), _edges(rows, level + 1)[1::2]
        for a, b, c in zip(edges[:-1].tolist(), middle.tolist(), edges[1:].tolist()):
            if c - a < 2:
                continue
            box = points[:, a:c]
            side = (box.max(axis=1) - box.min(axis=1)).argmax(axis=1)
            pick = np.argsort(np.take_along_axis(box, side[:, None, None], axis=2)[:, :, 0], axis=1, kind="stable")
            points[:, a:c] = np.take_along_axis(box, pick[:, :, None], axis=1)
            order[:, a:c] = np.take_along_axis(order[:, a:c], pick, axis=1)
    nodes = (2 << depth) - 1
    low = np.full((parts, nodes, width), MOST * 2, np.int32)
    high, sums = -low, np.zeros((parts, nodes, width), np.int64)
    edges, first = _edges(rows, depth), (1 << depth) - 1
    some = np.flatnonzero(np.diff(edges))
    if len(some):
        low[:, first + some] = np.minimum.reduceat(points, edges[some], axis=1)
        high[:, first + some] = np.maximum.reduceat(points, edges[some], axis=1)
        sums[:, first + some] = np.add.reduceat(points.astype(np.int64), edges[some], axis=1)
    for level in range(depth - 1, -1, -1):
        a, b = (1 << level) - 1, (2 << level) - 1
        low[:, a:b] = np.minimum(low[:, b:b + 2 * (b - a):2], low[:, b + 1:b + 2 * (b - a):2])
        high[:, a:b] = np.maximum(high[:, b:b + 2 * (b - a):2], high[:, b + 1:b + 2 * (b - a):2])
        sums[:, a:b] = sums[:, b:b + 2 * (b - a):2] + sums[:, b + 1:b + 2 * (b - a):2]
    return {"order": order.astype(np.uint16), "points": points, "low": low, "high": high, "sums": sums}


def _levels(rows: int, nodes: int) -> tuple[int, list[np.ndarray]]:
    depth = (nodes + 1).bit_length() - 2
    return depth, [_edges(rows, level) for level in range(depth + 1)]


def walked(tree: dict[str, np.ndarray], book: np.ndarray, codes: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """(sums and counts per part and entry, nearest entry per part and row if ``codes``) of a block for codebooks (parts, entries, width)."""
    points = tree["points"]
    parts, rows, width = points.shape
    entries = book.shape[1]
    twig = grown(book.astype(np.int32), 1)
    q_depth, q_edges = _levels(rows, tree["low"].shape[1])
    r_depth, r_edges = _levels(entries, twig["low"].shape[1])
    sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
    near = np.zeros((parts, rows), np.uint8) if codes else None
    part, q, r = np.arange(parts), np.zeros(parts, np.int64), np.zeros(parts, np.int64)
    q_level = r_level = 0

    def pruned(part, q, r):
        a, b = q + (1 << q_level) - 1, r + (1 << r_level) - 1
        q_low, q_high = tree["low"][part, a].astype(np.int64), tree["high"][part, a].astype(np.int64)
        r_low, r_high = twig["low"][part, b].astype(np.int64), twig["high"][part, b].astype(np.int64)
        gap = np.maximum(0, np.maximum(r_low - q_high, q_low - r_high))
        far = np.maximum(np.abs(r_high - q_low), np.abs(q_high - r_low))
        least, most = (gap * gap).sum(axis=1), (far * far).sum(axis=1)
        key = (part << q_level) + q
        order = np.argsort(key, kind="stable")
        heads = np.flatnonzero(np.diff(key[order], prepend=-1))
        bound = np.repeat(np.minimum.reduceat(most[order], heads), np.diff(heads, append=len(order)))
        keep = order[least[order] <= bound]
        return part[keep], q[keep], r[keep]

    while len(part):
        if r_level < r_depth:
            r_level += 1
            part, q, r = np.repeat(part, 2), np.repeat(q, 2), (r[:, None] * 2 + np.arange(2)).ravel()
            some = np.diff(r_edges[r_level])[r] > 0
            part, q, r = pruned(part[some], q[some], r[some])
        if q_level < q_depth:
            q_level += 1
            part, q, r = np.repeat(part, 2), (q[:, None] * 2 + np.arange(2)).ravel(), np.repeat(r, 2)
            some = np.diff(q_edges[q_level])[q] > 0
            part, q, r = pruned(part[some], q[some], r[some])
        if r_level < r_depth:
            continue
        key = (part << q_level) + q
        entry = twig["order"][part, r_edges[r_depth][r]].astype(np.int64)
        alone = np.bincount(key, minlength=1)[key] == 1
        a, edges = part[alone], q_edges[q_level]
        np.add.at(sums, (a, entry[alone]), tree["sums"][a, q[alone] + (1 << q_level) - 1])
        np.add.at(counts, (a, entry[alone]), np.diff(edges)[q[alone]])
        if codes:
            at, own = _spread(edges, q[alone])
            near[a[own], at] = entry[alone][own]
        part, q, r, entry = part[~alone], q[~alone], r[~alone], entry[~alone]
        if q_level == q_depth and len(part):
            at, own = _spread(edges, q)
            of, which = part[own], entry[own]
            distance = points[of, at].astype(np.int64) - book[of, which]
            distance = (distance * distance).sum(axis=1)
            row = of * rows + at
            least = np.full(parts * rows, np.iinfo(np.int64).max)
            np.minimum.at(least, row, distance)
            hit = distance == least[row]
            best = np.full(parts * rows, entries, np.int64)
            np.minimum.at(best, row[hit], which[hit])
            row = np.unique(row)
            of, at, which = row // rows, row % rows, best[row]
            np.add.at(sums, (of, which), points[of, at].astype(np.int64))
            np.add.at(counts, (of, which), 1)
            if codes:
                near[of, at] = which
        if q_level == q_depth:
            break
    return sums, counts, near


def _spread(edges: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in ``nodes``) of every row of the nodes."""
    sizes = np.diff(edges)[nodes]
    own = np.repeat(np.arange(len(nodes)), sizes)
    return np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + edges[nodes][own], own


def _plant(parts: int, width: int):
    names = ("order", "points", "low", "high", "sums")

    def block(table: pa.Table) -> pa.RecordBatch:
        numbers = whole_numbers(table.column("vector").combine_chunks(), width)
        tree = grown(numbers.reshape(len(numbers), parts, -1).transpose(1, 0, 2), LEAF_ROWS)
        one = lambda name: pa.array([table.column(name).to_pylist()], pa.list_(table.schema.field(name).type))
        return pa.RecordBatch.from_arrays([one("vec_id"), one("label"), *[pa.array([tree[n].tobytes()], pa.binary()) for n in names]], ["vec_ids", "labels", *names])

    def run(batches):
        release_caches()
        held, rows = [], 0
        for batch in batches:
            lo = 0
            while lo < batch.num_rows:
                piece = batch.slice(lo, BLOCK_ROWS - rows)
                held.append(piece)
                rows, lo = rows + piece.num_rows, lo + piece.num_rows
                if rows == BLOCK_ROWS:
                    yield block(pa.Table.from_batches(held))
                    held, rows = [], 0
        if rows:
            yield block(pa.Table.from_batches(held))
    return run


def _tree(batch: pa.RecordBatch, k: int, parts: int) -> dict[str, np.ndarray]:
    kinds = {"order": np.uint16, "points": np.int32, "low": np.int32, "high": np.int32, "sums": np.int64}
    arrays = {name: np.frombuffer(batch.column(name)[k].as_py(), kind) for name, kind in kinds.items()}
    rows = len(arrays["order"]) // parts
    width = len(arrays["points"]) // (parts * rows)
    return {"order": arrays["order"].reshape(parts, rows)} | {n: arrays[n].reshape(parts, -1, width) for n in ("points", "low", "high", "sums")}


def _step(book: np.ndarray):
    """One row per codebook cell that the task's blocks add to: cell number, sum of components, count."""
    def run(batches):
        sums, counts = np.zeros(book.shape, np.int64), np.zeros(book.shape[:2], np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                s, c, _ = walked(_tree(batch, k, len(book)), book, False)
                sums, counts = sums + s, counts + c
        cells = np.flatnonzero(np.repeat(counts.ravel(), book.shape[2]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array(sums.ravel()[cells]), pa.array(counts.ravel()[cells // book.shape[2]])], ["cell", "total", "n"])
    return run


def _encode(book: np.ndarray):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                tree = _tree(batch, k, len(book))
                near = walked(tree, book, True)[2].astype(np.int64)
                of = np.arange(len(book))[:, None]
                distance = tree["points"].astype(np.int64) - book[of, near]
                codes, errors = np.empty(near.shape, np.uint8), np.empty(near.shape, np.int64)
                order = tree["order"].astype(np.int64)
                codes[of, order], errors[of, order] = near, (distance * distance).sum(axis=2)
                text, size = codes.T.tobytes().hex(), 2 * len(book)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_ids").slice(k, 1).flatten(), batch.column("labels").slice(k, 1).flatten(),
                     pa.array([text[i:i + size] for i in range(0, len(text), size)], pa.string()), pa.array(errors.sum(axis=0))],
                    ["vec_id", "label", "code", "error"])
    return run


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, vector of the rows that take part."""
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    rows = vectors.select(F.col("vec_id").cast("long"), label, F.col("embedding").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("vector").isNotNull() & ~bad & (F.size("vector") > 0))


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error of every row that takes part; final codebooks as an array of (parts, entries, width of a part)).

    ``code`` has two hex digits a part, so there are at most 256 entries. The rows are stored; the trees are dropped.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    spark, folders = vectors.sparkSession, []
    python_ready(spark)
    rows = usable(vectors)
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not start:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), np.int64)
    size = len(start[0]["vector"])
    width = -(-size // parts) * parts
    rows = rows.filter(F.size("vector") == size)
    book = whole_numbers(pa.array([r["vector"] for r in start if len(r["vector"]) == size], pa.list_(pa.float64())), width)
    book = book.astype(np.int64).reshape(len(book), parts, -1).transpose(1, 0, 2).copy()
    kind = T.StructType([T.StructField("vec_ids", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(rows.schema["label"].dataType)),
                         *[T.StructField(n, T.BinaryType()) for n in ("order", "points", "low", "high", "sums")]])
    trees = stored_table(rows.mapInArrow(_plant(parts, width), kind), "trees", folders)
    for _ in range(rounds):
        cells = trees.mapInArrow(_step(book), "cell long, total long, n long").groupBy("cell").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        for cell, total, n in cells.collect():  # at most entries times components
            book.reshape(-1)[cell] = total // n
    out = stored_table(trees.mapInArrow(_encode(book), T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("label", rows.schema["label"].dataType), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])), "codes")
    drop_tables(spark, folders)
    return out, book


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, error of its label, digest of the codebooks."""
    codes, book = compressed(read_table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    labels = codes.groupBy(F.col("label").alias("own")).agg(F.try_sum("error").alias("label_error"))
    return codes.join(labels, codes["label"].eqNullSafe(labels["own"])).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _rounds() -> str:
    """Check SQL of the rounds: c0 is the first codebook, a<k> the assignment to c<k>, c<k + 1> the next codebook."""
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
    SELECT vec_id, label, p, any_value(parts.v) AS v,
        min((list_inner_product(parts.v, parts.v) - 2 * list_inner_product(parts.v, c.v) + list_inner_product(c.v, c.v))::BIGINT * 64 + e) AS best
    FROM parts JOIN c{k} c USING (p) GROUP BY vec_id, label, p)""")
        if k < ROUNDS:
            steps.append(f"""m{k} AS (SELECT p, e, j, floor(sum(v[j]) / count(*)) AS x
    FROM (SELECT p, best % 64 AS e, v, unnest(range(1, len(v) + 1)) AS j FROM a{k}) GROUP BY p, e, j),
c{k + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(n.v, c.v) AS v FROM c{k} c LEFT JOIN (SELECT p, e, list(x ORDER BY j) AS v FROM m{k} GROUP BY p, e) n ON c.p = n.p AND c.e = n.e)""")
    return ",\n".join(steps)


ORACLE = f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // 16 + 1:(p + 1) * len(v) // 16] AS v FROM kept, range(16) t(p)),
c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts QUALIFY e < 64),
{_rounds()},
codes AS (SELECT vec_id, label, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(array_to_string(v::BIGINT[], ','), ',' ORDER BY p, e)) FROM c{ROUNDS}) AS codebooks_sha256 FROM codes
"""
