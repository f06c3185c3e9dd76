"""Approximate nearest neighbours by collision counting over single projections.

Vectors are dealt into index shards by id. A shard keeps one sorted array of values for each random projection. A query's window on
each array is centred on its own projection; radius after radius (virtual rehashing: the same arrays, wider windows)
the vectors that fall into new parts of the windows collect collisions. A vector with enough of them is verified:
its cosine is computed on the original values in double precision. A query stops in a shard when its k-th best
vector lies within the current radius, where a nearer one would have collided often enough with 95 % probability; there
is no cap on candidates. Queries meet shards in blocks, so no task holds all of either.

Vectors that are null, zero, or hold null or non-finite values take no part, nor do rows without an id. Vectors of
different lengths never meet. Equal scores go by the smaller id; rows that repeat an id are candidates each, and one query. With
fewer candidates than k all are returned. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import python_ready, read_table

PROJECTIONS, HALF_WIDTH, FIRST_RADIUS, GROWTH = 40, 1.35, 0.25, 1.25
#: A vector inside the radius falls into one window with probability 0.823; 28 of 40 windows or more with over 95 %.
THRESHOLD = 28
SHARD_ROWS, BLOCK_ROWS = 4096, 512
FOUND = "query_id long, vec_id long, score double"


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    lists = table.column(column).combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return np.asarray(lists.flatten(), np.float64).reshape(len(lists), -1)


class Shard:
    """Sorted projections of unit vectors, and the vectors themselves."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 3):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.axes = np.random.default_rng(seed).normal(size=(vectors.shape[1], PROJECTIONS))
        values = (vectors / self.norms[:, None]) @ self.axes
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(values.T, self.order, axis=1)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(places, scores) of the k nearest of each query, its own row left out."""
        n, m = len(self.ids), PROJECTIONS
        norms = np.sqrt((queries * queries).sum(axis=1))
        centres = (queries / norms[:, None]) @ self.axes
        radii = [FIRST_RADIUS]
        while radii[-1] < 2:
            radii.append(radii[-1] * GROWTH)
        half = HALF_WIDTH * np.array(radii)
        edges = np.empty((len(queries), m, 2, len(radii)), np.int64)
        for j in range(m):
            edges[:, j, 0] = np.searchsorted(self.values[j], centres[:, j, None] - half, "left")
            edges[:, j, 1] = np.searchsorted(self.values[j], centres[:, j, None] + half, "right")
        flat, base = self.order.ravel(), np.arange(m) * n
        out = []
        for q in range(len(queries)):
            hits = np.zeros(n, np.int64)
            # the query's own row is left out, not others that share its id
            alike = np.flatnonzero(self.ids == own[q])
            verified = np.zeros(n, bool)
            verified[alike[(self.vectors[alike] == queries[q]).all(axis=1)][:1]] = True
            places, scores = np.empty(0, np.int64), np.empty(0)
            lo = hi = edges[q, :, 0, 0]
            for r, radius in enumerate(radii):
                low, high = edges[q, :, 0, r], edges[q, :, 1, r]
                starts, sizes = np.concatenate([base + low, base + hi]), np.concatenate([lo - low, high - hi])
                lo, hi = low, high
                ends = np.cumsum(sizes)
                hits += np.bincount(flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])], minlength=n)
                new = np.flatnonzero((hits >= THRESHOLD) & ~verified)
                if r + 1 == len(radii):  # the radius spans the sphere: whatever is left
                    new = np.flatnonzero(~verified)
                if len(new):
                    verified[new] = True
                    cosine = (self.vectors[new] * queries[q]).sum(axis=1) / (self.norms[new] * norms[q])
                    places, scores = np.concatenate([places, new]), np.concatenate([scores, cosine])
                    best = np.lexsort((self.ids[places], -scores))[:k]
                    places, scores = places[best], scores[best]
                if len(scores) >= k and np.sqrt(max(0.0, 2 - 2 * scores[k - 1])) <= radius:
                    break
            out.append((places, scores))
        return out


def _search(k: int, key, left: pa.Table, right: pa.Table) -> pa.Table:
    queries, vectors, scores = [], [], []
    if left.num_rows and right.num_rows:
        shard = Shard(left.column("vec_id").to_numpy(), _matrix(left, "vector"))
        own = right.column("vec_id").to_numpy()
        for q, (places, score) in zip(own, shard.search(_matrix(right, "vector"), own, k)):
            queries.append(np.full(len(places), q))
            vectors.append(shard.ids[places])
            scores.append(score)
    join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.empty(0, kind)
    return pa.table({"query_id": join(queries, np.int64), "vec_id": join(vectors, np.int64), "score": join(scores, np.float64)})


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (doubles) and dims of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad & (norm > 0)).withColumn("dims", F.size("vector"))


def nearest(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows by cosine of every query among all other rows."""
    python_ready(vectors.sparkSession)
    rows = usable(vectors)
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_query).alias("queries")).first()
    shards, blocks = max(1, -(-size["rows"] // SHARD_ROWS)), max(1, -(-size["queries"] // BLOCK_ROWS))
    shard, block = F.pmod(F.xxhash64("vec_id"), F.lit(shards)), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    keys = ["dims", "shard", "block"]
    data = rows.withColumn("shard", shard).withColumn("block", every(blocks))
    queries = rows.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"), F.min_by("dims", "vector").alias("dims"))
    queries = queries.withColumn("block", block).withColumn("shard", every(shards))
    found = data.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(partial(_search, k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every row whose id is divisible by 50, among all rows."""
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)
