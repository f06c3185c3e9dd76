"""Connected components of a link table by alternating star steps, with no node's links in one group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored_table


def components(links: DataFrame, folders: list[str] | None = None) -> DataFrame:
    """(node, root) of every node of the undirected links (a, b); the root is the smallest node of the component.

    Each step is two aggregations and two joins whose sides are links, so a node with many links is split like any
    skewed join key. Steps are stored in the shared folder, each in one that is added to ``folders``. Their number grows with the logarithm of
    the longest chain; stars are done after one.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, mark = stored_table(edges, "links", folders), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        far = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = far.groupBy("u").agg(F.min("v").alias("m"))
        near = far.join(least, "u")
        near = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = stored_table(near.filter("u != v").distinct(), "links", folders)
        now = tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.hash("u", "v"))).first())
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
