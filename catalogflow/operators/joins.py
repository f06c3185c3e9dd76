"""Enrichment and plan joins.

No broadcast hint anywhere: Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``, and adaptive skew join splits hot keys of the
preserved side. The looked-up side is always unique by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import query_param
from .curate import first_wins

NO_CODE = "未セット"


@dataclass(frozen=True)
class RunContext:
    """Constants of one run, put on each row as literals."""

    project: str
    source: str
    target: str
    crawled_at: str

    def columns(self) -> list[Column]:
        return [F.lit(getattr(self, name)).alias(name) for name in ("project", "source", "target", "crawled_at")]


def with_run_context(df: DataFrame, run: RunContext) -> DataFrame:
    return df.select(*run.columns(), "*")


def with_run_table(df: DataFrame, runs: DataFrame, key: str = "project") -> DataFrame:
    """Run constants kept in a table, one row per ``key``."""
    return df.join(runs, key, "inner")


def with_detail_code(items: DataFrame, details: DataFrame, url: str = "url", code: str = "jan") -> DataFrame:
    """List items with the code of their detail page; the placeholder when the page has none.

    ``details(url, code)`` must be unique by URL (see ``first_wins``).
    """
    found = details.select(F.col(url), F.col(code))
    return items.join(found, url, "left").withColumn(code, F.coalesce(F.nullif(F.col(code), F.lit("")), F.lit(NO_CODE)))


def with_variant_detail(products: DataFrame, details: DataFrame, variants: str = "variants") -> DataFrame:
    """One row per variant ``struct(jan, href)`` of each product page, with its detail page when captured."""
    pairs = products.select("*", F.posexplode(variants).alias("variant_pos", "v"))
    pairs = pairs.select("*", F.col("v.jan").alias("jan"), F.col("v.href").alias("variant_url")).drop("v", variants)
    return pairs.join(details, "variant_url", "left")


def with_feed_price(variants: DataFrame, feed: DataFrame, url: str = "variant_url") -> DataFrame:
    """Price-feed entry by the sku of the URL; the first entry of a code counts. ``feed(code, feed_pos, ...)``."""
    first = first_wins(feed, "code", order=("feed_pos",)).drop("feed_pos")
    skued = variants.withColumn("sku", query_param(url, "sku"))
    return skued.join(first, skued["sku"] == first["code"], "left").drop("code")


def skip_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the snapshot yet."""
    return df.join(done.select(key).filter(F.length(key) > 0), key, "left_anti")


def only_staged(uploaded: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    return uploaded.join(staged.select(key), key, "left_semi")


def plan_with_results(
    plan: DataFrame, items: DataFrame, key: str = "query", status: str = "ok", empty_status: str = "ok",
    false_columns: Sequence[str] = (),
) -> DataFrame:
    """Each planned query with its result rows; a query without any gives one placeholder row.

    Hits are an inner join, which may split a hot query on the item side; the placeholders
    come from the queries that the distinct item keys do not cover. ``plan`` is unique by key.
    ``items`` is read twice; store it first when it comes straight from page parsing.
    """
    hits = items.join(plan, key).withColumn("status", F.lit(status))
    missing = plan.join(items.select(key).distinct(), key, "left_anti").withColumn("status", F.lit(empty_status))
    for name in false_columns:
        missing = missing.withColumn(name, F.lit(False))
    return hits.unionByName(missing, allowMissingColumns=True)


def pair_by_position(left: Column, right: Column) -> Column:
    """Array of struct(pos, left, right) over the left entries; a short right side gives NULL."""
    zipped = F.arrays_zip(left.alias("left"), right.alias("right"))
    numbered = F.transform(
        zipped, lambda z, i: F.struct(i.alias("pos"), z["left"].alias("left"), z["right"].alias("right"))
    )
    return F.slice(numbered, F.lit(1), F.size(left))
