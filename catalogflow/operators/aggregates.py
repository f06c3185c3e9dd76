"""Reports: status roll-ups, page yield, distinct URLs, blocked queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status_rollup(df: DataFrame, keys: Sequence[str], statuses: Sequence[str], status: str = "status") -> DataFrame:
    """One count per fixed status, zero when it does not occur."""
    return df.groupBy(*keys).agg(*[F.count_if(F.col(status) == s).alias(s) for s in statuses])


def page_yield(listed: DataFrame, unique_rows: DataFrame, page: Sequence[str], identified: Column) -> DataFrame:
    """Per page: listed, extracted (identified), unique (first wins over all pages), skipped duplicates."""
    counts = listed.groupBy(*page).agg(
        F.count(F.lit(1)).alias("listed"), F.count_if(F.coalesce(identified, F.lit(False))).alias("extracted")
    )
    kept = unique_rows.groupBy(*page).agg(F.count(F.lit(1)).alias("unique_items"))
    both = counts.join(kept, list(page), "left").withColumn("unique_items", F.coalesce("unique_items", F.lit(0)))
    return both.withColumn("skipped_duplicates", F.col("extracted") - F.col("unique_items"))


def items_per_page(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("items"))


def cleanup_report(items: DataFrame, expired: Column, deleted: Column, failed: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Expired before, deleted, failures and expired left over."""
    return items.groupBy(*keys).agg(
        F.count_if(expired).alias("expired_before"),
        F.count_if(expired & deleted).alias("deleted"),
        F.count_if(expired & failed).alias("failures"),
        F.count_if(expired & ~deleted).alias("remaining_expired"),
    )


def distinct_in_order(df: DataFrame, key: str, order: str) -> DataFrame:
    """Distinct values with the position of their first occurrence."""
    return df.groupBy(key).agg(F.min(order).alias("first_pos"))


def blocked_queries(df: DataFrame, keys: Sequence[str], status: str = "status") -> DataFrame:
    """Queries whose rows are all blocked or failed in transport."""
    return df.groupBy(*keys).agg(F.bool_and(F.col(status).isin("blocked", "transport_error")).alias("query_blocked"))


def stop_after_blocked(df: DataFrame, run: str, index: str, status: str = "status") -> DataFrame:
    """Rows up to and including the first wholly blocked query of each run.

    Two small aggregations give the stop index per run; rows are then filtered by a join, so
    no run is collected into one window.
    """
    verdict = blocked_queries(df, [run, index], status)
    stop = verdict.filter("query_blocked").groupBy(run).agg(F.min(index).alias("_stop"))
    joined = df.join(stop, run, "left")
    return joined.filter(F.col("_stop").isNull() | (F.col(index) <= F.col("_stop"))).drop("_stop")


def capacity_bounds(df: DataFrame, keys: Sequence[str], tags: Column | str = "tags") -> DataFrame:
    """Per key the largest and smallest of the rows' largest capacity tag in GB: upper_gb, lower_gb."""
    tags = F.col(tags) if isinstance(tags, str) else tags
    sizes = F.transform(tags, lambda t: F.regexp_extract(t, "([0-9]+)GB", 1).try_cast("int"))
    rows = df.select(*keys, F.array_max(sizes).alias("gb"))
    return rows.groupBy(*keys).agg(F.max("gb").alias("upper_gb"), F.min("gb").alias("lower_gb"))
