"""Snapshot lifecycle: what to prune, expire, upload, resume. Deleting stays with the caller."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import one_month_before
from ..functions.text import as_col, extract
from ..functions.urls import resume_page

# Run stamps in names, default number of kept runs.
STAMP = r"\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}"
SEGMENTED = rf"(?s)^(.+)_({STAMP})$"
DEFAULT_SEGMENT = "__default__"
KEEP_RUNS = 3


def keep_count(k: float | None) -> int:
    """Whole number of runs to keep; the default for a bad one."""
    return int(math.floor(k)) if k is not None and math.isfinite(k) and k >= 1 else KEEP_RUNS


def parse_run_name(path: Column | str, is_dir: Column | str) -> Column:
    """struct(segment, stamp) from ``<segment>_<stamp>``; NULL fields for another name.

    Files lose their extension first; directories may be a pure stamp.
    """
    name = F.substring_index(as_col(path), "/", -1)
    is_dir = as_col(is_dir)
    stem = F.when(is_dir, name).otherwise(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""))
    pure = is_dir & name.rlike(rf"^{STAMP}$")
    return F.struct(
        F.when(pure, DEFAULT_SEGMENT).otherwise(extract(stem, SEGMENTED, 1)).alias("segment"),
        F.when(pure, name).otherwise(extract(stem, SEGMENTED, 2)).alias("stamp"),
    )


def retention_marks(listing: DataFrame, k: float | None = KEEP_RUNS) -> DataFrame:
    """Listing rows with a run name, plus folder, segment, stamp and ``removable``.

    The newest ``k`` distinct stamps of each segment stay, with all their files. Distinct
    stamps are reduced per task before each shuffle, so a hot segment stays small.
    """
    n = keep_count(k)
    # A generator is a wall for filters: as a plain column the name pattern would run once per later use.
    run = F.struct(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), parse_run_name("path", "is_dir").alias("run"))
    named = listing.select("*", F.explode(F.array(run)).alias("_n")).select(
        *listing.columns, F.col("_n.folder").alias("folder"), "_n.run.segment", "_n.run.stamp"
    ).filter(F.col("stamp").isNotNull() & F.col("segment").isNotNull())
    keys = ["folder", "is_dir", "segment"]
    newest = Window.partitionBy(*keys).orderBy(F.desc("stamp"))
    stamps = named.select(*keys, "stamp").distinct()
    kept = stamps.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n)
    oldest_kept = kept.groupBy(*keys).agg(F.min("stamp").alias("_oldest"))
    return named.join(oldest_kept, keys).withColumn("removable", F.col("stamp") < F.col("_oldest")).drop("_oldest")


def removable_paths(listing: DataFrame, k: float | None = KEEP_RUNS) -> DataFrame:
    return retention_marks(listing, k).filter("removable").select("path")


def is_expired(modified_at: Column | str, is_dir: Column | str, now: Column | str) -> Column:
    """Files last changed more than one calendar month before ``now``."""
    older = as_col(modified_at) < one_month_before(now)
    return F.coalesce(~as_col(is_dir) & older, F.lit(False))


def upload_set(paths: DataFrame, existing: DataFrame, key: tuple[str, ...] = ("path",)) -> DataFrame:
    """Distinct requested paths (or path and key) that exist."""
    return paths.dropDuplicates(list(key)).join(existing.select("path"), "path", "left_semi")


def resume_state(snapshot: DataFrame, key: str) -> DataFrame:
    """One row: stored keys and the list page to continue from."""
    return snapshot.agg(F.count_if(F.length(F.trim(key)) > 0).alias("stored")).withColumn(
        "next_page", resume_page("stored")
    )
