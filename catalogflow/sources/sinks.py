"""Writers. Files are written by the tasks that hold the rows; nothing passes the driver."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import iso_utc, run_stamp
from ..session import stored

# Headers of the published component tables.
MEMORY_COLUMNS = {
    "商品番号": "product_number", "メーカー名": "maker_name", "商品名": "product_name", "商品画像URL": "image_url",
    "元価格(円)": "original_price_yen", "最終価格(円)": "final_price_yen", "在庫": "in_stock_label",
    "セール期間": "sale_period_raw", "セール終了推定(JST)": "sale_end_guess_jst", "メモリ種別": "memory_type_label",
    "容量(GB)": "memory_capacity_gb", "速度": "memory_speed", "枚数": "sticks", "URL": "url",
}
SSD_COLUMNS = {
    "商品番号": "product_number", "メーカー名": "maker_name", "商品名": "product_name", "商品画像URL": "image_url",
    "元価格(円)": "original_price_yen", "最終価格(円)": "final_price_yen", "在庫": "in_stock_label",
    "セール期間": "sale_period_raw", "セール終了推定(JST)": "sale_end_guess_jst", "容量(GB)": "capacity_gb",
    "容量(表示)": "capacity_text", "インターフェース": "interface_text", "フォームファクタ": "form_factor",
    "タグ": "tags_text", "URL": "url", "取得元URL": "source_url",
}
FORMATS = ("csv", "jsonl")
# Without these Spark trims cells, and the sold-out cell ends in a blank.
CSV_CELLS = {
    "quote": '"', "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
SOLD_OUT_CELL = "売り切れ "
VARIATION_CELL = "バリエーション有り"


def component_columns(df: DataFrame, kind: str) -> DataFrame:
    """The published columns under their fixed headers; whole capacities without decimals."""
    names = {"memory": MEMORY_COLUMNS, "ssd": SSD_COLUMNS}[kind]
    return df.select(*[_number_text(df, c).alias(header) for header, c in names.items()])


def _number_text(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.DoubleType):
        whole = c == F.floor(c)
        return F.when(whole, F.floor(c).cast("string")).otherwise(c.cast("string"))
    return c


def write_component_csv(df: DataFrame, kind: str, path: str) -> None:
    """Cells quoted only where needed, under the fixed header."""
    component_columns(df, kind).write.mode("overwrite").options(header="true", nullValue="", **CSV_CELLS).csv(path)


def snapshot_cells(df: DataFrame) -> DataFrame:
    """All cells as text: times in UTC ISO form, NULL as ''."""
    cells = []
    for field in df.schema.fields:
        c = F.col(field.name)
        text = iso_utc(c) if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)) else c.cast("string")
        cells.append(F.coalesce(text, F.lit("")).alias(field.name))
    return df.select(*cells)


def mall_snapshot(df: DataFrame) -> DataFrame:
    """The seven positional columns of a mall snapshot."""
    return df.select(
        "jan", "title", "price", "points", "crawled_at",
        F.when(F.col("soldout"), SOLD_OUT_CELL).alias("soldout_label"),
        F.when(F.col("has_variation"), VARIATION_CELL).alias("variation_label"),
    )


def write_snapshot_csv(df: DataFrame, path: str) -> None:
    """Headerless CSV with every cell quoted. Spark writes no byte-order mark and ends the last line."""
    snapshot_cells(df).write.mode("overwrite").options(quoteAll="true", **CSV_CELLS).csv(path)


def flatten_for_csv(df: DataFrame) -> DataFrame:
    """Nested values as JSON text, booleans as true/false, times in ISO form, NULL as ''."""
    cells = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            text = F.to_json(c, {"ignoreNullFields": "false"})
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            text = iso_utc(c)
        else:
            text = c.cast("string")
        cells.append(F.coalesce(text, F.lit("")).alias(field.name))
    return df.select(*cells)


def write_market_csv(df: DataFrame, path: str) -> None:
    flatten_for_csv(df).write.mode("overwrite").options(header="true", quoteAll="true", **CSV_CELLS).csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object per line, NULL fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def output_formats(formats: Sequence[str] | None) -> list[str]:
    """Known formats, distinct, in order; both when the setting is empty."""
    if not formats:
        return list(FORMATS)
    return list(dict.fromkeys(f for f in formats if f in FORMATS))


def write_run(df: DataFrame, root: str, target: str, stamp: str, formats: Sequence[str] | None = None) -> list[str]:
    """Write one run under ``<root>/<target>_<stamp>.<format>``; returns the paths. The rows are computed once for all formats."""
    paths, kinds = [], output_formats(formats)
    df = stored(df) if len(kinds) > 1 else df
    for kind in kinds:
        path = f"{root}/{target}_{stamp}.{kind}"
        (write_market_csv if kind == "csv" else write_jsonl)(df, path)
        paths.append(path)
    return paths


def append_run_table(df: DataFrame, root: str, target: Column | str, run_at: Column | str) -> None:
    """Put a run into a table partitioned by target and run stamp; a repeated run replaces its own partitions.

    Rows of a partition are gathered before the write; a large one is split over several tasks, small ones share a task.
    """
    target = F.col(target) if isinstance(target, str) else target
    stamped = df.withColumns({"target": target, "run_ts": run_stamp(run_at)}).hint("rebalance", "target", "run_ts")
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("target", "run_ts").parquet(root)


def publish_latest(df: DataFrame, path: str, at_least: int = 0, message: str = "too few rows to publish") -> int:
    """Publish the rows as the newest version under ``path``; readers see the old one until the new one is complete. Returns the number of rows.

    Each version has a folder of its own. The list of published versions gets its entry after the write, as one file that
    appears at once; a failed or repeated run leaves at most a folder that nothing points to. ``df`` may read from ``path``.
    The rows are counted while they are written; with fewer than ``at_least`` nothing is published and the run fails.
    """
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    written = written_rows(df, lambda rows: rows.write.parquet(f"{path}/versions/{version}"))
    if written < at_least:
        raise ValueError(f"{message}: {written} of {at_least}")
    df.sparkSession.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(f"{path}/published")
    return written


def written_rows(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write the rows; the number of rows as the write itself has observed it, without another pass."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the version published last."""
    version = spark.read.schema("version STRING").parquet(f"{path}/published").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{path}/versions/{version}")


def run_manifest(df: DataFrame, scraped_at: Column, source: str = "source_url", keys: Sequence[str] = ()) -> DataFrame:
    """Per key: time, number of distinct sources, row count. The items stay a table."""
    return df.groupBy(*keys).agg(
        F.max(iso_utc(scraped_at)).alias("scraped_at"), F.countDistinct(source).alias("source_count"),
        F.count(F.lit(1)).alias("count"),
    )


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """The rows, stored; fails when there is none. The plan runs once: the write counts them, and a later step reads what was stored."""
    rows = []
    if not written_rows(df, lambda d: rows.append(stored(d))):
        raise ValueError(message)
    return rows[0]
