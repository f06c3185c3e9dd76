"""Readers: captured pages, capture metadata, snapshots, runs, file listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CAPTURE_META


def read_pages(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """A parquet table of captured pages. ``tasks`` deals them out anew by id, for tables that lie in few splits: reading a page is heavy work beside its bytes."""
    pages = spark.read.parquet(path)
    return pages.repartition(tasks, "page_id") if tasks else pages


#: How run stamps are spelled.
STAMP_FORMAT = "yyyy-MM-dd_HH-mm-ss"
# ``<root>/<project>/<target>/<stamp>/<label>/page.html`` or ``source-NN-page-NN.html``
VISIT_PATH = r"([^/]+)/([^/]+)/(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})(?:/([^/]+))?/[^/]+$"
LIST_FILE = r"source-(\d+)-page-(\d+)\.html$"


def capture_path_fields(path: Column | str) -> list[Column]:
    """Columns that a capture's path spells out: directory, project, target, run stamp, label, source and page."""
    c = F.col(path) if isinstance(path, str) else path

    def part(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))

    return [
        F.regexp_replace(c, "/[^/]*$", "").alias("capture_dir"),
        part(VISIT_PATH, 1).alias("project"), part(VISIT_PATH, 2).alias("target"), part(VISIT_PATH, 3).alias("run_stamp"),
        part(VISIT_PATH, 4).alias("label"), part(LIST_FILE, 1).cast("int").alias("source_pos"),
        part(LIST_FILE, 2).cast("int").alias("page_no"),
    ]


def read_captures(spark: SparkSession, root: str) -> DataFrame:
    """Saved HTML files, one row per file: page_id (128-bit hash of the path), path fields, html."""
    files = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").text(root, wholetext=True)
    )
    located = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    return located.select(F.md5(F.col("path").cast("binary")).alias("page_id"), "path", *capture_path_fields("path"), "html")


def parse_capture_meta(text: Column | str) -> Column:
    """Capture metadata of one JSON text; NULL fields for text that is no JSON."""
    return F.from_json(F.col(text) if isinstance(text, str) else text, CAPTURE_META)


def read_capture_meta(spark: SparkSession, root: str) -> DataFrame:
    """Capture metadata files with their directory, which joins them to the captured page."""
    files = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*metadata.json").text(root, wholetext=True)
    )
    meta = files.select(parse_capture_meta("value").alias("m"), F.col("_metadata.file_path").alias("path"))
    return meta.select("m.*", F.regexp_replace("path", "/[^/]*$", "").alias("capture_dir"))


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Run-snapshot CSV without header: quoted cells, doubled quotes, line breaks in cells, ragged rows, mark at the start."""
    return spark.read.csv(path, schema=schema, quote='"', escape='"', multiLine=True, mode="PERMISSIVE")


def read_jsonl_run(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_listing(spark: SparkSession, root: str) -> DataFrame:
    """Files under a folder with size and time; the content is never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.col("modificationTime").alias("modified_at"), "length", F.lit(False).alias("is_dir"))
