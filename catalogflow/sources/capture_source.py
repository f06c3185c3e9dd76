"""Capture folders as a data source: directories that a filter rules out are neither listed nor opened.

    spark.dataSource.register(CaptureSource)
    spark.read.format("captures").load(root).filter("run_stamp = '2024-07-05_01-02-03'")

Layout: ``<root>/<project>/<target>/<run stamp>/[<label>/]<file>``. Filters on project, target and run stamp (equality, lists, and ranges of stamps, whose
text order is their time order) are taken over by the source. Folders are listed level by level on the driver; files are dealt to tasks by size
and opened there. Works on any store that Arrow's file systems reach; the tasks read what the driver lists.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..session import ship_package
from .captures import parse_capture_meta

LEVELS = ("project", "target", "run_stamp")
STAMP = re.compile(r"\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}")
COMPARE = {GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le}
#: Bytes of files that one task reads, and that one batch holds.
TASK_BYTES, BATCH_BYTES = 64 << 20, 8 << 20
SCHEMA = "path string, capture_dir string, project string, target string, run_stamp string, label string, size bigint, text string"


def file_system(root: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder and the folder's path in it."""
    local = re.match(r"file:/*(/.*)$", root)
    if local or "://" not in root:
        return fs.LocalFileSystem(), local.group(1) if local else root
    return fs.FileSystem.from_uri(root)


@dataclass
class Files(InputPartition):
    """What one task opens: (path, size) each."""

    entries: list[tuple[str, int]]


class CaptureReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.pattern = options["path"].rstrip("/"), options.get("pattern", "*.html")
        self.tests: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in LEVELS and isinstance(f, EqualTo):
                self.tests.append((name, lambda v, want=f.value: v == want))
            elif name in LEVELS and isinstance(f, In):
                self.tests.append((name, lambda v, want=frozenset(f.value): v in want))
            elif name == "run_stamp" and type(f) in COMPARE:
                self.tests.append((name, lambda v, want=f.value, how=COMPARE[type(f)]: how(v, want)))
            else:
                yield f

    def _passes(self, level: str, value: str) -> bool:
        return all(test(value) for name, test in self.tests if name == level)

    def partitions(self) -> list[InputPartition]:
        store, root = file_system(self.root)
        folders = [root]
        for level in LEVELS:
            listed = [e for f in folders for e in store.get_file_info(fs.FileSelector(f, allow_not_found=True)) if e.type == fs.FileType.Directory]
            folders = [e.path for e in listed if self._passes(level, e.base_name) and (level != "run_stamp" or STAMP.fullmatch(e.base_name))]
        files = [(e.path, e.size) for f in folders for e in store.get_file_info(fs.FileSelector(f, recursive=True))
                 if e.type == fs.FileType.File and fnmatch(e.base_name, self.pattern)]
        parts, held = [], 0
        for path, size in sorted(files):
            if not parts or held + size > TASK_BYTES:
                parts.append(Files([]))
                held = 0
            parts[-1].entries.append((path, size))
            held += size
        return parts or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, root = file_system(self.root)
        schema = pa.schema([("size", pa.int64()) if c.split()[0] == "size" else (c.split()[0], pa.string()) for c in SCHEMA.split(", ")])
        rows, held = [], 0
        for path, size in partition.entries:
            with store.open_input_stream(path) as file:
                text = file.read().decode("utf-8", "replace")
            parts = path[len(root):].strip("/").split("/")
            whole = f"{self.root}/{'/'.join(parts)}"
            rows.append((whole, whole.rpartition("/")[0], *parts[:3], parts[3] if len(parts) > 4 else None, size, text))
            held += size
            if held >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class CaptureSource(DataSource):
    """Options: the folder, and ``pattern`` of the file names (default ``*.html``)."""

    @classmethod
    def name(cls) -> str:
        return "captures"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return CaptureReader(self.options)


def read_capture_files(spark: SparkSession, root: str, pattern: str = "*.html") -> DataFrame:
    """Files of a capture folder with their path fields and text; filters on project, target and run stamp prune folders."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CaptureSource)
    return spark.read.format("captures").option("pattern", pattern).load(root)


def read_capture_meta_files(spark: SparkSession, root: str) -> DataFrame:
    """Capture metadata with the path fields of its directory, pruned like the pages."""
    rows = read_capture_files(spark, root, "*metadata.json")
    return rows.select("capture_dir", F.col("project").alias("dir_project"), F.col("target").alias("dir_target"), "run_stamp", "label", parse_capture_meta("text").alias("meta"))


def write_capture_files(rows: DataFrame, root: str) -> int:
    """Write each row's ``text`` as the file ``name`` below ``root``; tasks write, and a repeated task writes the same files. Returns the number of files."""
    ship_package(rows.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = file_system(root.rstrip("/"))
        number = 0
        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                path = f"{folder}/{name}"
                store.create_dir(path.rpartition("/")[0], recursive=True)
                with store.open_output_stream(path) as file:
                    file.write((text or "").encode())
                number += 1
        yield pa.RecordBatch.from_arrays([pa.array([number])], ["n"])

    return rows.select("name", "text").mapInArrow(write, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
