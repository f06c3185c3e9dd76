"""Helpers shared by the corpus operators: stored tables, bounded Arrow batches, row order."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.session import ensure_checkpoint_dir, ship_package

#: Bytes of text that a Python stage holds as strings at a time.
SLICE_BYTES = 2 << 20


#: Bytes of text that a stage holds at a time whose arrays are many times as large as its text.
LEAN_BYTES = 1 << 19
#: Caches that Python workers keep from task to task; each module adds its own.
WORKER_CACHES: list[dict] = []


def release_caches() -> None:
    """Called as a task of another operator starts: the worker gives up what earlier operators kept in memory."""
    for cache in WORKER_CACHES:
        cache.clear()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored_table(df: DataFrame, name: str, folders: list[str] | None = None) -> DataFrame:
    """The rows written as Parquet to the shared folder and read from there: lineage ends here.

    Shuffle files of the write are of no use after it, so they are removed as it ends. The table's folder is added to ``folders``, for
    ``drop_tables``.
    """
    spark = df.sparkSession
    folder, before = shared_folder(spark, name), spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(_CLEANUP, before)
    if folders is not None:
        folders.append(folder)
    return spark.read.schema(df.schema).parquet(folder)


def drop_tables(spark: SparkSession, folders: list[str]) -> None:
    """Remove stored tables that nothing reads any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def from_files(docs: DataFrame) -> DataFrame:
    """The rows themselves where each has its place in a file, else stored, so that each has one."""
    try:
        docs.select(docs.metadataColumn("_metadata"))
        return docs
    except AnalysisException as error:
        if "_metadata" not in str(error):
            raise
        return stored_table(docs, "located")


def located(docs: DataFrame, *columns: Column) -> DataFrame:
    """The columns given and ``_at``, the place (file and row) of each row; rows that come from no file are stored first."""
    docs = from_files(docs)
    place = docs.metadataColumn("_metadata")  # the reader's, also where the table has a column of this name
    return docs.select(*columns, F.struct(place["file_path"].alias("file"), place["row_index"].alias("row")).alias("_at"))


def python_ready(spark: SparkSession) -> None:
    """Send the package to the executors, so that Python stages can import it there."""
    ship_package(spark)


def whole_text(column: str = "text") -> Column:
    """The text, an empty one for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def pack_row(df: DataFrame) -> Column:
    """All columns in one struct, so that columns an operator adds cannot clash with them."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns]).alias("_row")


def unpack_row(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("_row").getField(c).alias(c) for c in columns])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a string or binary column; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if not n or offsets is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, kind, n + 1, column.offset * kind().itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of at most ``most`` bytes each; a longer row is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def held_out(folds: int, fold: int, column: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves this remainder; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds == fold
