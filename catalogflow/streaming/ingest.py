"""Incremental ingest of captures: file streams that continue where they stopped."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.captures import STAMP_FORMAT, capture_path_fields, parse_capture_meta

#: State lives on disk and is uploaded as changes, so its size does not count in a batch. A join of streams has one store for each partition, not four: opening and
#: committing stores is what a small batch takes its time for. (A checkpoint that began with four goes on with four.)
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


#: Tasks for each core that list the folders below a folder, or the files of a batch. Spark starts one for each of up to 10,000 of them, which takes far longer
#: than the listing and lists no sooner: no more than one runs on a core. Folders are dealt out from the first level that has more of them than cores, or than
#: Spark's own 32: further down, every folder of that level would be a job of its own.
LISTING_TASKS, LISTING_FOLDERS = 2, 32


@contextmanager
def stream_settings(spark: SparkSession) -> Iterator[None]:
    """Streams that are named and run inside keep their state in RocksDB and list files in few tasks; the session's settings are put back."""
    cores = spark.sparkContext.defaultParallelism
    settings = STATE | {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(LISTING_TASKS * cores),
        "spark.sql.sources.parallelPartitionDiscovery.threshold": str(min(LISTING_FOLDERS, cores)),
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def capture_stream(
    spark: SparkSession, source: str, schema: T.StructType | str, files_per_batch: int = 1000
) -> DataFrame:
    """Files of a captures folder as a stream; ``files_per_batch`` bounds one batch, not the run."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)


def ingest_captures(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append everything that is new since the last run, then stop. Each file counts once. Returns the ended query."""
    with stream_settings(stream.sparkSession):
        query = (
            stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return query


#: Bounds of one batch of capture files, not of a run: bytes of pages, and number of metadata files, which are all small.
BATCH_BYTES, BATCH_FILES = 256 << 20, 50_000


def _files(spark: SparkSession, root: str, pattern: str, bound: tuple[str, int]) -> DataFrame:
    with stream_settings(spark):  # naming a folder lists it, to look for partition columns
        files = (
            spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", pattern).option(*bound).load(root)
        )
    return files.select(F.col("_metadata.file_path").alias("path"), "value")


def page_stream(spark: SparkSession, root: str, files_per_batch: int | None = None) -> DataFrame:
    """Saved HTML files as a stream: path fields, html and ``run_at``, the time that the run stamp of the path names.

    A batch is bounded by its bytes, or by the number of files if that is given: each batch has a cost of its own, so few small files a batch add up.
    """
    bound = ("maxFilesPerTrigger", files_per_batch) if files_per_batch else ("maxBytesPerTrigger", BATCH_BYTES)
    rows = _files(spark, root, "*.html", bound).select("path", *capture_path_fields("path"), F.col("value").alias("html"))
    return rows.withColumn("run_at", F.try_to_timestamp("run_stamp", F.lit(STAMP_FORMAT)))


def meta_stream(spark: SparkSession, root: str, files_per_batch: int = BATCH_FILES) -> DataFrame:
    """Capture metadata files as a stream: meta_dir, meta_at (the run stamp of the path) and the parsed metadata."""
    rows = _files(spark, root, "*metadata.json", ("maxFilesPerTrigger", files_per_batch)).select(*capture_path_fields("path")[:4], parse_capture_meta("value").alias("meta"))
    return rows.select(F.col("capture_dir").alias("meta_dir"), F.try_to_timestamp("run_stamp", F.lit(STAMP_FORMAT)).alias("meta_at"), "meta")


def pages_with_meta(pages: DataFrame, meta: DataFrame, wait: str = "1 day") -> DataFrame:
    """Each page with the metadata of its directory, whichever comes first; a page without metadata once runs that are ``wait`` later have come.

    Both sides are held as state keyed by directory until their partner comes or the watermark has passed, so the state is that of the last ``wait``.
    """
    left, right = pages.withWatermark("run_at", wait), meta.withWatermark("meta_at", wait)
    same = (F.col("capture_dir") == F.col("meta_dir")) & (F.col("run_at") == F.col("meta_at"))
    return left.join(right, same, "left_outer").drop("meta_dir", "meta_at")


def ingest_first_seen(stream: DataFrame, sink: str, checkpoint: str, key: str, order: Sequence[str]) -> StreamingQuery:
    """Keep the first row of each key over all increments, those of earlier checkpoints over the same sink included.

    Keyed state (RocksDB) holds the first row of every key and the time of the last batch that had one; the aggregation combines in the tasks before the
    shuffle, so a hot key is one row per task. A key is new in a batch if that batch is the only one that had it. The state begins with the rows of
    the sink, which are a second stream: each of its files is read once per checkpoint, so a batch costs what it brings, however much the sink holds.

    Folders are named by the stream's own id, which its checkpoint keeps, and the batch: a repeated batch rewrites its own folder only, and a new
    checkpoint over a filled sink starts folders of its own.
    """
    spark = stream.sparkSession
    try:
        spark.read.schema(stream.schema).parquet(sink)
    except AnalysisException:  # a sink that does not exist yet becomes an empty one
        spark.createDataFrame([], stream.schema).write.mode("append").parquet(f"{sink}/run_id=none/batch_id=-1")
    held = spark.readStream.schema(stream.schema).option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true").parquet(sink)
    columns = stream.columns
    rows = held.withColumn("_new", F.lit(False)).unionByName(stream.withColumn("_new", F.lit(True))).withColumn("_at", F.current_timestamp())
    first = F.min(F.struct("_new", "_at", *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)], F.struct(*columns).alias("row")))
    states = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(first.alias("first"), F.max("_at").alias("last"))

    def save(batch: DataFrame, batch_id: int) -> None:
        run_id = batch.sparkSession.read.schema("id STRING").json(f"{checkpoint}/metadata").first()["id"]
        fresh = batch.filter(F.col("first._new") & (F.col("first._at") == F.col("last"))).select("first.row.*")
        fresh.write.mode("overwrite").parquet(f"{sink}/run_id={run_id}/batch_id={batch_id}")

    with stream_settings(spark):
        query = (
            states.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return query
