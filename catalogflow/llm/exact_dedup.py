"""Exact deduplication as a stateful stream over a folder of Parquet files.

The stream keeps one entry per digest in RocksDB state, on disk and without expiry: how many rows had it, and the
stable identifier and content locator (file and row) of the row that stays. Rows of a micro-batch are combined
per task before they meet the state, so a text with a third of all copies sends one row per task. After
the stream, the full bytes of every text that was hit are compared: smallest and largest text of a digest must be equal, which also
combines per task; should two texts share a digest, the rows concerned are grouped by the texts themselves.

Equal means identical after lower-casing A to Z. Null texts count as empty and are equal to empty ones. Of equal rows the one with the
largest id stays, a null id is smaller than any; of rows that also share the id, the one with the largest locator.
``exact_dedup_rows`` takes the rows of any table: its stream reads their digests and places, so that no texts are written again.
An empty folder of files gives no rows. Texts of any length are digested whole. Other columns are carried along unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_tables, from_files, located, pack_row, shared_folder, stored_table, unpack_row, whole_text

_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # Small stores in many partitions: no disk space set aside ahead of their logs.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Groups of copies are compared in this many parts before the parts meet.
_SALTS = 16


def normalised(column: str = "text") -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(whole_text(column), upper, upper.lower())


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _keyed(rows: DataFrame, digest) -> DataFrame:
    """Digest, identifier and locator of each row, with the text that was digested."""
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("_norm"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("_at"),
    ).withColumn("_digest", digest(F.col("_norm")))


def _keeper() -> list[Column]:
    return [F.max(F.struct("doc_id", "_at")).alias("keeper"), F.count(F.lit(1)).alias("group_size")]


def stream_groups(spark: SparkSession, source: str, schema, digest=sha256, files_per_trigger: int = 1000) -> DataFrame:
    """(_digest, keeper, group_size) of every digest below ``source``, from a stream that ends when all files are read.

    Without ``digest`` the files hold doc_id, _at and _digest already.
    State and progress lie in the shared folder: a stream that was broken off goes on from there. Each
    micro-batch writes the entries it changed to a folder of its number, so a repeated batch replaces its own.
    """
    folder = shared_folder(spark, "exact-dedup")
    before = {k: spark.conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
        # as a pattern, so that the source may be one file as well as a folder
        stream = stream.parquet(f"{source[:-1]}[{source[-1]}]")
        changed = (_keyed(stream, digest) if digest else stream).groupBy("_digest").agg(*_keeper())
        kind = changed.schema
        query = (
            changed.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{folder}/progress")
            .foreachBatch(lambda rows, batch: rows.write.mode("overwrite").parquet(f"{folder}/changed/batch={batch}")).start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if not query.lastProgress and not query.recentProgress:
        return spark.createDataFrame([], kind)
    entries = spark.read.schema(kind).option("recursiveFileLookup", "true").parquet(f"{folder}/changed")
    if len(query.recentProgress) == 1:
        return entries
    # a digest's last entry has its largest count; counts and keepers only grow
    return entries.groupBy("_digest").agg(F.max("keeper").alias("keeper"), F.max("group_size").alias("group_size"))


def _collided(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests that stand for more than one text, stored: full bytes of all rows that hit another one are compared."""
    hits = groups.filter("group_size > 1").select("_digest", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt"))
    salted = rows.select("_digest", "_norm", F.pmod(F.col("_at.row"), F.lit(_SALTS)).cast("int").alias("_salt"))
    part = salted.join(hits, ["_digest", "_salt"], "left_semi").groupBy("_digest", "_salt")
    part = part.agg(F.min("_norm").alias("lo"), F.max("_norm").alias("hi"))
    apart = part.groupBy("_digest").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo != hi").select("_digest")
    # stored, so that the shuffle files of the texts are gone before the next step moves them
    return stored_table(apart, "collided")


def exact_groups(spark: SparkSession, source: str, schema, digest=sha256, files_per_trigger: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(rows with their digest and locator, groups of equal texts keyed by ``_key``); ``_key`` is null-safe and exact."""
    groups = stream_groups(spark, source, schema, digest, files_per_trigger)
    return _exact_groups(_keyed(spark.read.schema(schema).parquet(source), digest), groups)


def _exact_groups(rows: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    collided = [r["_digest"] for r in _collided(rows, groups).take(1000)]
    if not collided:
        return rows.withColumn("_key", F.col("_digest")), groups.withColumnRenamed("_digest", "_key")
    if len(collided) == 1000:  # a digest that weak tells nothing: group every row by its text
        exact = F.encode("_norm", "utf-8")
    else:
        exact = F.when(F.col("_digest").isin(collided), F.encode("_norm", "utf-8")).otherwise(F.col("_digest"))
    rows = rows.withColumn("_key", exact)
    return rows, rows.groupBy("_key").agg(*_keeper())


def exact_duplicates(spark: SparkSession, source: str, schema, **settings) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    rows, groups = exact_groups(spark, source, schema, **settings)
    rows = rows.select("doc_id", "_at", "_key", F.sha2("_norm", 256).alias("text_sha256"))
    return rows.join(groups, "_key").select(
        "doc_id", F.col("keeper.doc_id").alias("keep_id"), "group_size",
        (F.col("keeper._at") == F.col("_at")).alias("kept"), "text_sha256")


def exact_dedup(spark: SparkSession, source: str, schema, **settings) -> DataFrame:
    """One row of each group of equal texts, with all columns of the folder's rows.

    The rows that stay are found by their locator, which no two rows share: copies do not meet anywhere.
    """
    _, groups = exact_groups(spark, source, schema, **settings)
    return _kept(spark.read.schema(schema).parquet(source), groups)


def exact_dedup_rows(docs: DataFrame, digest=sha256, **settings) -> DataFrame:
    """``exact_dedup`` of the rows given, with all their columns; rows that come from no file are stored first."""
    spark, docs = docs.sparkSession, from_files(docs)
    rows = located(docs, F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("_norm")).withColumn("_digest", digest(F.col("_norm")))
    digests = stored_table(rows.select("doc_id", "_at", "_digest"), "digests", folders := [])
    groups = stream_groups(spark, folders[0], digests.schema, None, **settings)
    drop_tables(spark, folders)
    return _kept(docs, _exact_groups(rows, groups)[1])


def _kept(docs: DataFrame, groups: DataFrame) -> DataFrame:
    kept = groups.select(F.col("keeper._at").alias("_at"))
    return unpack_row(located(docs, pack_row(docs)).join(kept, "_at", "left_semi"), docs.columns)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, keeper and digest of every document."""
    source = f"{sf_dir}/documents.parquet"
    return exact_duplicates(spark, source, spark.read.parquet(source).select("doc_id", "text").schema)


ORACLE = """
WITH rows AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), groups AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM rows JOIN groups USING (norm)
"""
