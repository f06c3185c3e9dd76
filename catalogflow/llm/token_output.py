"""Token ids as Parquet: one list column per document, written for selective reads.

``write_tokens`` sorts documents by id over ranges, encodes them and lets Spark write Parquet with ids in
dictionary pages (16 bits an id for a 50,000-word vocabulary), numbers in delta pages, row groups and pages of
a stated size and page indexes. ``read_tokens`` reads the columns and id range asked for. ``token_index`` reads
the files back and gives every document its place in the whole stream of ids.

Null texts and null ids: a null text is an empty one (only the end id), null ids come first. Rows that share an
id lie next to each other in the order of their place in the files read. An empty table gives files without
rows. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import located, python_ready, read_table, shared_folder, slices, text_bytes, whole_text
from .pieces import encoder

ROWS = "part int, doc_id long, start_in_part long, n_tokens long, ids array<int>"
#: Writer settings: version 2 pages bring delta encoding, doc_id and counts skip the dictionary for it.
LAYOUT = {
    "parquet.writer.version": "v2",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#start_in_part": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.page.write-checksum.enabled": "true",
}


def with_end(ids: np.ndarray, lens: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text; lengths grow by one."""
    ends = np.cumsum(lens + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    last = np.zeros(len(out), bool)
    last[ends - 1] = True
    out[last], out[~last] = end_id, ids
    return out, lens + 1


def _encode(path: str, style: str, end_id: int):
    def run(batches):
        model, part, start = encoder(path, style), TaskContext.get().partitionId(), 0
        for batch in batches:
            text = batch.column("text")
            _, offsets = text_bytes(text)
            for lo, hi in slices(offsets):
                ids, lens = with_end(*model.encode(text.slice(lo, hi - lo).to_pylist()), end_id)
                ends = np.cumsum(lens)
                lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), ids.view(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(hi - lo, part, np.int32)), batch.column("doc_id").slice(lo, hi - lo),
                     pa.array(start + ends - lens), pa.array(lens), lists],
                    ["part", "doc_id", "start_in_part", "n_tokens", "ids"])
                start += int(ends[-1])
    return run


def write_tokens(docs: DataFrame, folder: str, path: str, style: str, end_id: int, layout: dict[str, str] | None = None) -> None:
    """Encode (doc_id, text) rows in ascending doc_id order and write them below ``folder``."""
    python_ready(docs.sparkSession)
    rows = located(docs, F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    # ranges are sampled from ids and places, so texts are read once; rows of one id may lie in several ranges
    order = ["doc_id", F.xxhash64("_at.file"), "_at.row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    rows.mapInArrow(_encode(path, style, end_id), ROWS).write.options(**(layout or LAYOUT)).parquet(folder)


def read_tokens(spark: SparkSession, folder: str, columns: list[str] | None = None,
                first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """The stored columns asked for, of documents in an id range; row groups and pages outside it are skipped."""
    rows = spark.read.schema(ROWS).parquet(folder)
    if first_id is not None:
        rows = rows.filter(F.col("doc_id") >= first_id)
    if last_id is not None:
        rows = rows.filter(F.col("doc_id") <= last_id)
    return rows.select(*columns) if columns else rows


def _checksums(batches):
    for batch in batches:
        lists = batch.column("ids")
        at = np.asarray(lists.offsets)
        data = memoryview(np.ascontiguousarray(np.asarray(lists.values)).astype("<i4", copy=False)).cast("B")
        sums = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("part", "doc_id", "start_in_part")), pa.array(np.diff(at).astype(np.int64)), pa.array(sums, pa.int64())],
            ["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of all documents, from the files.

    A file's first place is the sum of the counts of the files before it: one small row per file, so that
    only this list of files meets in one task.
    """
    parts = read_tokens(spark, folder, ["part", "n_tokens"]).groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = read_tokens(spark, folder).mapInArrow(_checksums, "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long")
    return rows.join(parts.select("part", before.alias("first")), "part").select(
        "doc_id", (F.col("first") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum in the token files, end id included."""
    import public_tokenizers

    folder = shared_folder(spark, "tokens")
    write_tokens(read_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), "byte", 0)
    return token_index(spark, folder)
