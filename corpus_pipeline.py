"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next.

1. quality: the byte convolution learns from ``labels`` (rows of every fold, as nothing is held out here) and rejects documents that score
   below the threshold.
2. exact: of documents equal after lower-casing A to Z the one with the largest id stays.
3. near: of documents whose words are alike by 0.8 or more, or linked through such, the one with the smallest id stays.
4. suffix: every byte covered by a string of 100 bytes that also starts earlier goes; documents stay, if need be empty.
5. packing: what is left, tokenised, in sequences of 4,096 tokens.

Stages 1 to 4 return the columns of documents. What each stage does with null or empty texts, repeated rows and empty tables stands in its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalogflow.llm.common import read_table, shared_folder
from catalogflow.llm.exact_dedup import exact_dedup_rows
from catalogflow.llm.near_dedup import near_dedup
from catalogflow.llm.packing import pack
from catalogflow.llm.quality import quality_filter, train_quality
from catalogflow.llm.suffix_dedup import remove_repeats

CAPACITY, END_ID = 4096, 1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs, train_quality(docs, read_table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup_rows(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def suffix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), "word", END_ID, CAPACITY)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("suffix", suffix), ("packing", packing)]
#: No SQL can state the first stage (a trained network); the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are stored in the shared folder."""
    rows = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = shared_folder(spark, f"stage-{name}")
        rows = stage(spark, rows, sf_dir)
        kind = rows.schema
        rows.write.parquet(folder)
        rows = spark.read.schema(kind).parquet(folder)
    return rows
