from __future__ import annotations

import pytest
from corpus_rows import DOC, documents


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    return documents()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows, DOC).repartition(5).write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.fixture(scope="session")
def no_docs(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], DOC).write.parquet(folder)
    return spark.read.parquet(folder)
