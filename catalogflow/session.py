"""Session settings shared by the bench, the tests and batch jobs."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "catalogflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC times and adaptive execution (skew join and partition coalescing)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Pages are fat rows: fewer of them per batch bounds the memory of a Python worker.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        # Call-site capture doubles the time it takes to build long column expressions.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for ``checkpoint()``: the one the cluster names, else one for this local run.

    A session that is not local must name a shared folder in ``spark.checkpoint.dir``:
    a machine-local folder would be lost together with its executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return current
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="catalogflow-checkpoint-")
    context.setCheckpointDir(named)
    return named


def stored(df: DataFrame) -> DataFrame:
    """The rows written as Parquet to the shared checkpoint folder and read from there.

    Lineage is cut, so a lost executor costs nothing; later reads are pruned to the columns they use.
    """
    spark = df.sparkSession
    named = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    folder = f"{named.rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python stages can import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="catalogflow-ship-")) / "catalogflow_src.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent).as_posix())
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)
