from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from catalogflow.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column over one row of named values."""

    def run(make, **values):
        ddl = ", ".join(f"{k} {'ARRAY<STRING>' if isinstance(v, list) else 'BIGINT' if isinstance(v, int) else 'STRING'}" for k, v in values.items())
        frame = spark.createDataFrame([tuple(values.values())], ddl)
        return frame.select(make().alias("x")).first()["x"]

    return run
