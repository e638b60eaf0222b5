"""One local session for the whole test run."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from quartermill.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame("a int, b string", [(1, "x")])`` as a DataFrame."""

    def make(schema: str, rows: list):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def rows():
    """Sorted plain rows of a DataFrame (NULLs last)."""

    def get(df, *columns):
        out = (df.select(*columns) if columns else df).collect()
        return sorted((tuple(r) for r in out), key=lambda r: tuple((v is None, str(v)) for v in r))

    return get
