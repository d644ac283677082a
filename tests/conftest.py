from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from stratalake.layout import Lake  # noqa: E402
from stratalake.plans.metadata import MetadataStore  # noqa: E402
from stratalake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return MetadataStore(spark, Lake(str(tmp_path)))


@pytest.fixture
def one(spark):
    """Evaluate a column function on literal inputs."""
    from pyspark.sql import functions as F

    def evaluate(function, *values, types=None):
        columns = []
        for i, value in enumerate(values):
            column = F.lit(value)
            columns.append(column.cast(types[i]) if types else column)
        return spark.range(1).select(function(*columns).alias("x")).first().x

    return evaluate
