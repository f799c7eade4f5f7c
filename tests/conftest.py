import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from retailoom.session import apply_settings  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    apply_settings(session)
    yield session
    session.stop()


def rows_of(frame):
    """Rows as sorted tuples."""
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def records(frame, *key):
    """Rows as dicts by key."""
    return {tuple(row[k] for k in key): row.asDict() for row in frame.collect()}
