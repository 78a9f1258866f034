import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="/tmp/run-"))
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="/tmp/run-")


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
