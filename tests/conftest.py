import itertools
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tidegate-tests")
        .config("spark.sql.shuffle.partitions", "4")
        # Keep every shuffle partition, however small, so that groups do span partitions.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


_numbers = itertools.count()


@pytest.fixture
def target(tmp_path):
    """A fresh path for a table."""
    return str(tmp_path / f"table{next(_numbers)}")


@pytest.fixture
def name():
    """A fresh catalog table name."""
    return f"target{next(_numbers)}"


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
