import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TESTDATA = Path("/root/testdata")


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
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = TESTDATA / "sf0.001"
    if not path.exists():
        pytest.skip("test tables are not available")
    return str(path)


@pytest.fixture
def shuffle_partitions(spark):
    """Sets the number of shuffle partitions for one test."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    yield lambda n: spark.conf.set(key, n)
    spark.conf.set(key, before)
