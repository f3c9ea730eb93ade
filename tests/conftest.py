import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
try:
    import duckdb  # noqa: F401
except ImportError:
    sys.path.insert(0, "/opt/oracle")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (SparkSession.builder.master("local[8]").appName("tierwarden-tests")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "6g"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session


@pytest.fixture(scope="session")
def fixture(spark):
    from fixture import Fixture
    return Fixture(spark)
