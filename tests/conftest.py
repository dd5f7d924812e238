import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    tmp = tempfile.mkdtemp(prefix="spark-test-")
    session = (
        SparkSession.builder.master("local[4]").config("spark.driver.memory", "4g").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.local.dir", tmp).config("spark.checkpoint.dir", f"{tmp}/shared").config("spark.sql.warehouse.dir", f"{tmp}/warehouse").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
