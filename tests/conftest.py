import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="logweir-"))
    yield spark
    spark.stop()
