from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession


def make_session() -> SparkSession:
    work = tempfile.mkdtemp(prefix="geoalloc-")
    spark = (SparkSession.builder.master("local[8]").appName("geoalloc-tests")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.warehouse.dir", f"{work}/warehouse").config("spark.checkpoint.dir", f"{work}/checkpoints")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()
