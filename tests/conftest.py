import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def impressions(spark):
    """Six hand-made rows; price_index is still unscaled."""
    rows = [
        (1, "1", "a1", "4", 0.01234),
        (2, "0", "a2", "8", 0.5),
        (3, "0", "a1", "4", 0.5),
        (4, "1", "a3", "9", 0.02),
        (5, "0", "a2", "4", 0.01234),
        (6, "0", "a1", "8", 0.9),
    ]
    return spark.createDataFrame(rows, "rid int, label string, article string, shelf string, price_index double")


@pytest.fixture(scope="session")
def scaled(impressions):
    from ctrprep.sources.tables import extract

    return extract(impressions, impressions.columns, ["s", "s", "s", "s", "f"]).cache()


@pytest.fixture(scope="session")
def lineitem(spark):
    return spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
