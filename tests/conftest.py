import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


PHOTO = "photo_id string, user_id string, ts string, roi string"


@pytest.fixture
def visits(spark):
    """Frame of photos from (photo_id, user_id, 'yyyy-MM-dd HH:mm:ss', roi) tuples."""
    from pyspark.sql import functions as F

    def make(rows):
        df = spark.createDataFrame(rows, PHOTO)
        return df.withColumn("timestamp", F.to_timestamp("ts")).drop("ts")

    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
