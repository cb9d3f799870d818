import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tableprofile-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def readings(spark):
    """Weather stations; the temperature and the place of one are missing. Rain is twice the temperature plus four where both are there."""
    rows = [(4.0, 12, "hill"), (8.0, 20, "hill"), (None, 31, None), (6.0, 16, "coast"), (2.0, 8, "hill")]
    return spark.createDataFrame(rows, "temp double, rain bigint, place string")


@pytest.fixture
def one_unit(spark):
    """Six sensors that all report in the same unit."""
    return spark.createDataFrame([(k, "celsius", k * k / 4) for k in range(1, 7)], "sensor bigint, unit string, level double")


@pytest.fixture
def mostly_distinct(spark):
    """120 parcels with 110 different codes; the code of parcel 7 is on eleven of them."""
    return spark.createDataFrame([(i, f"code {i if i < 110 else 7}", 0.5 + i / 8) for i in range(120)], "nr bigint, code string, weight double")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "number double, word string, flag boolean")
