import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RAW = (
    "id bigint, Time_spent_Alone double, Social_event_attendance double, Going_outside double, "
    "Friends_circle_size double, Post_frequency double, Stage_fear string, "
    "Drained_after_socializing string, Personality string"
)


@pytest.fixture(scope="session")
def survey(spark):
    """Twelve hand-made rows with gaps, untidy answers and both labels."""
    rows = [
        (1, 4.0, 6.0, 5.0, 10.0, 7.0, "No", "no", "Extrovert"),
        (2, 9.0, 1.0, 2.0, 3.0, 1.0, "Yes", "YES ", "Introvert"),
        (3, None, 7.0, 6.0, 12.0, 8.0, " n", None, "Extrovert"),
        (4, 0.0, 8.0, 7.0, None, 20.0, None, "0", "Extrovert"),
        (5, 20.0, None, 1.0, 2.0, 0.0, "true", "1", "Introvert"),
        (6, 2.0, 9.0, None, 14.0, 9.0, "maybe", "No", "Extrovert"),
        (7, 25.0, 0.0, 0.0, 1.0, None, "y", "y", "Introvert"),
        (8, 3.0, 5.0, 5.0, 9.0, 6.0, "False", "no", "Extrovert"),
        (9, 10.0, 2.0, 3.0, 4.0, 2.0, "yes", "Yes", "Introvert"),
        (10, 1.0, 8.0, 7.0, 13.0, 10.0, None, None, "Extrovert"),
        (11, 5.0, 4.0, 4.0, 8.0, 5.0, "no", "no", "Extrovert"),
        (12, 8.0, 3.0, 2.0, 5.0, 3.0, "Yes", "yes", "Introvert"),
    ]
    return spark.createDataFrame(rows, RAW).cache()


def values(df, column, key="id"):
    return {r[key]: r[column] for r in df.select(key, column).collect()}
