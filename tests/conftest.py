import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reviewmart.session import apply_conf  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_conf(session)
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def reviews(spark):
    """Build cleaned reviews from (user, asin, time text[, rating[, verified]])."""
    from pyspark.sql import functions as F

    from reviewmart.plans.staging import stg_reviews

    def build(*rows):
        padded = [(*row, *(3.0, True)[len(row) - 3 :]) for row in rows]
        raw = spark.createDataFrame(
            padded,
            "user_id string, parent_asin string, at string, rating double, verified_purchase boolean",
        )
        ts = F.col("at").cast("timestamp")
        staged = raw.select(
            "*",
            ts.alias("timestamp"),
            F.lit(0).cast("long").alias("helpful_votes"),
            F.year(ts).alias("year"),
            F.month(ts).alias("month"),
            F.dayofmonth(ts).alias("day"),
        )
        return stg_reviews(staged)

    return build


@pytest.fixture
def items(spark):
    """Build items from (asin, price[, category])."""

    def build(*rows):
        from reviewmart.schemas import DIM_ITEMS

        full = [
            (asin, "title", rest[0] if rest else "Books", "shop", price, 4.0, 10.0)
            for asin, price, *rest in rows
        ]
        return spark.createDataFrame(full, DIM_ITEMS)

    return build


@pytest.fixture
def time(spark):
    from reviewmart.operators.calendar import calendar, dim_time

    return dim_time(calendar(spark))
