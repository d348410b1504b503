"""The driver's order tables read as raw reviews and raw items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.functions.times import review_date
from reviewmart.schemas import RAW_ITEM, RAW_REVIEW


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order line is a review of its part by the order's customer."""
    lines, orders = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders")
    order_ms = F.call_function(
        "div", F.unix_micros(F.col("o_orderdate").cast("timestamp")), F.lit(1000)
    )
    second_of_day = (F.col("l_orderkey") * 7919) % 86400
    part = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    no_rating = (F.col("l_linenumber") == 7) & (F.col("l_quantity") > 45)
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return joined.select(
        (order_ms + second_of_day * 1000 + 123).alias("timestamp"),
        F.when(no_rating, None).otherwise(F.lit(1) + F.col("l_quantity") % 5).alias("rating"),
        F.col("l_linenumber").cast("long").alias("helpful_votes"),
        F.col("l_linestatus").alias("title"),
        F.lit(None).cast("string").alias("text"),
        F.concat(part, F.lit("-"), F.col("l_suppkey").cast("string")).alias("asin"),
        (F.col("l_returnflag") == "N").alias("verified_purchase"),
        part.alias("parent_asin"),
        F.when(F.col("o_custkey") % 97 == 0, None)
        .otherwise(F.concat(F.lit("U"), F.col("o_custkey").cast("string")))
        .alias("user_id"),
    ).select(RAW_REVIEW.fieldNames())


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part is an item; prices come in the several notations of the raw files."""
    price = F.col("p_retailprice").cast("string")
    notation = F.col("p_partkey") % 6
    size = F.col("p_size") % 5
    labels = F.array(F.array("p_type", "p_brand"))
    return _table(spark, sf_dir, "part").select(
        F.col("p_type").alias("main_category"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("parent_asin"),
        (F.lit(1) + size).cast("double").alias("average_rating"),
        (F.col("p_size") * 10).cast("double").alias("rating_number"),
        F.when(notation == 1, "—")
        .when(notation == 2, F.concat(F.lit("$"), price))
        .when(notation == 3, F.concat(F.lit("from "), price))
        .when(notation == 4, F.concat(F.lit("$1,"), price))
        .when(notation == 5, price)
        .alias("price"),
        F.when(size == 1, F.array().cast("array<array<string>>"))
        .when(size > 1, labels)
        .alias("categories"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("store"),
    ).select(RAW_ITEM.fieldNames())


def holidays(staged_reviews: DataFrame) -> DataFrame:
    """A holiday list for the days reviews were written on: New Year and Christmas."""
    day = review_date(F.col("timestamp"))
    named = F.when((F.month("date") == 1) & (F.dayofmonth("date") == 1), "New Year").when(
        (F.month("date") == 12) & (F.dayofmonth("date") == 25), "Christmas"
    )
    days = staged_reviews.select(day.alias("date")).distinct()
    return days.withColumn("name", named).where(F.col("name").isNotNull())
