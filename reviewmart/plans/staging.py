"""Raw files to staged Parquet, and staged Parquet to the cleaned staging models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmart.functions.keys import review_id
from reviewmart.functions.numbers import clean_price, safe_double
from reviewmart.functions.times import ms_to_timestamp, ts_parts
from reviewmart.operators.rows import resolve_ts_column, select_columns, valid_reviews
from reviewmart.schemas import STAGED_ITEM, STAGED_REVIEW


def stage_reviews(raw: DataFrame, *more: str) -> DataFrame:
    """Type the review time and split it into year, month and day; ``more`` names columns to keep."""
    timed = raw.withColumn("timestamp_ms", resolve_ts_column(raw)).withColumn(
        "timestamp", ms_to_timestamp(F.col("timestamp_ms"))
    )
    split = timed.select("*", *ts_parts(F.col("timestamp")))
    return select_columns(split, *STAGED_REVIEW.fieldNames(), *more)


def stage_items(raw: DataFrame, *more: str) -> DataFrame:
    return select_columns(raw, *STAGED_ITEM.fieldNames(), *more)


def stg_reviews(staged: DataFrame) -> DataFrame:
    """Reviews with a rating and a time, keyed by ``review_id``; ``asin`` is the product family."""
    key = review_id(F.col("user_id"), F.col("parent_asin"), F.col("timestamp"))
    return valid_reviews(staged).select(
        key.alias("review_id"),
        F.col("parent_asin").alias("asin"),
        "user_id",
        "rating",
        "verified_purchase",
        "helpful_votes",
        "timestamp",
        F.col("year").cast("long"),
        F.col("month").cast("long"),
        F.col("day").cast("long"),
    )


def stg_items(staged: DataFrame) -> DataFrame:
    """Items with a numeric price; ``asin`` is the product family."""
    return staged.select(
        F.col("parent_asin").alias("asin"),
        F.col("main_category").alias("category"),
        "title",
        "store",
        clean_price(F.col("price")).alias("price"),
        safe_double(F.col("average_rating")).alias("average_rating"),
        safe_double(F.col("rating_number")).alias("rating_number"),
    )
