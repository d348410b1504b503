"""Aggregate expressions of the user dimension, and the per-item summaries.

``weight`` is the number of rows a review stands for, where it was joined to a summary of
its item instead of to each of the item's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmart.functions.times import review_date


def verified_purchase_count(flag: Column, weight: Column | int = 1) -> Column:
    """Reviews flagged true; a missing flag does not count."""
    return F.sum(F.when(flag, F.lit(weight)).otherwise(F.lit(0))).cast("long")


def review_count(weight: Column | int = 1) -> Column:
    return F.sum(F.lit(weight)).cast("long")


def first_review(ts: Column) -> Column:
    return F.min(ts)


def last_review(ts: Column) -> Column:
    return F.max(ts)


def active_days(ts: Column) -> Column:
    return F.count_distinct(review_date(ts))


def avg_days_between_reviews(ts: Column, weight: Column | int = 1) -> Column:
    """Days from the first to the last review over the steps between; null for one review."""
    span = F.date_diff(review_date(F.max(ts)), review_date(F.min(ts)))
    steps = review_count(weight) - 1
    return F.when(steps > 0, span / F.when(steps > 0, steps))


def total_spent(price: Column) -> Column:
    """Sum of prices; an unknown price adds nothing."""
    return F.sum(F.coalesce(price, F.lit(0.0)))


def item_avg(reviews: DataFrame, counted: bool = False) -> DataFrame:
    """Mean rating per product over all history; ``counted`` adds its number of reviews (``rows``)."""
    rows = [F.count("*").alias("rows")] if counted else []
    return reviews.groupBy("asin").agg(F.avg("rating").alias("avg_rating"), *rows)


def item_ratings(reviews: DataFrame) -> DataFrame:
    """Mean rating and number of reviews per known product."""
    return (
        reviews.where(F.col("asin").isNotNull())
        .groupBy("asin")
        .agg(F.avg("rating").alias("avg_rating"), F.count("*").alias("rows"))
    )


def item_spend(items: DataFrame) -> DataFrame:
    """Per product, how many rows it has and what they cost together."""
    return (
        items.where(F.col("asin").isNotNull())
        .groupBy("asin")
        .agg(F.count("*").alias("copies"), total_spent(F.col("price")).alias("price_sum"))
    )
