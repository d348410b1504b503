"""The dashboard's questions.

``fact`` is the review fact, or ``review_context``, whose rows stand for ``n`` reviews each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmart.operators.rows import verified_slicer


def _weight(fact: DataFrame) -> Column:
    return F.col("n") if "n" in fact.columns else F.lit(1)


def _review_count(fact: DataFrame) -> Column:
    return F.sum(_weight(fact)).cast("long").alias("review_count")


def _mean(fact: DataFrame, column: str) -> Column:
    """Mean over the reviews that have a value; null if none has."""
    value, weight = F.col(column), _weight(fact)
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def reviews_by_year(fact: DataFrame, verified: bool | None = None) -> DataFrame:
    """Reviews per calendar year; those outside the calendar fall under a null year."""
    return (
        verified_slicer(fact, verified)
        .groupBy(F.year("review_date").cast("long").alias("year"))
        .agg(_review_count(fact))
    )


def category_rating_trend(fact: DataFrame, verified: bool | None = None) -> DataFrame:
    return (
        verified_slicer(fact, verified)
        .groupBy("category", "review_month")
        .agg(_mean(fact, "rating").alias("avg_rating"))
    )


def category_share(fact: DataFrame, verified: bool | None = None) -> DataFrame:
    """Reviews per category and their part of all reviews."""
    counted = (
        verified_slicer(fact, verified).groupBy("category").agg(_review_count(fact))
    )
    total = counted.agg(F.sum("review_count").cast("double")).scalar()
    return counted.withColumn("share", F.col("review_count") / total)


def top10_users(users: DataFrame, n: int = 10) -> DataFrame:
    """The users with most reviews and what they spent; equal counts go by user id."""
    return (
        users.select("user_id", "review_count", "total_spent")
        .orderBy(F.desc("review_count"), "user_id")
        .limit(n)
    )


def monthly_reviews_price(
    fact: DataFrame, verified: bool | None = None, by_calendar_month: bool = False
) -> DataFrame:
    """Reviews and mean price by month of the year, or by calendar month."""
    month = F.col("review_month")
    grain = month if by_calendar_month else F.month(month).cast("long").alias("month")
    return (
        verified_slicer(fact, verified)
        .groupBy(grain)
        .agg(_review_count(fact), _mean(fact, "price").alias("avg_price"))
    )


def weekday_trend(fact: DataFrame, verified: bool | None = None) -> DataFrame:
    return (
        verified_slicer(fact, verified).groupBy("day_name").agg(_review_count(fact))
    )
