"""One rollup of the fact that answers the dashboard's questions.

Each month's part holds counts and sums for three groupings, made in one pass: by year, by category
and by weekday, each with the verified flag, so that the slicer works on it. Sums and counts of
months add up, and loading a month replaces its part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.operators.rows import verified_slicer
from reviewmart.sources.writers import FACT_PARTITION

_SETS = ("year", "category", "day_name")
_MEASURES = ("n", "rating_sum", "ratings", "price_sum", "prices")


def rollup(fact: DataFrame) -> DataFrame:
    """``review_month``, ``verified_purchase``, the grouping's name and value, and mergeable measures."""
    by = fact.select(
        FACT_PARTITION,
        "verified_purchase",
        F.year("review_date").cast("string").alias("year"),
        "category",
        "day_name",
        "rating",
        "price",
    )
    common = [F.col(FACT_PARTITION), F.col("verified_purchase")]
    grouped = by.groupingSets(
        [[*common, F.col(name)] for name in _SETS], *common, *(F.col(name) for name in _SETS)
    ).agg(
        # A bit is set for each of the columns, in their order, that a row is not grouped by.
        F.grouping_id().alias("left_out"),
        F.count("*").alias("n"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("ratings"),
        F.sum("price").alias("price_sum"),
        F.count("price").alias("prices"),
    )
    of = [F.col("left_out") == _left_out(place) for place in range(len(_SETS))]
    grouping = F.coalesce(*(F.when(test, F.lit(name)) for test, name in zip(of, _SETS, strict=True)))
    value = F.coalesce(*(F.when(test, F.col(name)) for test, name in zip(of, _SETS, strict=True)))
    return grouped.select(
        FACT_PARTITION, "verified_purchase", grouping.alias("grouping"), value.alias("value"), *_MEASURES
    )


def _left_out(place: int) -> int:
    return (1 << len(_SETS)) - 1 - (1 << (len(_SETS) - 1 - place))


def load_rollup(fact: DataFrame, path: str) -> None:
    """Replace the parts of the months present in ``fact``."""
    (
        rollup(fact)
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(FACT_PARTITION)
        .parquet(path)
    )


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    schema = (
        "verified_purchase boolean, grouping string, value string, n long, rating_sum double,"
        f" ratings long, price_sum double, prices long, {FACT_PARTITION} timestamp"
    )
    return spark.read.schema(schema).parquet(path)


def _by(parts: DataFrame, grouping: str, verified: bool | None) -> DataFrame:
    return verified_slicer(parts.where(F.col("grouping") == grouping), verified)


def _count() -> Column:
    return F.sum("n").alias("review_count")


def _mean(total: str, count: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(count))


def reviews_by_year(parts: DataFrame, verified: bool | None = None) -> DataFrame:
    year = F.col("value").cast("long").alias("year")
    return _by(parts, "year", verified).groupBy(year).agg(_count())


def category_rating_trend(parts: DataFrame, verified: bool | None = None) -> DataFrame:
    return (
        _by(parts, "category", verified)
        .groupBy(F.col("value").alias("category"), FACT_PARTITION)
        .agg(_mean("rating_sum", "ratings").alias("avg_rating"))
    )


def category_share(parts: DataFrame, verified: bool | None = None) -> DataFrame:
    counted = (
        _by(parts, "category", verified).groupBy(F.col("value").alias("category")).agg(_count())
    )
    total = counted.agg(F.sum("review_count").cast("double")).scalar()
    return counted.withColumn("share", F.col("review_count") / total)


def monthly_reviews_price(
    parts: DataFrame, verified: bool | None = None, by_calendar_month: bool = False
) -> DataFrame:
    month = F.col(FACT_PARTITION)
    grain = month if by_calendar_month else F.month(month).cast("long").alias("month")
    return (
        _by(parts, "category", verified)
        .groupBy(grain)
        .agg(_count(), _mean("price_sum", "prices").alias("avg_price"))
    )


def weekday_trend(parts: DataFrame, verified: bool | None = None) -> DataFrame:
    return _by(parts, "day_name", verified).groupBy(F.col("value").alias("day_name")).agg(_count())
