"""Loading by month range: reviews and small mergeable states per month, instead of all history.

A load replaces the months of a range in four tables partitioned by ``review_month``:

``review_months``   the cleaned reviews
``rating_state``    per product: sum and number of ratings, number of reviews
``user_days``       per user: first and last review, and a bit for each day of the month with one
``user_products``   per user and product: reviews, and verified ones

Months do not overlap, so sums over them give every measure over all history, exactly. The fact is
put together when it is read: a product's mean rating changes with every load, and with it would
each older month. The reviews of other months are read by no load, and neither the mean ratings nor
the user dimension read any reviews. A change of prices or listings needs no load at all.

A load that failed is run again; until then a month is as before or as loaded in each table.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.functions.times import review_month
from reviewmart.operators import aggregates as agg
from reviewmart.operators.joins import USUAL, JoinLimits, lookup
from reviewmart.operators.rows import known_users
from reviewmart.plans import marts
from reviewmart.sources.writers import FACT_PARTITION, load_fact
from reviewmart.workspace import cut

REVIEWS = "review_months"


def rating_state(reviews: DataFrame) -> DataFrame:
    return (
        reviews.where(F.col("asin").isNotNull())
        .groupBy(FACT_PARTITION, "asin")
        .agg(
            F.sum("rating").alias("rating_sum"),
            F.count("rating").alias("ratings"),
            F.count("*").alias("rows"),
        )
    )


def user_days(reviews: DataFrame) -> DataFrame:
    """Distinct days as bits of one number: a month has no more than 31."""
    day = F.call_function("shiftleft", F.lit(1), F.dayofmonth("timestamp") - 1)
    return (
        known_users(reviews)
        .groupBy(FACT_PARTITION, "user_id")
        .agg(
            F.min("timestamp").alias("first_review"),
            F.max("timestamp").alias("last_review"),
            F.bit_or(day).alias("days"),
        )
    )


def user_products(reviews: DataFrame) -> DataFrame:
    return (
        known_users(reviews)
        .groupBy(FACT_PARTITION, "user_id", "asin")
        .agg(
            F.count("*").alias("reviews"),
            agg.verified_purchase_count(F.col("verified_purchase")).alias("verified"),
        )
    )


STATES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "rating_state": rating_state,
    "user_days": user_days,
    "user_products": user_products,
}


def load_months(reviews: DataFrame, out: str, first: date, last: date) -> None:
    """Replace the months from that of ``first`` to that of ``last``, both whole, by what ``reviews`` holds.

    A month of the range without reviews is emptied. The states come from the months as written.
    """
    if last < first:
        raise ValueError(f"the range ends ({last}) before it begins ({first})")
    spark, path = reviews.sparkSession, f"{out}/{REVIEWS}"
    begin, end = _month(first), _month(last, 1)
    chosen = reviews.where((F.col("timestamp") >= F.lit(begin)) & (F.col("timestamp") < F.lit(end)))
    load_fact(chosen.withColumn(FACT_PARTITION, review_month(F.col("timestamp"))), path)
    # One row per month of the range at most.
    kept = {row[0] for row in chosen.select(review_month(F.col("timestamp"))).distinct().collect()}
    _empty_months(spark, path, begin, end, kept)
    loaded = spark.read.schema(_stored(reviews)).parquet(path).where(F.col(FACT_PARTITION).isin(*kept))
    for name, state in STATES.items():
        _write_months(state(loaded), f"{out}/{name}")
        _empty_months(spark, f"{out}/{name}", begin, end, kept)


def _month(day: date, later: int = 0) -> datetime:
    number = day.year * 12 + day.month - 1 + later
    return datetime(number // 12, number % 12 + 1, 1)


def _stored(reviews: DataFrame) -> str:
    fields = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in reviews.schema)
    return f"{fields}, {FACT_PARTITION} timestamp"


def _write_months(df: DataFrame, path: str) -> None:
    (
        df.write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(FACT_PARTITION)
        .parquet(path)
    )


def _empty_months(
    spark: SparkSession, path: str, begin: datetime, end: datetime, kept: set[datetime]
) -> None:
    """Remove the range's months that the load brought no rows for; writing left them as they were."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return
    for status in files.listStatus(at):
        name, _, value = status.getPath().getName().partition("=")
        if name != FACT_PARTITION:
            continue
        month = datetime.fromisoformat(unquote(value))
        if begin <= month < end and month not in kept:
            files.delete(status.getPath(), True)


def item_ratings(states: DataFrame) -> DataFrame:
    """Mean rating and number of reviews per product over all months."""
    mean = F.try_divide(F.sum("rating_sum"), F.sum("ratings"))
    return states.groupBy("asin").agg(mean.alias("avg_rating"), F.sum("rows").alias("rows"))


def fct_reviews(
    spark: SparkSession, out: str, items: DataFrame, time: DataFrame, limits: JoinLimits = USUAL
) -> DataFrame:
    """The fact over all loaded months, with today's items and mean ratings over all history.

    A filter on ``review_month`` reaches the stored months; the ratings come from the state alone.
    """
    rated = item_ratings(spark.read.parquet(f"{out}/rating_state"))
    per_item = marts.item_context(rated, items, limits, rated=True)
    return marts.fct_reviews(spark.read.parquet(f"{out}/{REVIEWS}"), items, time, limits, per_item)


def dim_users(spark: SparkSession, out: str, items: DataFrame, limits: JoinLimits = USUAL) -> DataFrame:
    """The user dimension over all loaded months, from the states and today's items."""
    days = (
        spark.read.parquet(f"{out}/user_days")
        .groupBy("user_id")
        .agg(
            F.min("first_review").alias("first_review_date"),
            F.max("last_review").alias("last_review_date"),
            F.sum(F.bit_count("days")).cast("long").alias("active_days"),
        )
    )
    # Its months are summed with the rest below: few users return to a product, so that sums per
    # user and product would be as many rows again.
    bought = spark.read.parquet(f"{out}/user_products").drop(FACT_PARTITION)
    spend = cut(agg.item_spend(items), "item-spend")
    weight = F.coalesce("copies", F.lit(1))
    counts = (
        lookup(bought, spend, "asin", spread_by=("user_id",), limits=limits)
        .groupBy("user_id")
        .agg(
            F.sum(F.col("verified") * weight).cast("long").alias("verified_purchase_count"),
            F.sum(F.col("reviews") * weight).cast("long").alias("review_count"),
            agg.total_spent(F.col("reviews") * F.col("price_sum")).alias("total_spent"),
        )
    )
    span = F.date_diff(F.to_date("last_review_date"), F.to_date("first_review_date"))
    steps = F.col("review_count") - 1
    return counts.join(days, "user_id").select(
        "user_id",
        "verified_purchase_count",
        "review_count",
        "first_review_date",
        "last_review_date",
        "active_days",
        F.when(steps > 0, span / F.when(steps > 0, steps)).alias("avg_days_between_reviews"),
        "total_spent",
    )
