"""Row filters, column choice, renames and gap filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmart.functions.keys import exact_review_key

#: Groups whose median stands for a missing price.
PRICE_LEVELS = (("category", "store"), ("category",))
RENAMES = {"parent_asin": "asin", "main_category": "category"}


def select_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names)


def rename_keys(df: DataFrame) -> DataFrame:
    """``parent_asin`` becomes ``asin``, replacing the variant's; ``main_category`` ``category``."""
    present = {old: new for old, new in RENAMES.items() if old in df.columns}
    return df.drop(*present.values()).withColumnsRenamed(present)


def resolve_ts_column(df: DataFrame) -> Column:
    """The review time in milliseconds: ``sort_timestamp`` if filled, else ``timestamp``."""
    found = [name for name in ("sort_timestamp", "timestamp") if name in df.columns]
    if not found:
        raise ValueError("the reviews have neither 'sort_timestamp' nor 'timestamp'")
    return F.coalesce(*found)


def valid_reviews(df: DataFrame) -> DataFrame:
    return df.where(F.col("rating").isNotNull() & F.col("timestamp").isNotNull())


def known_users(df: DataFrame) -> DataFrame:
    return df.where(F.col("user_id").isNotNull())


def category_distinct(staged_items: DataFrame, category: str) -> DataFrame:
    return distinct_values(
        staged_items.where(F.col("main_category") == category), "main_category"
    )


def has_categories(staged_items: DataFrame) -> DataFrame:
    categories = F.col("categories")
    return staged_items.where(categories.isNotNull() & (F.size(categories) > 0))


def verified_slicer(df: DataFrame, verified: bool | None = None) -> DataFrame:
    """Only verified or only unverified reviews; ``None`` keeps all, unknown flags too."""
    return df if verified is None else df.where(F.col("verified_purchase") == F.lit(verified))


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names).distinct()


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def sample_rows(df: DataFrame, n: int = 20) -> DataFrame:
    """A few rows to look at."""
    return df.limit(n)


def handle_missing(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls by a default per column."""
    filled = {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    return df.withColumns(filled)


def dedup_reviews(stg_reviews: DataFrame, exact: bool = False) -> DataFrame:
    """One review per ``review_id``: most helpful first, then ties broken over every column.

    With ``exact``, reviews that share an id only because the parts of their keys run together
    stay. Spark keeps only the best row per key in each task before shuffling, so a key with very
    many copies costs one row per task.
    """
    first = ["helpful_votes", "rating", "verified_purchase"]
    # Year, month and day follow from the timestamp.
    settled = {*first, "review_id", "year", "month", "day"}
    rest = [name for name in stg_reviews.columns if name not in settled]
    best_first = [F.col(name).desc_nulls_last() for name in [*first, *rest]]
    keys = [F.col("review_id"), *([_exact_key()] if exact else [])]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*best_first))
    return stg_reviews.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def impute_price(items: DataFrame, levels: Sequence[Sequence[str]] = PRICE_LEVELS) -> DataFrame:
    """Fill missing prices with the median of the narrowest group that has one, and say which.

    ``levels`` are groups of columns, narrowest first; beyond them it is the median of all. ``price_from``
    is ``item`` where the price was known, else the group's columns or ``all``, null without any price.
    Missing group values form a group of their own. A group's table has a row per group and its
    medians come from counts per price, so no group has to be in one task.
    """
    filled, price, came = items, F.col("price"), F.when(F.col("price").isNotNull(), "item")
    for number, level in enumerate(levels):
        names = [f"_{number}_{name}" for name in level]
        medians = (
            items.where(F.col("price").isNotNull())
            .groupBy(*(F.col(name).alias(new) for name, new in zip(level, names, strict=True)))
            .agg(F.percentile("price", 0.5).alias(f"_median{number}"))
        )
        same = [F.col(name).eqNullSafe(F.col(new)) for name, new in zip(level, names, strict=True)]
        filled = filled.join(medians, reduce(Column.__and__, same), "left").drop(*names)
        median = F.col(f"_median{number}")
        came = F.coalesce(came, F.when(median.isNotNull(), F.lit("+".join(level))))
        price = F.coalesce(price, median)
    overall = items.agg(F.percentile("price", 0.5)).scalar()
    came = F.coalesce(came, F.when(overall.isNotNull(), F.lit("all")))
    price = F.coalesce(price, overall)
    return filled.select(
        *(price.alias(name) if name == "price" else F.col(name) for name in items.columns),
        came.alias("price_from"),
    )


def _exact_key() -> Column:
    return exact_review_key(F.col("user_id"), F.col("asin"), F.col("timestamp"))


def key_collisions(stg_reviews: DataFrame) -> DataFrame:
    """Ids that different users, products or times share: how many ``keys`` and ``reviews`` have each."""
    return (
        stg_reviews.groupBy("review_id", _exact_key().alias("key"))
        .agg(F.count("*").alias("reviews"))
        .groupBy("review_id")
        .agg(F.count("*").alias("keys"), F.sum("reviews").alias("reviews"))
        .where(F.col("keys") > 1)
    )
