"""Dimensions and the review fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmart.functions.keys import review_id_hex
from reviewmart.functions.numbers import rating_diff
from reviewmart.functions.times import review_month
from reviewmart.operators import aggregates as agg
from reviewmart.operators.joins import (
    USUAL,
    JoinLimits,
    fct_x_time,
    item_columns,
    lookup,
    measured_bytes,
)
from reviewmart.operators.rows import known_users, select_columns
from reviewmart.schemas import DIM_ITEMS, FCT_REVIEWS
from reviewmart.workspace import cut


def dim_items(stg_items: DataFrame) -> DataFrame:
    return select_columns(stg_items, *DIM_ITEMS.fieldNames())


def dim_users(
    reviews: DataFrame,
    items: DataFrame,
    limits: JoinLimits = USUAL,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Activity and spending per known user.

    Reviews meet one summary row per product rather than the product's rows, and each counts
    as often as the product is listed: the same totals as joining every row, without the
    intermediate growing with the number of listings. ``counts`` gives the reviews (``rows``)
    per product where they are known already.
    """
    spend = agg.item_spend(items)
    seen = known_users(reviews).select("user_id", "asin", "verified_purchase", "timestamp")
    ts, weight = F.col("timestamp"), F.coalesce("copies", F.lit(1))
    # A summary is no larger than what it sums up, so small items need not be written first.
    if measured_bytes(item_columns(items, "price")) <= limits.broadcast_bytes:
        joined = seen.join(F.broadcast(spend), "asin", "left")
    else:
        joined = lookup(seen, cut(spend, "item-spend"), "asin", counts, limits=limits)
    return (
        joined.groupBy("user_id")
        .agg(
            agg.verified_purchase_count(F.col("verified_purchase"), weight).alias(
                "verified_purchase_count"
            ),
            agg.review_count(weight).alias("review_count"),
            agg.first_review(ts).alias("first_review_date"),
            agg.last_review(ts).alias("last_review_date"),
            agg.active_days(ts).alias("active_days"),
            agg.avg_days_between_reviews(ts, weight).alias("avg_days_between_reviews"),
            agg.total_spent(F.col("price_sum")).alias("total_spent"),
        )
    )


def review_context(
    reviews: DataFrame,
    items: DataFrame,
    attributes: Sequence[str],
    by: Sequence[str | Column],
    limits: JoinLimits = USUAL,
) -> DataFrame:
    """How many reviews (``n``) there are of each combination of item ``attributes`` and ``by``.

    For questions over models that are not saved as a fact. If the items cannot be broadcast,
    reviews are counted per product before they meet them; equal listings of a product are
    counted in either case, so few rows per product are joined. Without attributes only products
    listed more than once matter, and mostly there are none.
    """
    listed = item_columns(items, *attributes)
    listings = listed.groupBy("asin", *attributes).agg(F.count("*").alias("copies"))
    if not attributes:
        listings = listings.where(F.col("copies") > 1)
        if listings.isEmpty():
            return reviews.groupBy(*by).agg(F.count("*").alias("n"))
        listings = listed = cut(listings, "listed-again")
    if measured_bytes(listed) <= limits.broadcast_bytes:
        one = F.lit(1).cast("long").alias("reviews")
        joined = reviews.select("asin", *by, one).join(F.broadcast(listings), "asin", "left")
    else:
        counts = reviews.groupBy("asin", *by).agg(F.count("*").alias("reviews"))
        # Read twice: its rows per product are counted, then joined.
        counted = cut(counts, "reviews-per-item", compression="zstd")
        grouped = [name for name in counted.columns if name != "reviews"]
        joined = lookup(counted, cut(listings, "listings"), "asin", None, grouped, limits)
    grain = [name for name in joined.columns if name not in ("asin", "reviews", "copies")]
    rows = F.col("reviews") * F.coalesce("copies", F.lit(1))
    return joined.groupBy(*grain).agg(F.sum(rows).alias("n"))


def item_context(
    reviews: DataFrame, items: DataFrame, limits: JoinLimits = USUAL, rated: bool = False
) -> DataFrame:
    """All that is known per product, a row for each of its listings, as a written table.

    With ``rated``, ``reviews`` are not reviews but what ``item_ratings`` makes of them.
    """
    listed = item_columns(items, "price", "category", "store")
    rated = reviews if rated else agg.item_ratings(reviews)
    if measured_bytes(listed) <= limits.broadcast_bytes:
        return cut(rated.join(F.broadcast(listed), "asin", "left"), "item-context")
    rated, listed = cut(rated, "item-ratings"), cut(listed, "listed-items")
    once = rated.select("asin", F.lit(1).cast("long").alias("rows"))
    return cut(lookup(rated, listed, "asin", once, limits=limits), "item-context")


def fct_reviews(
    reviews: DataFrame,
    items: DataFrame,
    time: DataFrame,
    limits: JoinLimits = USUAL,
    per_item: DataFrame | None = None,
) -> DataFrame:
    """One row per review (and listing of its item), with time, item and rating context.

    Everything known per product is joined into one summary and written first (``per_item``,
    if the caller has it), so the reviews themselves are joined, and where necessary shuffled,
    only once. The user dimension is not joined: it is unique by user and none of its columns
    are used. Reviews keep the key they come with.
    """
    if per_item is None:
        per_item = item_context(reviews, items, limits)
    counts = per_item.groupBy("asin").agg(F.max("rows").alias("rows"))
    # The calendar last, so that its columns are not shuffled with the reviews.
    known = lookup(reviews, per_item.drop("rows"), "asin", counts, limits=limits)
    joined = fct_x_time(known, time)
    # Of reviews stored by month, so that a filter on it reaches the stored ones.
    stored = "review_month" in reviews.columns
    month = F.col("review_month") if stored else review_month(F.col("timestamp"))
    return joined.select(
        "review_id",
        "user_id",
        "asin",
        "rating",
        "verified_purchase",
        "helpful_votes",
        "timestamp",
        month.alias("review_month"),
        "price",
        "category",
        "store",
        "avg_rating",
        "review_date",
        "day_name",
        *(column.alias(name) for name, column in fct_derived().items()),
    ).select(FCT_REVIEWS.fieldNames())


def fct_derived() -> dict[str, Column]:
    """The fact's columns that follow from others of the same row; a load need not shuffle them."""
    return {
        "review_id_power_bi": review_id_hex(F.col("review_id")),
        "rating_diff_from_avg": rating_diff(F.col("rating"), F.col("avg_rating")),
    }
