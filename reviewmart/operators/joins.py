"""The five left joins of the star schema.

A right side is broadcast only after its size was measured. Beyond that, both sides are
shuffled on the key, and keys that hold more than a fair share of either side, as well as
missing keys, are spread over many partitions first. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, DataType, StringType

from reviewmart.functions.times import review_date
from reviewmart.workspace import cut

# Parts per shuffle partition: enough that hashing deals them out evenly.
FINENESS = 4

_ROW_BYTES, _VALUE_BYTES = 32, 16


@dataclass(frozen=True)
class JoinLimits:
    """From where on a right side is shuffled, and from where on a key is spread."""

    # Largest measured size of a right side that every executor is sent a copy of.
    broadcast_bytes: int = 64 * 1024 * 1024
    # A key with fewer rows than this is never spread.
    fair_rows: int = 200_000


USUAL = JoinLimits()


def reviews_x_price(
    reviews: DataFrame, items: DataFrame, limits: JoinLimits = USUAL
) -> DataFrame:
    """Add ``price``; an item listed twice doubles its reviews."""
    return lookup(reviews, item_columns(items, "price"), "asin", limits=limits)


def fct_x_time(reviews: DataFrame, time: DataFrame) -> DataFrame:
    """Add ``review_date`` and ``day_name``; both are null outside the calendar.

    Left to Catalyst: a calendar has a row per day, and is small unless it is broken.
    """
    days = time.select(F.col("date_day").alias("review_date"), "day_name")
    written = review_date(reviews["timestamp"])
    return reviews.join(days, written == days["review_date"], "left")


def fct_x_users(reviews: DataFrame, users: DataFrame, limits: JoinLimits = USUAL) -> DataFrame:
    """Add the user's attributes; reviews without a user keep nulls."""
    attributes = [name for name in users.columns if name not in reviews.columns]
    known = users.select("user_id", *attributes)
    counts = users.select("user_id", F.col("review_count").alias("rows"))
    return lookup(reviews, known, "user_id", counts, limits=limits)


def bucketed_x_users(reviews: DataFrame, users: DataFrame) -> DataFrame:
    """``fct_x_users`` of two tables in buckets of ``user_id``: merged where they lie."""
    attributes = [name for name in users.columns if name not in reviews.columns]
    return reviews.join(users.select("user_id", *attributes).hint("merge"), "user_id", "left")


def fct_x_items(reviews: DataFrame, items: DataFrame, limits: JoinLimits = USUAL) -> DataFrame:
    """Add ``price``, ``category`` and ``store``; an item listed twice doubles its reviews."""
    listed = item_columns(items, "price", "category", "store")
    return lookup(reviews, listed, "asin", limits=limits)


def fct_x_item_avg(
    reviews: DataFrame, item_avg: DataFrame, limits: JoinLimits = USUAL
) -> DataFrame:
    """Add ``avg_rating``; reviews without a product keep null.

    If ``item_avg`` comes with the number of reviews (``rows``), they are not counted again.
    """
    counts = item_avg.select("asin", "rows") if "rows" in item_avg.columns else None
    return lookup(reviews, item_columns(item_avg, "avg_rating"), "asin", counts, limits=limits)


def item_columns(df: DataFrame, *names: str) -> DataFrame:
    """``asin`` and ``names`` of the rows that a join on ``asin`` can meet.

    Malformed lines can leave many rows without a key.
    """
    return df.where(F.col("asin").isNotNull()).select("asin", *names)


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    counts: DataFrame | None = None,
    spread_by: Sequence[str] = ("user_id", "asin", "timestamp"),
    limits: JoinLimits = USUAL,
) -> DataFrame:
    """Left join on ``key``, whatever the size of ``right`` and the skew of either side.

    ``right`` is measured, so it should be a table or a ``cut``. ``counts`` gives the left
    rows (``rows``) per ``key`` where they are known already. ``spread_by`` names columns
    that vary among the left rows of one key.
    """
    if measured_bytes(right) <= limits.broadcast_bytes:
        return left.join(F.broadcast(right), key, "left")
    if counts is None:
        counts = cut(left.groupBy(key).agg(F.count("*").alias("rows")), f"rows-per-{key}")
    known = counts.where(F.col(key).isNotNull())
    return _spread_join(left, right, key, known, spread_by, limits.fair_rows)


def measured_bytes(df: DataFrame) -> int:
    """Rows, and lengths of all that varies in length, as bytes in memory."""
    varying = [f.name for f in df.schema.fields if _varies(f.dataType)]
    lengths = [
        F.sum(
            F.octet_length(name)
            if isinstance(df.schema[name].dataType, (StringType, BinaryType))
            else F.octet_length(F.to_json(F.struct(name)))
        )
        for name in varying
    ]
    rows, *value_bytes = df.agg(F.count("*"), *lengths).first()
    per_row = _ROW_BYTES + _VALUE_BYTES * len(df.columns)
    return rows * per_row + sum(size or 0 for size in value_bytes)


def _varies(kind: DataType) -> bool:
    return isinstance(kind, (StringType, BinaryType)) or not isinstance(kind, AtomicType)


def _shuffle_width(spark: SparkSession) -> int:
    started = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get(started, None) or usual)


def _heavy(counts: DataFrame, key: str, width: int, fair_rows: int, name: str) -> DataFrame:
    """``key`` and into how many fair parts its rows go, for keys that need more than one.

    A heavy key has more than a quarter of an average partition's rows, so there are at most
    four times as many heavy keys as partitions: a list short enough to broadcast.
    """
    total = counts.agg(F.sum("rows")).first()[0] or 0
    fair = max(fair_rows, total // width, 1)
    parts = F.ceil(F.col("rows") / fair).cast("int").alias(name)
    return counts.where(F.col("rows") > fair).select(key, parts)


def _spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    counts: DataFrame,
    spread_by: Sequence[str],
    fair_rows: int,
) -> DataFrame:
    """Shuffle join in which each heavy key is divided into parts of a fair size.

    The rows a key has on one side are dealt out to parts, and its rows on the other side are
    repeated in each of them; a key that is heavy on both sides gets a part for each pair. A
    left row's part follows from its content and from the partition it is in, both the same if
    its task runs again; copies in different partitions go to different parts.

    A left row that is repeated may meet nothing in some of its parts. Its key has rows on the
    right, though, so such keys are joined apart, and without keeping what meets nothing.
    """
    width = FINENESS * _shuffle_width(left.sparkSession)
    right_counts = right.groupBy(key).agg(F.count("*").alias("rows"))
    parts = cut(
        _heavy(counts, key, width, fair_rows, "_parts").join(
            _heavy(right_counts.where(F.col(key).isNotNull()), key, width, fair_rows, "_pieces"),
            key,
            "full",
        ),
        f"heavy-{key}",
    )
    heavy = F.broadcast(parts)
    varying = [name for name in spread_by if name in left.columns]
    one = F.lit(1)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(n, one) - 1))
    place = F.xxhash64(*varying, F.spark_partition_id())
    into = F.when(F.col(key).isNull(), width).otherwise(F.coalesce("_parts", one))
    marked = left.join(heavy, key, "left").withColumn("_part", F.pmod(place, into).cast("int"))
    dealt = F.xxhash64(*right.columns, F.spark_partition_id())
    repeated = (
        right.join(heavy, key, "left")
        .withColumn("_piece", F.pmod(dealt, F.coalesce("_pieces", one)).cast("int"))
        .withColumn("_part", every(F.col("_parts")))
    )
    whole = F.col("_pieces").isNull()
    joined = (
        marked.where(whole)
        .drop("_parts", "_pieces")
        .join(
            repeated.where(whole).drop("_parts", "_pieces", "_piece"), [key, "_part"], "left"
        )
        .drop("_part")
    )
    if parts.where("_pieces IS NOT NULL").isEmpty():
        return joined
    met = (
        marked.where(~whole)
        .withColumn("_piece", every(F.col("_pieces")))
        .drop("_parts", "_pieces")
        .join(
            repeated.where(~whole).drop("_parts", "_pieces"), [key, "_part", "_piece"]
        )
        .drop("_part", "_piece")
    )
    return joined.unionByName(met)
