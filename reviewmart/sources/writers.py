"""Staging sinks, model materialisation and the month-partitioned fact load."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from time import time_ns
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from reviewmart.schemas import FCT_REVIEWS
from reviewmart.workspace import remove_folders

FACT_PARTITION = "review_month"
FACT_CLUSTER = ("user_id", "asin")


def repartition(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread rows evenly after an unsplittable gzip read.

    With no number given, adaptive execution sizes the partitions by bytes, so the same job
    writes sensible files at any scale.
    """
    return df.repartition(partitions) if partitions else df.hint("rebalance")


def _write_staged(df: DataFrame, path: str, partitions: int | None) -> None:
    repartition(df, partitions).write.mode("overwrite").parquet(path)


def write_reviews_parquet(
    staged_reviews: DataFrame, path: str = "staging/review", partitions: int | None = None
) -> None:
    _write_staged(staged_reviews, path, partitions)


def write_items_parquet(
    staged_items: DataFrame, path: str = "staging/item", partitions: int | None = None
) -> None:
    _write_staged(staged_items, path, partitions)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """A model as a session view, computed anew by each query."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize_table(df: DataFrame, path: str) -> DataFrame:
    """A model as a fully refreshed Parquet table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def refresh_table(df: DataFrame, name: str, root: str) -> DataFrame:
    """A model as a catalog table whose refresh readers never see half done.

    A refresh writes a version folder of its own under ``root`` and then moves the table to it. If it
    fails, the table still shows the version before, and nothing has to be repaired. The version
    before stays for queries that are reading it; older ones, and what a failed refresh left, go.
    """
    spark, catalog = df.sparkSession, df.sparkSession.catalog
    path = f"{root.rstrip('/')}/version-{time_ns():020d}-{uuid4().hex[:8]}"
    df.write.parquet(path)
    before = None
    if catalog.tableExists(name):
        described = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()
        before = described["data_type"].rstrip("/").rsplit("/", 1)[-1]
        if spark.table(name).dtypes == df.dtypes:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        else:
            # Another schema is another table; its files are its own.
            spark.sql(f"DROP TABLE {name}")
            catalog.createTable(name, path=path, source="parquet")
        catalog.refreshTable(name)
    else:
        catalog.createTable(name, path=path, source="parquet")
    remove_folders(spark, root, keep=(path.rsplit("/", 1)[-1], before), prefix="version-")
    return spark.table(name)


def bucketed_table(
    df: DataFrame, name: str, path: str, key: str = "user_id", buckets: int | None = None
) -> DataFrame:
    """A catalog table in buckets of ``key``, sorted by it, one file each.

    Tables with as many buckets of one key join, and are grouped by it, without moving a row. What
    cannot be divided is a single key: where one holds a large part of all rows, a shuffled join
    that spreads heavy keys serves better. By default a bucket is what a shuffle partition is.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartition(n, key)
        .write.mode("overwrite")
        .bucketBy(n, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    return spark.table(name)


def cluster_layout(fact: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows out by ranges of month, user and product, and sort them; no value changes.

    Each file of a month then holds a range of users of its own, and statistics tell a reader
    which files and row groups to skip. Ranges also go by time and by the partition a row comes
    from, so that neither a busy month, a busy user nor a run of copies has to stay in one task.
    ``partitions`` is the number of ranges; by default, that of a shuffle, from which adaptive
    execution merges small ones. Finding the ranges takes a pass over the rows of its own, which
    shuffles that were done for them serve as well.
    """
    order = [F.col(name) for name in (FACT_PARTITION, *FACT_CLUSTER)]
    ranges = [*order, F.col("timestamp"), F.spark_partition_id()]
    ranged = (
        fact.repartitionByRange(partitions, *ranges)
        if partitions
        else fact.repartitionByRange(*ranges)
    )
    return ranged.sortWithinPartitions(*order)


def z_order_layout(fact: DataFrame, partitions: int | None = None, bits: int = 6) -> DataFrame:
    """Deal rows out so that files of a month hold a range of users *and* a range of products.

    Users and products are ranked into ``2 ** bits`` ranges of about as many rows each, however uneven
    their names are, and the ranks' bits are interleaved: rows near each other in that order are near
    in both. ``cluster_layout`` serves lookups of users better and those of products hardly at all.
    Ranking takes a pass over one column each; no value changes.
    """
    ranked = fact
    for name in FACT_CLUSTER:
        ranked = _ranked(ranked, name, f"_rank_{name}", 1 << bits)
    order = F.lit(0)
    for bit in range(bits):
        for place, name in enumerate(FACT_CLUSTER):
            of_rank = F.shiftright(f"_rank_{name}", bit).bitwiseAND(F.lit(1))
            order = order + F.shiftleft(of_rank, 2 * bit + len(FACT_CLUSTER) - 1 - place)
    placed = ranked.withColumn("_z", order).drop(*(f"_rank_{name}" for name in FACT_CLUSTER))
    sort = [F.col(name) for name in (FACT_PARTITION, "_z", *FACT_CLUSTER)]
    ranges = [*sort, F.col("timestamp"), F.spark_partition_id()]
    ranged = (
        placed.repartitionByRange(partitions, *ranges)
        if partitions
        else placed.repartitionByRange(*ranges)
    )
    return ranged.sortWithinPartitions(*sort).drop("_z")


def _ranked(fact: DataFrame, name: str, rank: str, ranges: int) -> DataFrame:
    """Add which of ``ranges``, a power of two, of about equally many rows a value falls into.

    Missing ones fall into the first.
    """
    dealt = fact.select(name).where(F.col(name).isNotNull()).repartitionByRange(ranges, name)
    # One row per range.
    least = dealt.groupBy(F.spark_partition_id().alias("range")).agg(F.min(name).alias("least"))
    bounds = F.lit(sorted(row["least"] for row in least.collect())[1:]).cast(ArrayType(fact.schema[name].dataType))
    # Halving, a column for each step: one expression for all would grow with the number of ranges,
    # beyond what is compiled. Past the last bound there is null, and a missing value is below all.
    found, step = fact.withColumn(rank, F.lit(0)), ranges >> 1
    while step:
        upper = F.col(name) >= F.get(bounds, F.col(rank) + (step - 1))
        found = found.withColumn(rank, F.when(upper, F.col(rank) + step).otherwise(F.col(rank)))
        step >>= 1
    return found


def load_fact(
    fact: DataFrame,
    path: str,
    partitions: int | None = None,
    layout: Callable[[DataFrame, int | None], DataFrame] = cluster_layout,
    derived: Mapping[str, Column] | None = None,
) -> None:
    """Replace exactly the months present in ``fact``; other months stay, copies stay.

    ``derived`` gives columns that follow from others of their row, which are made after the layout.
    Keys are random, which zstd makes smaller and the usual codec does not.
    """
    derived = dict(derived or {})
    (
        layout(fact.drop(*derived), partitions)
        .withColumns(derived)
        .write.option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .mode("overwrite")
        .partitionBy(FACT_PARTITION)
        .parquet(path)
    )


def read_fact(spark: SparkSession, path: str, schema: StructType = FCT_REVIEWS) -> DataFrame:
    """The loaded fact with its declared column order and types."""
    return spark.read.schema(schema).parquet(path).select(schema.fieldNames())
