"""Session settings every job and query relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Partitions per core offered to a shuffle before adaptive execution merges the small ones.
_SHUFFLE_WAVES = 8
# What a shuffle partition should hold at most, and how much a column file grows in a shuffle.
_SHUFFLE_BYTES = 256 * 1024 * 1024
_UNPACKED = 3


def apply_conf(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Pin UTC and the adaptive features; leave every other setting to the cluster.

    Calendar parts, the review key and the partition month are all defined in UTC.
    Adaptive execution splits hot join keys and oversized write partitions, so the
    models need it on. The number of shuffle partitions is only ever raised: on a wide
    cluster a shuffle starts with a few partitions per core and adaptive execution
    merges what turns out small. ``input_bytes``, the stored size of what a job reads, raises it
    so far that a partition of all the input's rows fits into memory: adaptive execution merges
    partitions, but cannot split those of an aggregate.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64MB")
    spark.conf.set("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")

    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    wanted = max(
        _SHUFFLE_WAVES * spark.sparkContext.defaultParallelism,
        input_bytes * _UNPACKED // _SHUFFLE_BYTES,
    )
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.conf.get(initial, None) is None and wanted > max(configured, 200):
        spark.conf.set(initial, str(wanted))
    return spark
