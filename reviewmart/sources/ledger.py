"""Staging archive by archive, with a ledger of what was staged.

Each archive's rows are a partition of the staged table, named after the archive, so staging one
again replaces its rows and no others. The ledger says which archives are in the table, with their
length and time; it is written after the rows, so what a broken run leaves behind is staged again.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARCHIVE = "archive"
_LEDGER = "path string, length long, modified timestamp"
# Paths come with one slash or with three after their scheme.
_SLASHES = "^([a-z0-9]+):/+(?=[^/])"


def archive_of(path: Column) -> Column:
    """A short name for an archive's path, fit for a folder."""
    return F.left(F.md5(F.regexp_replace(path, _SLASHES, "$1:/")), F.lit(16))


def pending(spark: SparkSession, paths: str | list[str], ledger: str) -> list[tuple]:
    """The archives that the ledger does not have as they are now: path, length and time."""
    listed = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    # One row per archive.
    now = [tuple(row) for row in listed.orderBy("path").collect()]
    known = {tuple(row) for row in _read(spark, ledger).collect()}
    return [row for row in now if (re.sub(_SLASHES, r"\1:/", row[0]), *row[1:]) not in known]


def _read(spark: SparkSession, ledger: str) -> DataFrame:
    at = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(ledger)


def stage_pending(
    spark: SparkSession,
    paths: str | list[str],
    output: str,
    ledger: str,
    scan: Callable[[list[str]], DataFrame],
    stage: Callable[[DataFrame], DataFrame],
) -> list[str]:
    """Stage the pending archives into ``output``, then enter them in the ledger; returns their paths.

    ``scan`` reads archives and ``stage`` makes staged rows, keeping the column ``archive``. Archives
    that are gone keep their rows. An archive without rows is entered too.
    """
    fresh = pending(spark, paths, ledger)
    if not fresh:
        return []
    raw = scan([row[0] for row in fresh])
    named = raw.select("*", archive_of(F.col("_metadata.file_path")).alias(ARCHIVE))
    (
        stage(named)
        .hint("rebalance", ARCHIVE)
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(ARCHIVE)
        .parquet(output)
    )
    entered = [(re.sub(_SLASHES, r"\1:/", row[0]), *row[1:]) for row in fresh]
    spark.createDataFrame(entered, _LEDGER).coalesce(1).write.mode("append").parquet(ledger)
    return [row[0] for row in fresh]
