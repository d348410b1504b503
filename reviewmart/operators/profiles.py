"""A column profile kept up to date file by file.

Each file of a table is read once. What is kept of it is a row per column: counts, and sketches of
the distinct values and, for numbers, of their distribution. Sketches of files merge into that of
the table, so new files cost their own size only, and files that are gone are simply left out.

Distinct values are estimated within about 3 % (two standard deviations of the sketch's 1.6 %),
quantiles within about 1.5 % of the rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampType

STATE = (
    "file string, column_name string, data_type string, row_count long, filled long, "
    "distinct_sketch binary, values_sketch binary"
)
# Paths come with one slash or with three after their scheme.
_SLASHES = "^([a-z0-9]+):/+(?=[^/])"
_HLL_BITS, _QUANTILES = 12, (0.25, 0.5, 0.75)


def _distinct(column: Column, kind: DataType) -> Column:
    return F.hll_sketch_agg(column if isinstance(kind, StringType) else column.cast("string"), F.lit(_HLL_BITS))


def _values(column: Column, kind: DataType) -> Column:
    if isinstance(kind, (DateType, TimestampType)):
        column = F.unix_micros(column.cast("timestamp"))
    elif not isinstance(kind, NumericType):
        return F.lit(None).cast("binary")
    number = column.cast("double")
    # A file without a value has no sketch.
    return F.when(F.count(number) > 0, F.kll_sketch_agg_double(number))


def file_profiles(files: DataFrame) -> DataFrame:
    """The state's rows for every file that ``files``, a scan of them, reads; one pass."""
    fields = files.schema.fields
    parts = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.count("*").alias("row_count"),
            F.count(field.name).alias("filled"),
            _distinct(F.col(f"`{field.name}`"), field.dataType).alias("distinct_sketch"),
            _values(F.col(f"`{field.name}`"), field.dataType).alias("values_sketch"),
        )
        for field in fields
    ]
    path = F.regexp_replace(F.col("_metadata.file_path"), _SLASHES, "$1:/")
    by_file = files.groupBy(path.alias("file")).agg(F.array(*parts).alias("columns"))
    return by_file.select("file", F.inline("columns"))


def _files(spark: SparkSession, table: str) -> dict[str, str]:
    """The table's files by what the state calls them."""
    return {re.sub(_SLASHES, r"\1:/", path): path for path in spark.read.parquet(table).inputFiles()}


def update_profile(spark: SparkSession, table: str, state: str) -> list[str]:
    """Add the table's files that the state does not know yet; returns them."""
    found = _files(spark, table)
    fresh = sorted(found.keys() - _known(spark, state))
    if fresh:
        schema = spark.read.parquet(table).schema
        scan = spark.read.schema(schema).parquet(*(found[name] for name in fresh))
        file_profiles(scan).write.mode("append").parquet(state)
    return fresh


def _known(spark: SparkSession, state: str) -> set[str]:
    at = spark._jvm.org.apache.hadoop.fs.Path(state)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return set()
    return {row["file"] for row in spark.read.schema(STATE).parquet(state).select("file").distinct().collect()}


def merged_profile(spark: SparkSession, table: str, state: str) -> DataFrame:
    """The table's profile from the state of the files it has now; reads no row of it."""
    files = spark.createDataFrame([(path,) for path in _files(spark, table)], "file string")
    kept = spark.read.schema(STATE).parquet(state).join(files, "file", "left_semi")
    merged = kept.groupBy("column_name", "data_type").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("filled").alias("filled"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"),
        F.when(F.count("values_sketch") > 0, F.kll_merge_agg_double("values_sketch")).alias("values"),
    )
    quantiles = F.array(*(F.kll_sketch_get_quantile_double("values", F.lit(rank)) for rank in _QUANTILES))
    return merged.withColumn("quartiles", F.when(F.col("values").isNotNull(), quantiles)).drop("values")
