"""Raw JSON lines, staged Parquet and named tables over Parquet."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reviewmart.schemas import RAW_ITEM, RAW_REVIEW
from reviewmart.sources.archives import verify
from reviewmart.workspace import cut

_CORRUPT = "_corrupt_record"
_UNREADABLE = re.compile("(?i)EOF|unexpected end|FAILED_READ|not in gzip|incorrect|corrupt")


def _scan_json(
    spark: SparkSession, paths: str | list[str], schema: StructType, skip_broken_files: bool
) -> DataFrame:
    reader = spark.read.schema(schema)
    if skip_broken_files:
        reader = reader.option("ignoreCorruptFiles", "true")
    return reader.json(paths)


def scan_reviews_json(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType = RAW_REVIEW,
    skip_broken_files: bool = False,
) -> DataFrame:
    """Reviews from (gzip) JSON lines. A malformed line becomes an all-null row.

    ``skip_broken_files`` passes over truncated archives instead of failing the job.
    """
    return _scan_json(spark, paths, schema, skip_broken_files)


def scan_items_json(
    spark: SparkSession, paths: str | list[str], skip_broken_files: bool = False
) -> DataFrame:
    """Items from (gzip) JSON lines; prices written as numbers arrive as text."""
    return _scan_json(spark, paths, RAW_ITEM, skip_broken_files)


def split_corrupt(
    spark: SparkSession, paths: str | list[str], schema: StructType
) -> tuple[DataFrame, DataFrame]:
    """All JSON objects as rows, and the lines that are amiss with their ``file`` and ``reason``.

    A line that is no JSON object at all (``unparseable``) gives no row. One in which a field has
    another type (``mistyped``) gives the row a scan gives it, with nulls in place of what does
    not fit, and is listed besides.
    """
    lines = spark.read.text(paths).where(F.trim("value") != "")
    wide = StructType([*schema.fields, StructField(_CORRUPT, StringType(), True)])
    row = F.col("row")
    first = lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.from_json(
            "value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
        ).alias("row"),
    )
    # Archives are inflated and parsed once: rows and what is amiss are read from the table made
    # of them. Only a line that did not fit is parsed again; any object is a map of texts.
    amiss_line = row[_CORRUPT].isNotNull() | row.isNull()
    parsed = cut(
        first.select(
            "file",
            "row",
            F.when(amiss_line, F.col("value")).alias("value"),
            (amiss_line & F.from_json("value", "map<string,string>").isNull()).alias("unparseable"),
        ),
        "parsed-lines",
    )
    rows = parsed.where("NOT unparseable").select(
        [F.col(f"row.{name}") for name in schema.fieldNames()]
    )
    amiss = F.when(F.col("unparseable"), "unparseable").when(
        F.col(f"row.{_CORRUPT}").isNotNull(), "mistyped"
    )
    listed = parsed.select(F.col("value").alias("line"), "file", amiss.alias("reason"))
    return rows, listed.where(F.col("reason").isNotNull())


def broken_files(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The files that cannot be read to their end, of which a scan that skips keeps a part only.

    One job inflates them all. Files in a store that only Spark's readers open are read by Spark,
    one after another.
    """
    report = verify(spark, paths).select("path", "bytes", "broken_at").collect()
    broken = [row["path"] for row in report if row["broken_at"] is not None]
    for path in sorted(row["path"] for row in report if row["bytes"] is None):
        try:
            spark.read.text(path).agg(F.count("*")).collect()
        except Exception as error:  # noqa: BLE001 - whatever a reader raises on damaged input
            if not _UNREADABLE.search(str(error)):
                raise
            broken.append(path)
    return sorted(broken)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def external_table(spark: SparkSession, name: str, path: str, permanent: bool = False) -> DataFrame:
    """Name a Parquet folder without copying it: a session view, or a catalog table.

    An external table of that name is replaced, its files stay. A table that owns its files is
    not touched: a ``ValueError``.
    """
    if permanent:
        if spark.catalog.tableExists(name) and not (old := spark.catalog.getTable(name)).isTemporary:
            if old.tableType != "EXTERNAL":
                raise ValueError(f"{name} is a table with files of its own")
            spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, path=path, source="parquet")
    else:
        spark.read.parquet(path).createOrReplaceTempView(name)
    return spark.table(name)
