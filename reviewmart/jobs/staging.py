"""What the two staging jobs share: options, the quarantine and the report."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from reviewmart.session import apply_conf
from reviewmart.sources.readers import broken_files, split_corrupt
from reviewmart.sources.writers import materialize_table


def options(description: str, example: str, output: str) -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(description=description)
    args.add_argument("--input", required=True, help=f"path or glob, e.g. {example}")
    args.add_argument("--output", default=output)
    args.add_argument("--partitions", type=int, help="exact number of files; default: by size")
    args.add_argument(
        "--file-bytes",
        default="256MB",
        help="what a file is written from without --partitions, as shuffled rows",
    )
    args.add_argument(
        "--skip-broken-files",
        action="store_true",
        help="keep what can be read of damaged archives, and name them",
    )
    args.add_argument(
        "--ledger",
        help="folder of the list of staged archives: stage only what is new or changed, each archive "
        "into a partition of its own (without --quarantine and --partitions)",
    )
    args.add_argument(
        "--quarantine",
        help="folder for lines that are no JSON objects, which are then left out, and for those "
        "with fields of another type, which stay with nulls",
    )
    return args


def parsed(args: argparse.ArgumentParser, argv: list[str] | None) -> argparse.Namespace:
    chosen = args.parse_args(argv)
    if chosen.ledger and (chosen.quarantine or chosen.partitions):
        args.error("--ledger goes with neither --quarantine nor --partitions")
    return chosen


def start(name: str, chosen: argparse.Namespace) -> SparkSession:
    """The session of a staging job. Its only shuffle is the one before its files."""
    spark = apply_conf(SparkSession.builder.appName(name).getOrCreate())
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", chosen.file_bytes)
    return spark


def read_rows(
    spark: SparkSession, chosen: argparse.Namespace, schema: StructType, scan: DataFrame
) -> DataFrame:
    """The rows to stage: ``scan``, or with a quarantine the lines that can be parsed."""
    if chosen.skip_broken_files:
        for path in broken_files(spark, chosen.input):
            print(f"broken, read in part: {path}")
    if not chosen.quarantine:
        return scan
    rows, amiss = split_corrupt(spark, chosen.input, schema)
    listed = materialize_table(amiss, chosen.quarantine)
    for row in listed.groupBy("reason").count().orderBy("reason").collect():
        print(f"{row['reason']} lines: {row['count']}")
    return rows
