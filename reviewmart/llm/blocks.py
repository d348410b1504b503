"""Comparing rows within blocks, where a block may be too large for one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def units(
    rows: DataFrame, block: list[str], member: str, most: int, largest: int | None = None
) -> DataFrame:
    """Give each row the units it is compared in, as the long column ``unit``, with its ``piece`` of
    the block and whether the unit is that piece's ``own``, without another.

    A block of up to ``most`` rows is one unit. A larger one is cut into pieces of about that
    size, with a unit for each pair of pieces, so that any two rows of a block still meet. From
    64 pieces on, pieces grow up to ``largest`` rows first, so that rows are not repeated more
    often than needed. Blocks of a single row have none.
    """
    sizes = rows.groupBy(*block).agg(F.count("*").alias("block_rows")).where(F.col("block_rows") > 1)
    fair = F.least(F.greatest(F.col("block_rows") / 64, F.lit(most)), F.lit(largest or most))
    pieces = F.ceil(F.col("block_rows") / fair)
    piece = F.pmod(F.xxhash64(member), pieces)
    other = F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))
    return (
        rows.join(sizes, block)
        .withColumn("piece", piece)
        .withColumn("other", other)
        .withColumn(
            "unit", F.xxhash64(*block, F.least("piece", "other"), F.greatest("piece", "other"))
        )
        .withColumn("own", F.col("piece") == F.col("other"))
        .drop("block_rows", "other")
    )


def per_unit(
    rows: DataFrame, schema: str, work: Callable[[np.ndarray, pa.Table], pa.RecordBatch]
) -> DataFrame:
    """Bring each unit's rows together and let ``work`` see whole units, many at a time.

    ``work`` gets the sorted unit of each row and the rows. A unit's rows come one after another,
    so only the last unit of a batch waits for the next batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = batch.column("unit").to_numpy(zero_copy_only=False)
            if held and held[-1].column("unit")[-1].as_py() == unit[-1]:
                held.append(batch)
                continue
            begin = int(np.searchsorted(unit, unit[-1], "left"))
            held.append(batch.slice(0, begin))
            yield from done(held)
            held = [batch.slice(begin)]
        yield from done(held)

    def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in held if batch.num_rows]
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield work(table.column("unit").to_numpy(), table)

    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, schema)


def roots_of_pairs(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For ``n`` items and pairs of them, each item's smallest reachable item."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        fresh = label.copy()
        np.minimum.at(fresh, left, low)
        np.minimum.at(fresh, right, low)
        np.minimum.at(fresh, label[left], low)
        np.minimum.at(fresh, label[right], low)
        fresh = fresh[fresh]
        if (fresh == label).all():
            return label
        label = fresh


def runs(sorted_keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each run of equal keys."""
    edges = np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1
    bounds = [0, *edges.tolist(), len(sorted_keys)]
    yield from zip(bounds, bounds[1:])
