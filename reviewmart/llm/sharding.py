"""Sharding by histogram sort: shards of nearly equal bytes, found by counting, filled in one exchange.

Rows are ordered by the hash of their text, then by the hash of their id, so equal texts stand side
by side and stay in one shard unless the shard would otherwise miss its size by too much. Each round counts
exact bytes between the current probes, within the cells that still hold a wanted boundary, and
probes those cells more finely; a boundary is settled when a probe meets the tolerance or when no
row is left between its neighbours. A boundary among rows alike in text and id is sought among
numbers they were given when written to a table of their own. Then all rows are exchanged once.

The driver sees counts for the boundaries of shards only. A shard is filled in pieces, cells of the
hashes that hold about ``piece_bytes``, so the pieces' number follows the bytes and no task holds a
shard or a hot text. Null and empty texts weigh ``ROW_BYTES``; null ids share one place; a single
row, however long, is never cut. Without rows there are no shards.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmart.llm.common import as_doc, text_of
from reviewmart.workspace import cut

# Keys and ties are non-negative, so 63 bits. Bits added to a probe's prefix in a round.
_BITS = 63
_FIRST_BITS = 12
_MORE_BITS = 7
# What a row weighs beside its text.
ROW_BYTES = 16


@dataclass
class _Probe:
    """A boundary being sought: a cell of one group's values, and the exact bytes before it."""

    number: int
    group: int
    want: float
    within: float
    before: int
    prefix: int = 0
    bits: int = 0


@dataclass
class _Found:
    """Rows of ``group`` with values under ``value`` are below the boundary; if ``whole`` is set,
    the boundary falls into that single value, which has so many bytes after ``before``."""

    value: int
    before: int = 0
    whole: int | None = None


def _refine(rows: DataFrame, probes: list[_Probe]) -> dict[int, _Found]:
    """Settle each probe among ``group``, ``value``, ``size`` rows, or name the value it falls into.

    Per round one aggregate comes to the driver: at most the probes' number times the cells of a
    round, whatever the number of rows.
    """
    spark, found = rows.sparkSession, {}
    while probes:
        bits = min(_BITS, probes[0].bits + (_MORE_BITS if probes[0].bits else _FIRST_BITS))
        wanted = sorted({(p.group, p.prefix) for p in probes})
        of_row = F.shiftright("value", _BITS - probes[0].bits) if probes[0].bits else F.lit(0).cast("long")
        if len(wanted) == 1:
            group, prefix = wanted[0]
            held = rows.where((F.col("group") == group) & (of_row == prefix)).withColumn("cell_prefix", F.lit(prefix))
        else:
            cells = spark.createDataFrame(wanted, "cell_group long, cell_prefix long")
            at = (F.col("group") == F.col("cell_group")) & (of_row == F.col("cell_prefix"))
            held = rows.join(F.broadcast(cells), at)
        counts = (
            held.groupBy("group", "cell_prefix", F.shiftright("value", _BITS - bits).alias("cell"))
            .agg(F.sum("size").alias("bytes"), F.min("value").alias("low"), F.max("value").alias("high"))
            .collect()
        )
        by_cell: dict[tuple[int, int], list] = {}
        for row in sorted(counts, key=lambda r: r["cell"]):
            by_cell.setdefault((row["group"], row["cell_prefix"]), []).append(row)
        left = []
        for p in probes:
            before = p.before
            for row in by_cell[p.group, p.prefix]:
                if before + row["bytes"] >= p.want:
                    break
                before += row["bytes"]
            else:
                row, before = row, before - row["bytes"]
            after = before + row["bytes"]
            if min(p.want - before, after - p.want) <= p.within:
                nearer = p.want - before <= after - p.want
                found[p.number] = _Found(row["low"] if nearer else row["high"] + 1)
            elif row["low"] == row["high"]:
                found[p.number] = _Found(row["low"], before, row["bytes"])
            else:
                p.before, p.prefix, p.bits = before, row["cell"], bits
                left.append(p)
        probes = left
    return found


def splitters(
    rows: DataFrame, total: int, parts: int, tolerance: float, group_tolerance: float
) -> tuple[list[tuple[int, int, int]], dict[tuple[float, int], tuple[int, int]]]:
    """The ``parts`` - 1 boundaries (key, tie, last) of nearly equal bytes among key, tie, size rows.

    Each must come within ``tolerance`` of a part's size. A boundary inside a key moves to the key's
    nearer end where that is off by no more than ``group_tolerance``. Those that fall among rows
    alike are left out, and returned by what they want beyond the bytes before these rows, and number.
    """
    part = total / parts
    wants = {i: (total * i / parts, part * tolerance) for i in range(1, parts)}
    by_key = rows.select(F.lit(0).cast("long").alias("group"), F.col("key").alias("value"), "size")
    first = _refine(by_key, [_Probe(i, 0, want, near, 0) for i, (want, near) in wants.items()])
    inside = {}
    for i, f in first.items():
        if f.whole is None:
            continue
        low, high = wants[i][0] - f.before, f.before + f.whole - wants[i][0]
        if min(low, high) <= group_tolerance * part:
            f.value += low > high
        else:
            inside[i] = f
    by_tie = rows.select(F.col("key").alias("group"), F.col("tie").alias("value"), "size")
    second = _refine(
        by_tie, [_Probe(i, f.value, *wants[i], f.before) for i, f in inside.items()]
    )
    bounds, alike = [], {}
    for i, f in first.items():
        if i not in second:
            bounds.append((f.value, 0, 0))
        elif second[i].whole is None:
            bounds.append((f.value, second[i].value, 0))
        else:
            alike[wants[i][0] - second[i].before, i] = f.value, second[i].value
    return sorted(bounds), alike


def _among_alike(
    rows: DataFrame, part: float, tolerance: float, alike: dict[tuple[float, int], tuple[int, int]]
) -> list[tuple[int, int, int]]:
    """Boundaries among rows alike in key and tie, by the numbers in ``last``."""
    kinds = sorted(set(alike.values()))
    number = {kind: i for i, kind in enumerate(kinds)}
    named = rows.sparkSession.createDataFrame([(*kind, i) for kind, i in number.items()], "key long, tie long, group long")
    values = rows.join(F.broadcast(named), ["key", "tie"]).select("group", F.col("last").alias("value"), "size")
    found = _refine(
        values, [_Probe(i, number[kind], want, part * tolerance, 0) for (want, i), kind in alike.items()]
    )
    bounds = []
    for (want, i), kind in alike.items():
        f = found[i]
        # A single row is not cut; it goes to the nearer side.
        f.value += f.whole is not None and want - f.before > f.before + f.whole - want
        bounds.append((*kind, f.value))
    return bounds


def _shard_of(key: Column, tie: Column, last: Column, bounds: list[tuple[int, int, int]]) -> Column:
    """How many boundaries are at or below (key, tie, last)."""
    columns = [np.array([bound[i] for bound in bounds], np.int64) for i in range(3)]

    def within(values: list[np.ndarray], rows: np.ndarray, begin: int, end: int, level: int) -> np.ndarray:
        """The place of ``rows`` among boundaries that are equal in all columns before ``level``."""
        here = columns[level][begin:end]
        low = np.searchsorted(here, values[level][rows], "left")
        high = np.searchsorted(here, values[level][rows], "right")
        place = begin + (high if level == 2 else low)
        for first in np.unique(low[high > low]) if level < 2 else ():
            some = (low == first) & (high > low)
            place[some] = within(values, rows[some], begin + first, begin + high[some][0], level + 1)
        return place

    @F.pandas_udf("int")
    def of(k: pd.Series, t: pd.Series, x: pd.Series) -> pd.Series:
        values = [k.to_numpy(), t.to_numpy(), x.to_numpy()]
        return pd.Series(within(values, np.arange(len(k)), 0, len(bounds), 0).astype(np.int32))

    return of(key, tie, last)


def _bits_for(parts: Column) -> Column:
    """Leading bits of a hash that make about so many cells."""
    return F.greatest(F.ceil(F.log2(parts)), F.lit(0)).cast("int")


def shard(
    docs: DataFrame,
    shards: int = 40,
    text_col: str = "text",
    id_col: str = "doc_id",
    tolerance: float = 0.002,
    group_tolerance: float = 0.02,
    piece_bytes: int = 4 << 20,
) -> DataFrame:
    """``doc``, ``size``, ``shard`` and ``slot`` (from 0, without gaps in each shard)."""
    text = text_of(docs, text_col)
    doc_id = docs[f"`{id_col}`"]
    keyed = docs.select(
        as_doc(docs),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.shiftrightunsigned(F.xxhash64(text), 1).alias("key"),
        F.shiftrightunsigned(F.xxhash64(doc_id.isNull(), doc_id), 1).alias("tie"),
    )
    slim = cut(keyed.select("key", "tie", "size"), "shard-keys")
    total = slim.agg(F.sum("size")).first()[0] or 0
    none = F.lit(0).cast("long")
    keyed, slim = keyed.withColumn("last", none), slim.withColumn("last", none)
    bounds, alike = splitters(slim, total, shards, tolerance, group_tolerance) if total else ([], {})
    if alike:
        # Rows that are alike where a boundary has to be among them; at most one kind per boundary.
        kinds = docs.sparkSession.createDataFrame(sorted(set(alike.values())), "key long, tie long")
        apart = lambda rows: rows.join(F.broadcast(kinds), ["key", "tie"], "left_anti")
        known = keyed.drop("last").join(F.broadcast(kinds), ["key", "tie"], "left_semi")
        known = cut(known.withColumn("last", F.monotonically_increasing_id()), "rows-alike").select(*keyed.columns)
        bounds = sorted([*bounds, *_among_alike(known, total / shards, tolerance, alike)])
        keyed = apart(keyed).unionByName(known)
        slim = apart(slim).unionByName(known.select(*slim.columns))

    cell_bits = max(0, math.ceil(math.log2(max(total, 1) / piece_bytes)))
    number = _shard_of(F.col("key"), F.col("tie"), F.col("last"), bounds).alias("shard")
    cell = (F.shiftright("key", _BITS - cell_bits) if cell_bits else none).alias("cell")
    sized = cut(slim.select(number, cell, "key", "tie", "last", "size"), "shard-cells")
    # Cells with more than their share hold a hot text; its rows are told apart by their ties, and
    # rows alike by the numbers they were given.
    heavy = (
        sized.groupBy("shard", "cell")
        .agg(F.sum("size").alias("bytes"), F.max("last").alias("numbers"))
        .where(F.col("bytes") > 8 * piece_bytes)
        .select("shard", "cell", (F.col("bytes") / piece_bytes).alias("parts"), "numbers")
    )
    heavy = cut(heavy, "heavy-cells")
    fine = _bits_for(F.coalesce("parts", F.lit(1)))
    by_tie = F.when(fine > 0, F.call_function("shiftright", "tie", F.lit(_BITS) - fine)).otherwise(none).alias("sub_cell")
    # Numbers hold the partition above 33 bits; within one, runs of rows of about a piece.
    run = F.floor(F.lit(piece_bytes) / F.greatest("size", F.lit(1))) + 1
    by_number = F.when(fine > 0, F.floor(F.col("last") / run)).otherwise(none).alias("number_cell")
    at = ["shard", "cell", "sub_cell", "number_cell"]

    def in_pieces(rows: DataFrame) -> DataFrame:
        return rows.join(heavy, ["shard", "cell"], "left").select("*", by_tie, by_number).drop("parts", "numbers")

    before = Window.partitionBy("shard").orderBy(*at[1:]).rowsBetween(Window.unboundedPreceding, -1)
    pieces = in_pieces(sized).groupBy(*at).agg(F.count("*").alias("rows"))
    begins = cut(
        pieces.select(*at, F.coalesce(F.sum("rows").over(before), none).alias("begin")), "shard-pieces"
    )
    order = Window.partitionBy(*at).orderBy("key", "tie", "last")
    return (
        in_pieces(keyed.select("doc", "size", "key", "tie", "last", number, cell))
        .join(begins, at)
        .withColumn("place", F.row_number().over(order).cast("long") - 1)
        .select("doc", "size", "shard", (F.col("begin") + F.col("place")).alias("slot"))
    )
