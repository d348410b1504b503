"""SimHash near-duplicates: fingerprints, and groups of those that differ in few bits.

Distances from each fingerprint to a table of pivots, fixed reference fingerprints, are computed
once. Two fingerprints within ``max_bits`` differ by no more than that in any coordinate of the
table, so pairs beyond are discarded; what survives is verified bit by bit. Pairs are sought only
among fingerprints that agree on enough segments: of s segments, at most ``max_bits`` can hold a
differing bit, so s - max_bits agree for each pair sought and none is missed.

Equal fingerprints are one node. A null text, like any text without words, has fingerprint zero. A
null id takes part but names no group: a group of null ids only has a null component. Rows with
the same id count as one document's where the smallest id of a group is chosen.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmart.llm.blocks import per_unit, roots_of_pairs, runs, units
from reviewmart.llm.graph import components
from reviewmart.workspace import cut

SEED = 42
PIVOTS = np.random.default_rng(64).integers(0, 2**64, 24, dtype=np.uint64)
# Rows of a piece of a large block, and what they grow to in very large blocks.
_PIECE_ROWS, _LARGEST_PIECE = 512, 4096
# Fingerprints that may be expected to share a block by chance before segments are made longer.
_BY_CHANCE = 64
_ROWS_AT_ONCE = 65280


def _majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes.

    Bits are spread to bytes and summed eight at a time; 255 of them cannot overflow a byte.
    """
    counts = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), _ROWS_AT_ONCE):
        part = hashes[begin : begin + _ROWS_AT_ONCE]
        spread = np.unpackbits(part.view(np.uint8), bitorder="little").view("<u8").reshape(-1, 8)
        sums = np.add.reduceat(spread, np.arange(0, len(part), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_of(text: str | None, shingle: int) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words)]
    if len(words) > shingle:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = map(xxhash.xxh64_intdigest, grams, repeat(SEED))
    return _majority(np.fromiter(hashes, "<u8"))


def fingerprint(text: Column, shingle: int) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint_of(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(values.view(np.int64))

    return of(text)


def _segment_masks(n: int, max_bits: int) -> list[int]:
    """Masks of the segments that must agree: longer ones, and more of them, for larger inputs."""
    for segments in range(max_bits + 1, 64):
        agree = segments - max_bits
        bits = agree * (64 // segments)
        if n <= _BY_CHANCE << bits or segments == max_bits + 5:
            break
    bounds = [round(i * 64 / segments) for i in range(segments + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(bounds, bounds[1:], strict=False)]
    return [sum(some) for some in combinations(parts, agree)]


def _linked(unit: np.ndarray, values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs within a unit that differ in at most ``max_bits`` bits."""
    table = np.bitwise_count(values[:, None] ^ PIVOTS).astype(np.int8)

    def verified(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for pivot in range(table.shape[1]):
            near = np.abs(table[left, pivot] - table[right, pivot]) <= max_bits
            left, right = left[near], right[near]
        close = np.bitwise_count(values[left] ^ values[right]) <= max_bits
        return left[close], right[close]

    found = []
    bounds = np.array(list(runs(unit)))
    large = bounds[:, 1] - bounds[:, 0] > 64
    for begin, end in bounds[large].tolist():
        places = np.arange(begin, end)
        for some in np.array_split(places, -(-len(places) // 256)):
            left, right = np.nonzero(
                np.abs(table[some, :1] - table[None, begin:end, 0]) <= max_bits
            )
            left, right = some[left], right + begin
            found.append(verified(left[left < right], right[left < right]))
    small = np.repeat(~large, bounds[:, 1] - bounds[:, 0])
    for step in range(1, 64):
        left = np.flatnonzero((unit[:-step] == unit[step:]) & small[:-step])
        if not len(left):
            break
        found.append(verified(left, left + step))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def links(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """Edges (``a``, ``b``) that connect all distinct fingerprints within ``max_bits`` bits.

    Each unit of comparison emits the edges of a spanning forest, not all its pairs.
    """
    masks = _segment_masks(fingerprints.count(), max_bits)
    blocks = fingerprints.select(
        "fingerprint",
        F.explode(F.array(*(F.lit(np.uint64(mask).astype(np.int64).item()) for mask in masks))).alias("mask"),
    ).withColumn("part", F.col("fingerprint").bitwiseAND(F.col("mask")))

    def work(unit: np.ndarray, rows: pa.Table) -> pa.RecordBatch:
        values = rows.column("fingerprint").to_numpy()
        left, right = _linked(unit, values.view(np.uint64), max_bits)
        root = roots_of_pairs(len(values), left, right)
        moved = np.flatnonzero(root != np.arange(len(values)))
        return pa.RecordBatch.from_pydict({"a": values[moved], "b": values[root[moved]]})

    at = units(blocks, ["mask", "part"], "fingerprint", _PIECE_ROWS, _LARGEST_PIECE)
    return per_unit(at.select("unit", "fingerprint"), "a long, b long", work)


def classes(marked: DataFrame, max_bits: int) -> DataFrame:
    """``fingerprint``, ``root`` (one per group) and ``component_id``, a row per fingerprint.

    ``marked`` has ``fingerprint`` and ``id``.
    """
    distinct = cut(marked.groupBy("fingerprint").agg(F.min("id").alias("id")), "fingerprints")
    stars = cut(components(links(distinct, max_bits)), "fingerprint-groups")
    placed = distinct.join(stars, distinct["fingerprint"] == stars["node"], "left").select(
        "fingerprint", "id", F.coalesce("root", "fingerprint").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    return placed.select("fingerprint", "root").join(named, "root")


def kept_rows(marked: DataFrame, max_bits: int) -> DataFrame:
    """One row of each group: of its smallest id, null last, and of rows alike in id the one with
    the smallest fingerprint and content hash.

    ``marked`` is a written table with ``doc``, ``fingerprint`` and ``id``. Whole rows are dealt
    out once, by fingerprint and id, so equal fingerprints do not gather in one task.
    """
    id_key = F.xxhash64(F.col("id").isNull(), "id")
    groups = classes(marked, max_bits).select("fingerprint", "root")
    chosen = (
        marked.groupBy("fingerprint")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("first"))
        .join(groups, "fingerprint")
        .groupBy("root")
        .agg(F.min(F.struct("first", "fingerprint")).alias("first"))
        .select(
            F.col("first.fingerprint").alias("fingerprint"),
            F.xxhash64(F.col("first.first.id").isNull(), "first.first.id").alias("id_key"),
        )
    )
    met = marked.withColumn("id_key", id_key).join(cut(chosen, "kept"), ["fingerprint", "id_key"])
    order = Window.partitionBy("fingerprint", "id_key").orderBy(F.xxhash64("doc"))
    return met.withColumn("place", F.row_number().over(order)).where("place = 1").select("doc")
