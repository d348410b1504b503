"""Connected components of a large graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmart.workspace import cut


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, for every node of ``edges``.

    ``edges`` has two long columns, ``a`` and ``b``. Each round ties every node's larger, then its
    smaller neighbours to the smallest one, until all edges lead to a root. The number of rounds
    grows with the logarithm of the longest path. A round's edges are a written table, never more
    than at the start; hubs are summed in part before they meet and their joins can be split.
    """
    state = cut(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct(),
        "edges",
    )
    before = None
    while (now := _digest(state)) != before:
        before = now
        if not now[0]:
            break
        state = cut(_small_star(cut(_large_star(state), "edges")), "edges")
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _digest(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Dealt out once more by itself: only of two plain shuffles can a hub's edges be split.
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low")).repartition("u")
    return (
        both.join(low, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    met = edges.join(low, "u").where(F.col("v") != F.col("low"))
    return (
        met.select(F.col("v").alias("u"), F.col("low").alias("v"))
        .unionByName(low.select("u", F.col("low").alias("v")))
        .distinct()
    )
