"""Near-duplicate embeddings by sorted projection passes.

A pass orders all vectors lexicographically by a string of random projection signs and compares each
with its ``WINDOW`` followers; verified pairs are united over all passes. Runs of vectors that share
the first signs of their strings and are longer than the window are compared whole, in pieces. So
two vectors at the threshold meet with a probability that depends on their angle alone, however
crowded a direction is, and the number of passes follows from the length of the shared beginning
and the wanted recall; the window only adds to it. Crowding costs time: the length is the one that
makes the passes cheapest for the measured sizes of runs.

Passes carry ids, strings and a sketch of ``_SKETCH`` further signs, not vectors. Of two neighbours
whose sketches differ by more than four standard deviations beyond what the threshold lets expect
(one in 20,000 pairs at the threshold) neither is fetched; the vectors of all others are, and decide.
Runs are compared after the windows' groups were united, and only between groups. Passes are run
in sets of ``_TOGETHER``, each leaving out what earlier ones united. The ends of the ranges that a
pass is sorted in are compared too; a range of fewer rows than the window ends it.

Vectors that are equal number for number are one class from the start. Pairs within a united group
that no pass compared are verified afterwards, in pieces, so a dense group loses no link. Vectors
that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors
of different length. Rows with a null id take part but never name a group; repeated rows are rows
of their own. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmart.llm.blocks import per_unit, roots_of_pairs, runs, units
from reviewmart.llm.common import as_doc, drawn
from reviewmart.llm.graph import components
from reviewmart.workspace import cut

#: Followers that a vector is compared with in each pass.
WINDOW = 64
# Signs of a string, and of a sketch.
_SIGNS, _SKETCH = 32, 128
# Shortest and longest beginning that makes a run, and passes and vectors that measure their sizes.
_SHALLOWEST, _DEEPEST, _PROBES, _PROBED = 8, 32, 4, 1 << 14
# Rows of a piece of a run, in very large runs, and comparisons that cost as much as bringing a row there.
_COMPARED_ROWS, _MOST_COMPARED, _ROW_COST = 1024, 2048, 1024
# Smaller runs cost hardly less; it keeps strings from growing beyond use.
_SMALL_RUN = 64
# Rows of a piece of a united group, and what they grow to in very large groups.
_PIECE_ROWS, _LARGEST_PIECE = 128, 1024
# Passes run together, and vectors projected at once.
_LEAST_PASSES, _TOGETHER, _PROJECTED = 16, 32, 1024


def passes_for(depth: int, threshold: float, recall: float) -> int:
    """Passes after which a pair at the threshold has shared a run with probability ``recall``."""
    met = (1 - math.acos(threshold) / math.pi) ** depth
    if met >= 1:
        return _LEAST_PASSES
    return max(_LEAST_PASSES, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def usable(vector: Column) -> Column:
    """Whether a vector has a direction."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as unit rows in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def most_different(threshold: float) -> int:
    """Signs of a sketch in which two vectors at the threshold may differ."""
    share = math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    return math.ceil(_SKETCH * share + 4 * math.sqrt(_SKETCH * share * (1 - share)))


def _different(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """In how many bits 64-bit integers differ."""
    # Of a signed number, its amount's bits would be counted.
    return np.bitwise_count((one ^ other).view(np.uint64))


def _signs(unit: np.ndarray, dim: int, seed: list[int], bits: int) -> np.ndarray:
    """Signs of projections, packed into bytes."""
    directions = np.random.default_rng([*seed, dim]).standard_normal((dim, bits))
    return np.packbits(unit @ directions >= 0, axis=1, bitorder="big")


def _per_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches of vectors of one length."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            rows = batch.filter(pa.array(dims == dim))
            for begin in range(0, rows.num_rows, _PROJECTED):
                yield rows.slice(begin, _PROJECTED)


def _sketched(classes: DataFrame, seed: int) -> DataFrame:
    """Add the sketch, as two long columns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _per_dim(batches):
            dim = rows.column("dim")[0].as_py()
            sketch = _signs(_matrix(rows.column("vector")), dim, [seed, -1 & 0xFFFF], _SKETCH).view(">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(sketch[:, 0]), pa.array(sketch[:, 1])], names=[*rows.schema.names, "g1", "g2"]
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    return classes.mapInArrow(work, f"{fields}, g1 long, g2 long")


def _strings(vectors: DataFrame, passes: range, seed: int) -> DataFrame:
    """``pass`` and the sign string ``key`` of each vector beside its other columns, for some passes."""
    others = [f for f in vectors.schema.fields if f.name != "vector"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _per_dim(batches):
            dim, unit = rows.column("dim")[0].as_py(), _matrix(rows.column("vector"))
            for number in passes:
                key = _signs(unit, dim, [seed, number], _SIGNS).view(">u4").ravel().astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(f.name) for f in others), pa.array(np.full(len(key), number, np.int32)), pa.array(key)],
                    names=[*(f.name for f in others), "pass", "key"],
                )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others)
    return vectors.mapInArrow(work, f"{fields}, pass int, key long")


def _beginning(key: Column, depth: Column | int) -> Column:
    """The first ``depth`` signs of a string."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", key, F.lit(_SIGNS) - depth)


def _depth(classes: DataFrame, n: int, threshold: float, recall: float, seed: int) -> int:
    """The length of beginnings at which the passes cost least, by the sizes of runs among some vectors.

    It decides how long the passes take, not which pairs they miss.
    """
    some = classes.where(drawn(F.col("cls"), _PROBED / max(n, 1))).select("cls", "dim", "vector")
    runs_of = (
        _strings(some, range(_PROBES), seed)
        .withColumn("depth", F.explode(F.sequence(F.lit(_SHALLOWEST), F.lit(_DEEPEST))))
        .groupBy("dim", "pass", "depth", _beginning(F.col("key"), F.col("depth")).alias("prefix"))
        .agg(F.count("*").alias("size"))
    )
    beyond = F.col("size") * (n / _PROBED) > WINDOW
    rows = runs_of.groupBy("depth").agg(
        F.sum("size").alias("rows"),
        F.sum(F.col("size") * (F.col("size") - 1)).alias("met"),
        F.sum(F.when(beyond, F.col("size")).otherwise(0)).alias("in_long_runs"),
    )
    cost = {}
    for row in rows.collect():
        # Others of a row's run, for all vectors.
        others = row["met"] / row["rows"] * n * _PROBES / row["rows"]
        met = max(others, _SMALL_RUN) * (1 + _ROW_COST / _COMPARED_ROWS)
        # Rows of runs longer than the window are brought to units of their own besides.
        brought = _ROW_COST * (1 + 2 * row["in_long_runs"] / row["rows"])
        cost[row["depth"]] = passes_for(row["depth"], threshold, recall) * (brought + met)
    return min(cost, key=lambda depth: (cost[depth], depth), default=_SHALLOWEST)


def _neighbours(rows: DataFrame, most: int) -> DataFrame:
    """``unit``, ``dim`` and ``cls`` of vectors that are like one of their followers, by sketch.

    Both of a pair are in one unit, which stands for a piece of a sorted range.
    """
    columns = ("dim", "pass", "key", "cls", "g1", "g2", "root")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        held = {name: np.empty(0, np.int64) for name in columns}
        for batch in batches:
            if not batch.num_rows:
                continue
            kept = len(held["cls"])
            at = {name: np.concatenate([held[name], batch.column(name).to_numpy().astype(np.int64)]) for name in columns}
            n, pairs = len(at["cls"]), []
            for step in range(1, min(WINDOW, n - 1) + 1):
                # Pairs whose later row is new.
                one, other = slice(max(kept - step, 0), n - step), slice(max(kept - step, 0) + step, n)
                differ = _different(at["g1"][one], at["g1"][other]) + _different(at["g2"][one], at["g2"][other])
                close = (differ <= most) & (at["dim"][one] == at["dim"][other]) & (at["pass"][one] == at["pass"][other])
                close &= (at["root"][one] != at["root"][other]) | (at["root"][one] < 0)
                first = np.flatnonzero(close) + one.start
                pairs.append(np.stack([first, first + step]))
            places = np.concatenate(pairs, axis=1) if pairs else np.empty((2, 0), np.int64)
            # The earlier row's place in its range says which unit a pair is compared in.
            piece = (places[0] + seen - kept) // _COMPARED_ROWS
            met = np.unique(np.stack([np.tile(piece, 2), places.ravel()]), axis=1)
            yield _in_units((part << 33) + 2 * met[0], at["dim"][met[1]], at["cls"][met[1]])
            if not seen and part:
                yield _in_units(np.full(min(n, WINDOW), ((part - 1) << 33) + 1), at["dim"][:WINDOW], at["cls"][:WINDOW])
            seen += n - kept
            held = {name: values[-WINDOW:] for name, values in at.items()}
        yield _in_units(np.full(len(held["cls"]), (part << 33) + 1), held["dim"], held["cls"])

    order = ("dim", "pass", "key", "cls")
    ordered = rows.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(work, "unit long, dim int, cls long")


def _in_units(unit: np.ndarray, dim: np.ndarray, cls: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"unit": unit.astype(np.int64), "dim": dim.astype(np.int32), "cls": cls.astype(np.int64)})


def _run_mates(rows: DataFrame, stars: DataFrame, depth: int, most: int) -> DataFrame:
    """``unit``, ``dim`` and ``cls`` of vectors that are like another of their run, by sketch, but not yet
    in one group of ``stars`` with it; for runs longer than the window."""
    run = ["dim", "pass", "prefix"]
    named = rows.withColumn("prefix", _beginning(F.col("key"), depth))
    long = named.groupBy(*run).agg(F.count("*").alias("size")).where(F.col("size") > WINDOW).select(*run)
    met = units(_rooted(named.drop("root").join(long, run), stars), run, "cls", _COMPARED_ROWS, _MOST_COMPARED)

    def work(unit: np.ndarray, table: pa.Table) -> pa.RecordBatch:
        at = {name: table.column(name).to_numpy() for name in ("g1", "g2", "root", "piece", "own", "cls", "dim")}
        found = []
        for begin, end in runs(unit):
            here = {name: values[begin:end] for name, values in at.items()}
            first = here["piece"] == here["piece"][0] if not here["own"][0] else np.ones(end - begin, bool)
            one = np.flatnonzero(first)
            other = one if here["own"][0] else np.flatnonzero(~first)
            differ = _different(here["g1"][one, None], here["g1"][None, other])
            differ += _different(here["g2"][one, None], here["g2"][None, other])
            close = (differ <= most) & ((here["root"][one, None] != here["root"][None, other]) | (here["root"][one, None] < 0))
            if here["own"][0]:
                np.fill_diagonal(close, False)
            mates = np.zeros(end - begin, bool)
            mates[one[close.any(axis=1)]] = True
            mates[other[close.any(axis=0)]] = True
            found.append(begin + np.flatnonzero(mates))
        places = np.concatenate(found)
        return _in_units(unit[places], at["dim"][places], at["cls"][places])

    columns = met.select("unit", "cls", "dim", "piece", "own", "g1", "g2", "root")
    return per_unit(columns, "unit long, dim int, cls long", work)


def _verified(met: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Edges between classes of a unit whose vectors reach the threshold, as a forest."""
    rows = met.join(classes.select("cls", "vector"), "cls").select(F.xxhash64("unit", "dim").alias("unit"), "cls", "vector")

    def work(unit: np.ndarray, table: pa.Table) -> pa.RecordBatch:
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        cls = table.column("cls").to_numpy()
        for begin, end in runs(unit):
            rows = _matrix(table.column("vector").slice(begin, end - begin))
            i, j = np.nonzero(np.triu(rows @ rows.T >= threshold, 1))
            some = cls[begin:end]
            root = roots_of_pairs(len(some), i, j)
            moved = np.flatnonzero(root != np.arange(len(some)))
            left.append(some[moved])
            right.append(some[root[moved]])
        return pa.RecordBatch.from_pydict({"a": np.concatenate(left), "b": np.concatenate(right)})

    return per_unit(rows, "a long, b long", work)


def _groups(classes: DataFrame, threshold: float, recall: float, seed: int) -> DataFrame:
    """``node`` and ``root`` of all classes that the passes unite with others."""
    depth, most = _depth(classes, classes.count(), threshold, recall, seed), most_different(threshold)
    passes = passes_for(depth, threshold, recall)
    edges = stars = None
    for begin in range(0, passes, _TOGETHER):
        vectors = _rooted(classes.select("cls", "dim", "vector", "g1", "g2"), stars)
        strings = cut(_strings(vectors, range(begin, min(begin + _TOGETHER, passes)), seed), "vector-strings")
        for finds in (lambda: _neighbours(strings, most), lambda: _run_mates(strings, stars, depth, most)):
            fresh = cut(_verified(finds(), classes, threshold), "vector-edges")
            if stars is not None and fresh.isEmpty():
                continue
            edges = fresh if edges is None else edges.unionByName(fresh)
            stars = cut(components(edges), "vector-groups")
            # The groups' stars say all that their edges did.
            edges = stars.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    return stars


def _rooted(rows: DataFrame, stars: DataFrame | None) -> DataFrame:
    """Add ``root``, -1 for what is in no group yet."""
    if stars is None:
        return rows.withColumn("root", F.lit(-1).cast("long"))
    return rows.join(stars.withColumnRenamed("node", "cls"), "cls", "left").fillna(-1, ["root"])


def _group_links(members: DataFrame, threshold: float) -> DataFrame:
    """``cls`` and ``links``: how many vectors outside the class it links to in its group.

    All pairs of a group are verified, in units of two pieces; a unit emits sums, not pairs.
    """

    def work(unit: np.ndarray, table: pa.Table) -> pa.RecordBatch:
        cls, copies = table.column("cls").to_numpy(), table.column("copies").to_numpy()
        piece, own = table.column("piece").to_numpy(), table.column("own").to_numpy()
        links = np.zeros(len(cls), np.int64)
        for begin, end in runs(unit):
            rows = _matrix(table.column("vector").slice(begin, end - begin))
            close = rows @ rows.T >= threshold
            np.fill_diagonal(close, False)
            # A unit of two pieces counts links from one to the other only.
            if not own[begin]:
                p = piece[begin:end]
                close &= p[:, None] != p[None, :]
            links[begin:end] = close @ copies[begin:end]
        return pa.RecordBatch.from_pydict({"cls": cls, "links": links})

    rows = units(members, ["root"], "cls", _PIECE_ROWS, _LARGEST_PIECE)
    return (
        per_unit(
            rows.select("unit", "cls", "copies", "piece", "own", "vector"), "cls long, links long", work
        )
        .groupBy("cls")
        .agg(F.sum("links").alias("links"))
    )


def link(
    rows: DataFrame,
    vector_col: str = "embedding",
    id_col: str = "vec_id",
    threshold: float = 0.9,
    recall: float = 0.98,
    seed: int = 11,
) -> DataFrame:
    """``doc``, ``n_links`` and ``component_id`` (the smallest id of the group; its own if alone)."""
    vector = F.col("vector")
    named = rows.select(
        as_doc(rows), rows[f"`{id_col}`"].alias("id"), rows[f"`{vector_col}`"].alias("vector")
    ).withColumn("usable", usable(vector))
    classes = cut(
        named.where("usable")
        .groupBy("vector")
        .agg(F.min("id").alias("id"), F.count("*").alias("copies"))
        .select(
            F.monotonically_increasing_id().alias("cls"),
            F.size("vector").alias("dim"),
            "vector",
            "id",
            "copies",
        ),
        "vector-classes",
    )
    classes = cut(_sketched(classes, seed), "sketched-classes")
    stars = _groups(classes, threshold, recall, seed)
    members = classes.join(stars.withColumnRenamed("node", "cls"), "cls")
    links = _group_links(members.select("cls", "root", "copies", "vector"), threshold)
    groups = members.groupBy("root").agg(F.min("id").alias("component_id"))
    of_class = cut(
        classes.join(members.select("cls", "root"), "cls", "left")
        .join(groups, "root", "left")
        .join(links, "cls", "left")
        .select(
            F.col("vector").alias("class_vector"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
            F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        ),
        "vector-links",
    )
    linked = (
        named.where("usable")
        .join(of_class, vector == F.col("class_vector"))
        .select("doc", F.col("links").alias("n_links"), "component_id")
    )
    alone = named.where("not usable").select(
        "doc", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked.unionByName(alone)
