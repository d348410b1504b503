"""The prefix trie of conversations, from double arrays over shards of prefixes.

A conversation is a sequence of turns (role, text); every distinct sequence of first turns is a node.
Conversations are cut into segments of ``SEGMENT`` turns that know the key of the prefix before
them. Equal segments become one, with the number of their conversations, and are dealt out by ranges
of their prefix and turns, so that a prefix that very many share is spread like any other. A shard is
a run of neighbouring segments: its turns get dense ids, BASE and CHECK arrays are packed over them,
and walking the arrays sums up the nodes. Upper nodes that several shards share are then merged by
their keys. A key is the depth and two 64-bit sums (exclusive or) of the hashes of turns at their
places, which can be added up in any order and so never needs a conversation in one task.

Sums over subtrees need no rounds: a node belongs to its smallest member, so each conversation owns
the lower end of its path. A node's sum is that of its owner's nodes from there on, and all that its
other members own.

Rows without a conversation id belong to no conversation and are left out. Null roles and texts are
empty; turns come in order of their number, null first, and those of one number by the MD5 of role
and text; repeated rows are repeated turns. Without any conversation there is no node, not even the
root. Texts of any length are taken whole, other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmart.llm.common import n_words, text_of
from reviewmart.llm.numbering import numbered
from reviewmart.workspace import cut

SEGMENT = 32
# Turns of one conversation that are ordered in one task.
BLOCK = 1 << 15
# Bytes of a list of ids that are one row on the way to its checksum.
_LISTED_BYTES = 4096
_KEY = ["depth", "x1", "x2"]


def ordered(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv``, ``place`` (from 0), ``key`` and ``words`` of every turn, and its conversation's ``turns``."""
    role, text = text_of(rows, role_col), text_of(rows, text_col)
    compact = cut(
        rows.where(rows[f"`{conv_col}`"].isNotNull()).select(
            rows[f"`{conv_col}`"].cast("long").alias("conv"),
            rows[f"`{turn_col}`"].alias("turn"),
            F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
            n_words(text).alias("words"),
            # Lets ranges divide rows that are alike.
            F.xxhash64(F.monotonically_increasing_id()).alias("salt"),
        ),
        "turns",
    )
    order = (F.col("conv"), F.col("turn").asc_nulls_first(), F.col("key"), F.col("salt"))
    placed = cut(numbered(compact, *order, name="at").drop("turn", "salt"), "turns-in-order")
    # A table of its own, so that a join can divide the turns of a long conversation.
    begins = cut(
        placed.groupBy("conv").agg(F.min("at").alias("begin"), F.count("*").alias("turns")), "conversation-begins"
    )
    return placed.join(begins, "conv").select("conv", (F.col("at") - F.col("begin")).alias("place"), "key", "words", "turns")


def rebuilt(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations begun with turns of the first one of their ``every``: turns, and conversations.

    The first h turns of a conversation c are replaced by those of c - c % every (as many as it has),
    where h is the checksum of c modulo ``most``.
    """
    turns = cut(turns, "placed-turns")
    base = (F.col("conv") - F.col("conv") % every).alias("base")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h")
    sizes = cut(turns.groupBy("conv").agg(F.first("turns").alias("turns")).select("conv", "turns", base, h), "conversations")
    given = sizes.where(F.col("conv") == F.col("base")).select("base", F.col("turns").alias("given"))
    taken = F.least("h", F.coalesce("given", F.lit(0))).cast("long")
    convs = cut(
        sizes.join(given, "base", "left").select(
            "conv", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("turns")
        ),
        "rebuilt-conversations",
    )
    # A base has less than ``most`` of these turns and less than twice ``every`` followers.
    heads = turns.where((F.col("place") < most - 1) & (F.col("conv") % every == 0)).select(
        F.col("conv").alias("base"), "place", "key", "words"
    )
    begun = convs.where("taken > 0").join(heads, "base").where(F.col("place") < F.col("taken"))
    own = turns.drop("turns").join(convs, "conv").where(F.col("place") >= F.col("h"))
    columns = ("conv", "key", "words", "turns")
    return (
        begun.select(*columns, "place").unionByName(
            own.select(*columns, (F.col("place") - F.col("h") + F.col("taken")).alias("place"))
        ),
        convs.select("conv", "turns"),
    )


def _before(
    rows: DataFrame, place: str, columns: tuple[str, ...], fold: Callable[[str], Column], add: Callable[[Column, Column], Column], last_first: bool = False, most: int = BLOCK
) -> DataFrame:
    """``rows`` of a written table with ``before_`` sums of the same ``conv`` up to each row, without it.

    Blocks of a conversation are summed apart, so that the longest ones are spread; only
    conversations of more ``turns`` than a block need their blocks' sums.
    """
    order = F.col(place).desc() if last_first else F.col(place)
    within = Window.partitionBy("conv", "block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")

    def summed(some: DataFrame) -> DataFrame:
        return some.select("*", *(F.coalesce(fold(c).over(within), none).alias(f"before_{c}") for c in columns))

    long = rows.where(F.col("turns") > most)
    totals = long.groupBy("conv", "block").agg(*(fold(c).alias(c) for c in columns))
    block = F.col("block").desc() if last_first else F.col("block")
    across = Window.partitionBy("conv").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("conv", "block", *(F.coalesce(fold(c).over(across), none).alias(f"_{c}") for c in columns))
    joined = summed(long).join(offsets, ["conv", "block"])
    added = joined.select(*rows.columns, *(add(F.col(f"before_{c}"), F.col(f"_{c}")).alias(f"before_{c}") for c in columns))
    return summed(rows.where(F.col("turns") <= most)).unionByName(added)


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def _segments(turns: DataFrame, segment: int, block: int) -> DataFrame:
    """``conv``, ``turns``, ``band``, the key ``s1``, ``s2`` before the segment, that at its end, and its ``entries``."""
    dealt = turns.select(
        "conv",
        "turns",
        "place",
        F.floor(F.col("place") / block).alias("block"),
        F.floor(F.col("place") / segment).alias("band"),
        F.xxhash64("key", "place").alias("t1"),
        F.xxhash64(F.lit("second"), "key", "place").alias("t2"),
        "words",
    ).repartition("conv", "block")
    entry = F.sort_array(F.collect_list(F.struct("place", "t1", "t2", "words")))
    grouped = dealt.groupBy("conv", "block", "band").agg(
        F.first("turns").alias("turns"),
        F.bit_xor("t1").alias("e1"),
        F.bit_xor("t2").alias("e2"),
        F.transform(entry, lambda e: F.struct(e["t1"].alias("t1"), e["t2"].alias("t2"), e["words"].alias("words"))).alias("entries"),
    )
    begun = _before(cut(grouped, "segments"), "band", ("e1", "e2"), F.bit_xor, _xor, most=block)
    return begun.select(
        "conv",
        "turns",
        "band",
        F.col("before_e1").alias("s1"),
        F.col("before_e2").alias("s2"),
        _xor(F.col("e1"), F.col("before_e1")).alias("e1"),
        _xor(F.col("e2"), F.col("before_e2")).alias("e2"),
        "entries",
    )


class DoubleArray:
    """A trie in two arrays: the child of state ``s`` by symbol ``c`` is ``base[s] + c`` if ``check`` there is ``s``.

    Sequences are of symbols from 1 on, and those that share a beginning are neighbours.
    """

    # Free places tried before siblings are put at the end.
    _TRIED = 8

    def __init__(self, sequences: list[list[int]]) -> None:
        self.base, self.check = [0], [0]
        self._free = 1
        waiting = [(0, 0, len(sequences), 0)]
        while waiting:
            state, begin, end, depth = waiting.pop()
            groups, i = [], begin
            while i < end:
                row = sequences[i]
                if len(row) == depth:
                    i += 1
                    continue
                symbol, j = row[depth], i + 1
                while j < end and len(sequences[j]) > depth and sequences[j][depth] == symbol:
                    j += 1
                groups.append((symbol, i, j))
                i = j
            if groups:
                base = self._place([symbol for symbol, _, _ in groups], state)
                waiting.extend((base + symbol, i, j, depth + 1) for symbol, i, j in groups)

    def _place(self, symbols: list[int], state: int) -> int:
        check, low, at = self.check, min(symbols), self._free
        for _ in range(self._TRIED):
            while at < len(check) and check[at] >= 0:
                at += 1
            base = at - low
            if all(base + s >= len(check) or check[base + s] < 0 for s in symbols):
                break
            at += 1
        else:
            base = len(check) - low
        grown = base + max(symbols) + 1 - len(check)
        if grown > 0:
            check.extend([-1] * grown)
            self.base.extend([0] * grown)
        for symbol in symbols:
            check[base + symbol] = state
        while self._free < len(check) and check[self._free] >= 0:
            self._free += 1
        self.base[state] = base
        return base

    def walk(self, sequence: list[int]) -> list[int]:
        """The states a sequence leads through."""
        states, state, base, check = [], 0, self.base, self.check
        for symbol in sequence:
            following = base[state] + symbol
            if not 0 < following < len(check) or check[following] != state:
                break
            state = following
            states.append(state)
        return states


def _dense(levels: np.ndarray, *parts: np.ndarray) -> np.ndarray:
    """Ids from 1 for equal ``parts``, level by level and in order of their first place there."""
    order = np.argsort(levels, kind="stable")
    pairs = np.rec.fromarrays([part[order] for part in parts])
    _, first, inverse = np.unique(pairs, return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(1, len(first) + 1)
    out = np.empty(len(levels), np.int64)
    out[order] = rank[inverse]
    return out


def _shard(batch: pa.RecordBatch, segment: int) -> pa.RecordBatch:
    """The nodes of one shard: key, parent's key, last words, members and the smallest of them."""
    lists = batch.column("entries")
    begins = lists.offsets.to_numpy()
    flat = lists.values
    t1, t2 = (flat.field(name).to_numpy() for name in ("t1", "t2"))
    t1, t2 = t1[begins[0] : begins[-1]], t2[begins[0] : begins[-1]]
    words = flat.field("words").to_numpy()[begins[0] : begins[-1]].tolist()
    begins = begins - begins[0]
    row = np.repeat(np.arange(batch.num_rows), np.diff(begins))
    symbols = _dense(np.arange(len(row)) - begins[row], t1, t2)
    band, s1, s2 = (batch.column(name).to_numpy() for name in ("band", "s1", "s2"))
    # The prefix before a segment is its first symbol, beyond those of turns.
    starts = (_dense(np.zeros(batch.num_rows, np.int64), band, s1, s2) + int(symbols.max(initial=0))).tolist()
    symbols, begins = symbols.tolist(), begins.tolist()
    sequences = [[starts[i], *symbols[begins[i] : begins[i + 1]]] for i in range(batch.num_rows)]
    trie = DoubleArray(sequences)

    t1, t2 = t1.tolist(), t2.tolist()
    band, s1, s2 = band.tolist(), s1.tolist(), s2.tolist()
    convs, conv, turns = (batch.column(name).to_pylist() for name in ("convs", "conv", "turns"))
    found: dict[int, list] = {}
    for i, sequence in enumerate(sequences):
        x1, x2, depth = s1[i], s2[i], band[i] * segment
        for at, state in enumerate(trie.walk(sequence)[1:], begins[i]):
            p1, p2 = x1, x2
            x1, x2, depth = x1 ^ t1[at], x2 ^ t2[at], depth + 1
            node = found.get(state)
            if node is None:
                found[state] = [depth, x1, x2, p1, p2, words[at], convs[i], conv[i], turns[i]]
            else:
                node[6] += convs[i]
                if conv[i] < node[7]:
                    node[7:] = conv[i], turns[i]
    columns = zip(*found.values(), strict=True) if found else [[] for _ in _NODE]
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], schema=_NODE)


_NODE = pa.schema([(name, pa.int64()) for name in ("depth", "x1", "x2", "p1", "p2", "words", "n_convs", "conv", "turns")])


def _nodes(segments: DataFrame, convs: DataFrame, segment: int) -> DataFrame:
    """All nodes with their members, from the shards' parts."""

    def tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _shard(batch, segment)

    paths = cut(
        segments.groupBy("band", "s1", "s2", "e1", "e2").agg(
            F.first("entries").alias("entries"),
            F.count("*").alias("convs"),
            F.min(F.struct("conv", "turns")).alias("least"),
        ),
        "paths",
    )
    order = ("band", "s1", "s2", "entries")
    dealt = paths.repartitionByRange(*order).sortWithinPartitions(*order)
    columns = dealt.select(*order, "convs", "least.conv", "least.turns")
    parts = columns.mapInArrow(tries, ", ".join(f"{name} long" for name in _NODE.names))
    whole = convs.agg(F.count("*").alias("n_convs"), F.min(F.struct("conv", "turns")).alias("least")).where("n_convs > 0")
    root = whole.select(
        *(F.lit(0).cast("long").alias(name) for name in ("depth", "x1", "x2", "p1", "p2", "words")), "n_convs", "least.conv", "least.turns"
    )
    merged = parts.groupBy(*_KEY).agg(
        F.first("p1").alias("p1"),
        F.first("p2").alias("p2"),
        F.first("words").alias("words"),
        F.sum("n_convs").alias("n_convs"),
        F.min(F.struct("conv", "turns")).alias("least"),
    )
    return merged.select(*_KEY, "p1", "p2", "words", "n_convs", "least.conv", "least.turns").unionByName(root)


def _shared(segments: DataFrame, owned: DataFrame, segment: int) -> DataFrame:
    """For nodes that are not their members' own: the sums of all that these members own."""
    met = segments.select("conv", "band", "s1", "s2", "entries").join(owned.where("top > 1"), "conv")
    above = F.col("top") - 1 - F.col("band") * segment

    def key_after(n: Column, i: int) -> Column:
        return F.aggregate(F.slice("entries", 1, n), F.col(f"s{i}"), lambda x, e: _xor(x, e[f"t{i}"])).alias(f"x{i}")

    steps = F.transform(
        F.sequence(F.lit(1), F.least(above, F.size("entries")).cast("int")),
        lambda n: F.struct((F.col("band") * segment + n).alias("depth"), key_after(n, 1), key_after(n, 2)),
    )
    exploded = met.where(above > 0).select(F.explode(steps).alias("node"), "leaves", "saved").select("node.*", "leaves", "saved")
    # Every member but the root's owner owns no root.
    root = owned.where("top > 0").select(*(F.lit(0).cast("long").alias(name) for name in _KEY), "leaves", "saved")
    return exploded.unionByName(root).groupBy(*_KEY).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))


def _ends(segments: DataFrame, convs: DataFrame, segment: int) -> DataFrame:
    """The checksum of the ids of the conversations that end at a node, ascending and joined by commas.

    Ranges of ids become text in tasks of their own; only these texts meet, one after another.
    """
    ends = segments.where((F.col("band") + 1) * segment >= F.col("turns")).select(
        F.col("turns").alias("depth"), F.col("e1").alias("x1"), F.col("e2").alias("x2"), "conv"
    )
    none = F.lit(0).cast("long")
    turnless = convs.where("turns = 0").select(none.alias("depth"), none.alias("x1"), none.alias("x2"), "conv")
    order = (*_KEY, "conv")
    dealt = cut(ends.unionByName(turnless), "ends").repartitionByRange(*order).sortWithinPartitions(*order)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, at = [], None
            for depth, x1, x2, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (depth, x1, x2) != at or len(held[-1][4]) > _LISTED_BYTES:
                    held.append([depth, x1, x2, conv, str(conv)])
                    at = depth, x1, x2
                else:
                    held[-1][4] += f",{conv}"
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _LISTED.types, strict=True)] if held else [pa.array([], t) for t in _LISTED.types], schema=_LISTED)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            out = []
            for depth, x1, x2, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (depth, x1, x2) == at:
                    digest.update(f",{ids}".encode())
                    continue
                if at:
                    out.append((*at, digest.hexdigest()))
                at, digest = (depth, x1, x2), hashlib.sha256(ids.encode())
            yield _summed(out)
        if at:
            yield _summed([(*at, digest.hexdigest())])

    parts = dealt.mapInArrow(listed, "depth long, x1 long, x2 long, conv long, ids string")
    met = parts.repartition(*_KEY).sortWithinPartitions(*order)
    return met.mapInArrow(summed, "depth long, x1 long, x2 long, ends_sha256 string")


_LISTED = pa.schema([("depth", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64()), ("conv", pa.int64()), ("ids", pa.string())])
_SUMMED = pa.schema([("depth", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64()), ("ends_sha256", pa.string())])


def _summed(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(_SUMMED.names, row, strict=True)) for row in rows], schema=_SUMMED)


def trie(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie over ``turns`` (``conv``, ``place``, ``key``, ``words``, ``turns``).

    ``convs`` names every conversation (``conv``) and how many ``turns`` it has, also those without
    any. A node's ``conv_id`` is its smallest member; see the module for the other columns. A segment
    has ``segment`` turns, and a task orders up to ``block`` turns of one conversation, a multiple.
    """
    segments = cut(_segments(turns, segment, block), "begun-segments")
    nodes = cut(_nodes(segments, convs, segment), "trie-parts")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"))
    counted = nodes.join(children.agg(F.count("*").alias("n_children")), _KEY, "left").fillna(0, ["n_children"])
    valued = cut(
        counted.select(
            "*",
            (F.col("n_children") == 0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
            F.floor(F.col("depth") / block).alias("block"),
        ),
        "trie-nodes",
    )
    owned = cut(
        valued.groupBy("conv").agg(F.min("depth").alias("top"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")),
        "owned",
    )
    below = _before(valued, "depth", ("leaves", "saved"), F.sum, lambda a, b: a + b, last_first=True, most=block)
    parent = valued.select(
        (F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv").alias("parent_conv_id")
    )
    return (
        below.join(_shared(segments, owned, segment), _KEY, "left")
        .join(_ends(segments, convs, segment), _KEY, "left")
        .join(parent, ["depth", "p1", "p2"], "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            (F.col("before_leaves") + F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("before_saved") + F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
