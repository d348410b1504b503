"""Ranked lexical search: bit-sliced Bloom signatures rule documents out, the others are scored exactly.

Terms are runs of ASCII letters and digits and of characters beyond ASCII, A to Z in lower case. A
document's signature holds each of its terms at every level of ``_LEVELS`` that its frequency
reaches; levels lie close together, so bounds do too. Documents of one task with about equally many entries form a block; its signatures are kept
as bit slices, one bitmap over the block's documents per signature bit. A term's slices, intersected,
show all documents that may hold it, and perhaps more. The weighted sum of what each level can add
to the score, for the document's own length, is a bound that no score exceeds.

The documents with the highest bounds of each query are scored first; their lowest score of rank
``k`` excludes every document whose bound is below it. All others are scored from their texts.

Null and empty texts have no terms, score nothing and do not count as documents; neither do queries
without terms get a row. Texts of any length are taken whole. Equal scores rank by ascending id, null
ids last; repeated rows are documents of their own and rank one after another. Empty tables give no
rows. Other columns play no part.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmart.operators.joins import USUAL, measured_bytes
from reviewmart.workspace import cut

# In UTF-8, bytes of ASCII letters and digits and all from 128 on belong to terms.
_BYTES = bytes(
    code + 32 if 65 <= code <= 90 else code if 48 <= code <= 57 or 97 <= code <= 122 or code > 127 else 32 for code in range(256)
)
# Frequencies that an entry of their own marks; between two of them the upper one bounds the score.
_LEVELS = (*range(1, 17), *(16 * 9**n // 8**n for n in range(1, 94)))
# Documents with the highest bounds that are scored first, for each one that is asked for.
_FIRST = 8
# Bits set for an entry, and bits of a signature for an entry of the block's fullest document.
_HASHES, _BITS = 5, 12
# Fixed value: what a term is made of.
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
# Terms whose hashes a task keeps, and the longest of them in bytes.
_KEPT, _LONGEST_KEPT = 200_000, 64
# Documents of a block, and bytes of its slices.
_ROWS, _BLOCK_BYTES = 1024, 8 << 20
# Characters of query texts searched for in one go, over all documents.
QUERY_CHARS = 8 << 20
#: The bound of a term's frequency part, in thousandths of its weight.
_MOST = 1_000_000


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats."""
    return (text or b"").translate(_BYTES).split()


def _gain(tf: int, m: int) -> int:
    """What a term's frequency adds to the score, per unit of its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class _Digests(dict):
    """Hashes of terms, kept for the next time; a full table starts anew."""

    def __missing__(self, term: bytes) -> bytes:
        if len(self) >= _KEPT:
            self.clear()
        digest = xxhash.xxh3_128_digest(term)
        if len(term) <= _LONGEST_KEPT:
            self[term] = digest
        return digest


def _hashes(digests: _Digests, words: Iterable[bytes]) -> np.ndarray:
    """Two hashes of each word."""
    return np.frombuffer(b"".join(map(digests.__getitem__, words)), np.uint64).reshape(-1, 2)


def _at_level(hashes: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    """Two hashes of each entry, from those of its term; its bits follow from them for any width."""
    mixed = (hashes + np.asarray(level, np.uint64).reshape(-1, 1) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(31))


def _entries(digests: _Digests, counts: Counter) -> np.ndarray:
    """Hashes of a document's entries: each term at every level that its frequency reaches."""
    levels = np.searchsorted(_LEVELS, np.fromiter(counts.values(), np.int64, len(counts)), "right")
    before = np.cumsum(levels) - levels
    level = np.arange(levels.sum()) - np.repeat(before, levels)
    return _at_level(np.repeat(_hashes(digests, counts), levels, axis=0), level)


def _bits(hashes: np.ndarray, width: int) -> np.ndarray:
    """The bits of entries in signatures of ``width`` bits, a power of two."""
    step = hashes[:, 1:] | np.uint64(1)
    return ((hashes[:, :1] + np.arange(_HASHES, dtype=np.uint64) * step) & np.uint64(width - 1)).astype(np.int64)


_BLOCKS = pa.schema(
    [("width", pa.int64()), ("rows", pa.int32()), ("slices", pa.binary())]
    + [(name, pa.list_(pa.int64())) for name in ("doc_id", "check", "length")]
    + [("known", pa.list_(pa.bool_()))]
)


def _block(width: int, docs: list[tuple[int | None, int, int, np.ndarray]]) -> dict:
    """A block of documents: an array of ``width`` bitmaps over them."""
    slices = np.zeros((width, (len(docs) + 7) // 8), np.uint8)
    for i, (_, _, _, hashes) in enumerate(docs):
        slices[_bits(hashes, width).ravel(), i >> 3] |= np.uint8(1 << (i & 7))
    return {
        "width": width,
        "rows": len(docs),
        "slices": slices.tobytes(),
        "doc_id": [d or 0 for d, _, _, _ in docs],
        "known": [d is not None for d, _, _, _ in docs],
        "check": [check for _, check, _, _ in docs],
        "length": [n for _, _, n, _ in docs],
    }


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of signatures over all documents, written to the shared folder."""
    texts = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks, digests = {}, _Digests()
        for batch in batches:
            for doc_id, check, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = Counter(terms(text))
                if not counts:
                    continue
                entries = _entries(digests, counts)
                width = 1 << max(6, math.ceil(math.log2(_BITS * len(entries))))
                held = open_blocks.setdefault(width, [])
                held.append((doc_id, check, counts.total(), entries))
                if len(held) >= max(8, min(_ROWS, 8 * _BLOCK_BYTES // width)):
                    yield pa.RecordBatch.from_pylist([_block(width, open_blocks.pop(width))], schema=_BLOCKS)
        for width, held in open_blocks.items():
            yield pa.RecordBatch.from_pylist([_block(width, held)], schema=_BLOCKS)

    schema = (
        "width long, rows int, slices binary, doc_id array<long>, check array<long>, length array<long>, known array<boolean>"
    )
    return cut(texts.select("doc_id", F.xxhash64("text").alias("check"), F.col("text").cast("binary")).mapInArrow(work, schema), "signatures")


@dataclass(frozen=True)
class Queries:
    """Some queries with all that scoring needs."""

    items: tuple[int | None, ...]
    words: tuple[dict[bytes, int], ...]  # how often each term occurs in the query
    weight: dict[bytes, int]
    n_docs: int
    n_terms: int

    def m(self, length: int) -> int:
        return 25 + (75 * length * self.n_docs) // self.n_terms

    def score(self, number: int, counts: Counter, length: int) -> int:
        """The exact score of a document for a query."""
        m, weight = self.m(length), self.weight
        return sum(
            times * weight[term] * _gain(counts[term], m) for term, times in self.words[number].items() if term in counts
        )


class _Bounds:
    """Upper bounds of a block's documents, for all queries."""

    def __init__(self, queries: Queries) -> None:
        self.queries = queries
        self.terms = sorted(queries.weight)
        hashes = _hashes(_Digests(), self.terms)
        self.hashes = [_at_level(hashes, level) for level in range(len(_LEVELS))]

    def of(self, block: dict) -> Iterator[tuple[int, np.ndarray]]:
        """Each query's number, and the bounds of the block's documents (0: no term)."""
        n, width = block["rows"], block["width"]
        slices = np.frombuffer(block["slices"], np.uint8).reshape(width, -1)
        queries = self.queries
        length = np.array(block["length"], object)
        m = np.array([queries.m(int(x)) for x in length], np.float64)
        tops = np.array(block["length"], np.float64)
        # What a frequency below the next level can add at most, for each document; rounded up.
        steps, before = [], np.zeros(n)
        for level, following in zip(_LEVELS, (*_LEVELS[1:], None), strict=True):
            tf = np.minimum(tops, following - 1 if following else np.inf)
            most = np.minimum(np.ceil(1e9 * tf / (1000 * tf + 8 * m)) + 1, _MOST)
            steps.append(np.where(tops >= level, most - before, 0))
            before = np.where(tops >= level, most, before)
        gains: dict[bytes, np.ndarray] = {}
        alive, held = np.arange(len(self.terms)), None
        for level, step in enumerate(steps):
            # Terms that no document may hold at this level are not looked up at the next.
            maps = np.bitwise_and.reduce(slices[_bits(self.hashes[level][alive], width)], axis=1)
            some = maps.any(axis=1)
            alive, maps = alive[some], maps[some]
            if not len(alive):
                break
            held = np.unpackbits(maps, axis=1, count=n, bitorder="little").astype(bool)
            for at, row in zip(alive.tolist(), held, strict=True):
                term = self.terms[at]
                if level:
                    row &= gains[term] > 0
                    gains[term] = gains[term] + row * step
                else:
                    gains[term] = row * step
        for number, words in enumerate(queries.words):
            bound = np.zeros(n)
            for term, times in words.items():
                if (gain := gains.get(term)) is not None:
                    bound += times * queries.weight[term] * gain
            yield number, bound


def _highest(blocks: DataFrame, queries: Queries, k: int) -> DataFrame:
    """The ``k`` documents with the highest bounds of each query."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, best = _Bounds(queries), [[] for _ in queries.items]
        for batch in batches:
            for block in batch.to_pylist():
                for number, bound in bounds.of(block):
                    heap = best[number]
                    least = heap[0][0] if len(heap) == k else 0.0
                    for i in np.flatnonzero(bound > least).tolist():
                        entry = (float(bound[i]), block["known"][i], block["doc_id"][i], block["check"][i])
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
        rows = [
            {"number": number, "bound": bound, "doc_id": d if known else None, "check": check}
            for number, heap in enumerate(best)
            for bound, known, d, check in heap
        ]
        yield pa.RecordBatch.from_pylist(rows, schema=_BOUNDED)

    found = blocks.mapInArrow(work, "number int, bound double, doc_id long, check long")
    order = Window.partitionBy("number").orderBy(F.col("bound").desc(), "check", "doc_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


_BOUNDED = pa.schema([("number", pa.int32()), ("bound", pa.float64()), ("doc_id", pa.int64()), ("check", pa.int64())])


def _not_excluded(blocks: DataFrame, queries: Queries, least: list[int]) -> DataFrame:
    """All documents whose bound reaches a query's ``least`` score."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = _Bounds(queries)
        for batch in batches:
            for block in batch.to_pylist():
                parts = []
                for number, bound in bounds.of(block):
                    # Above, so that no rounding of the sum excludes a document.
                    at = np.flatnonzero(bound * (1 + 1e-9) >= max(least[number], 1))
                    parts.extend(
                        {
                            "number": number,
                            "bound": float(bound[i]),
                            "doc_id": block["doc_id"][i] if block["known"][i] else None,
                            "check": block["check"][i],
                        }
                        for i in at.tolist()
                    )
                yield pa.RecordBatch.from_pylist(parts, schema=_BOUNDED)

    return blocks.mapInArrow(work, "number int, bound double, doc_id long, check long")


def _scored(docs: DataFrame, candidates: DataFrame, queries: Queries, label: str) -> DataFrame:
    """``number``, ``doc_id`` and exact ``score`` of the candidates, a row per document with that id and text."""
    wanted = cut(
        candidates.groupBy("doc_id", "check").agg(F.array_sort(F.collect_set("number")).alias("numbers")), f"{label}-candidates"
    )
    if measured_bytes(wanted) <= USUAL.broadcast_bytes:
        wanted = F.broadcast(wanted)
    met = docs.join(
        wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (docs["check"] == wanted["check"])
    ).select(docs["doc_id"], F.col("text").cast("binary"), "numbers")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, numbers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = Counter(terms(text))
                length = sum(counts.values())
                rows.extend(
                    {"number": number, "doc_id": doc_id, "score": queries.score(number, counts, length)} for number in numbers
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_SCORED)

    return met.mapInArrow(work, "number int, doc_id long, score long").where("score > 0")


_SCORED = pa.schema([("number", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _statistics(docs: DataFrame, words: frozenset[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """Documents with terms, all their terms, and the documents that hold each of ``words``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, held = 0, 0, Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = terms(text)
                n, total = n + bool(found), total + len(found)
                held.update(words.intersection(found))
        names = [b"", *held]
        yield pa.RecordBatch.from_pydict(
            {"term": names, "docs": [n, *held.values()], "total": [total, *[0] * len(held)]}, schema=_COUNTED
        )

    rows = (
        docs.select(F.col("text").cast("binary"))
        .mapInArrow(work, "term binary, docs long, total long")
        .groupBy("term")
        .agg(F.sum("docs").alias("docs"), F.sum("total").alias("total"))
        .collect()
    )
    counted = {bytes(row["term"]): (row["docs"], row["total"]) for row in rows}
    n, total = counted.pop(b"", (0, 0))
    return n, total, {term: docs for term, (docs, _) in counted.items()}


_COUNTED = pa.schema([("term", pa.binary()), ("docs", pa.int64()), ("total", pa.int64())])


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of each query's ``k`` best documents.

    Queries are searched for in parts of about ``QUERY_CHARS`` characters, so that a part fits into
    a task; every part reads the index and the statistics of all documents.
    """
    texts = docs.select(
        docs[f"`{id_col}`"].cast("long").alias("doc_id"),
        docs[f"`{text_col}`"].alias("text"),
        F.xxhash64(docs[f"`{text_col}`"]).alias("check"),
    )
    # Queries without a term find nothing.
    asked = cut(
        items.select(
            items[f"`{item_col}`"].cast("long").alias("item_id"), items[f"`{item_text_col}`"].alias("text")
        ).where(F.col("text").rlike(_TERM)),
        "queries",
    )
    size = asked.agg(F.sum(F.length("text")).alias("chars")).first()["chars"] or 0
    n_parts = 1 + size // QUERY_CHARS
    blocks = index(docs, id_col, text_col)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_parts))
    found = [_searched(texts, blocks, asked.where(part == number), k) for number in range(n_parts)]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def _searched(docs: DataFrame, blocks: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    rows = sorted(((r["item_id"] is not None, r["item_id"] or 0, r["text"] or "") for r in asked.collect()))
    counted = [Counter(terms(text.encode())) for _, _, text in rows]
    n, total, held = _statistics(docs, frozenset(term for words in counted for term in words))
    weight = {term: math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for term, df in held.items()}
    queries = Queries(
        tuple(item if known else None for known, item, _ in rows),
        tuple({term: times for term, times in words.items() if term in weight} for words in counted),
        weight,
        n,
        max(total, 1),
    )
    first = _scored(docs, _highest(blocks, queries, _FIRST * k), queries, "first")
    ranked = Window.partitionBy("number").orderBy(F.col("score").desc())
    lowest = first.withColumn("place", F.row_number().over(ranked)).where(F.col("place") == k)
    least = [0] * len(rows)
    for row in lowest.select("number", "score").collect():
        least[row["number"]] = row["score"]
    scored = _scored(docs, _not_excluded(blocks, queries, least), queries, "all")
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame(list(enumerate(queries.items)), "number int, item_id long")
    return best.join(F.broadcast(names), "number").select("item_id", "rank", "doc_id", "score")
