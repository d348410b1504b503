"""Token ids in binary files: documents compressed one by one with a shared dictionary.

A file set is a folder with two Parquet tables. ``dictionary`` has one row: a zstandard dictionary
trained on serialized id arrays, and its SHA-256. ``blocks`` has rows of about a megabyte: the
documents' ids and token counts, an offset index into ``payload``, the hash of the dictionary, and
the payload, one compressed frame per document. A document is read by its block's bounds, its
offset and its own frame alone, without touching its neighbours.

Ids are serialized as little-endian unsigned integers of two bytes, or four for vocabularies that
need them. Documents are in ascending id order, null ids first, then by text hash. A null text is
empty and, like any text, ends with the end id. Texts of any length are one frame each. Repeated
rows are stored as often as they occur. An empty table gives a file set without documents.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reviewmart.llm.bpe import Kept, byte_characters
from reviewmart.llm.common import drawn, let
from reviewmart.workspace import cut

# Bytes of chunks kept per worker process, in each of two tables, with and without a blank before.
# They hold some 650,000 usual words.
_KEPT_BYTES = 120 << 20
_BLOCK_BYTES = 1 << 20
_BLOCK_DOCUMENTS = 4096
_LEVEL = 1

BLOCKS = (
    "part int, block int, start long, dictionary string, width int, first_id long, last_id long, "
    "ids array<long>, tokens array<long>, offsets array<long>, payload binary"
)


class _Odd(Exception):
    """A chunk whose ids depend on what stands around it."""


class _Chunks(Kept):
    """Serialized ids of what stands between blanks.

    Most chunks are a word of letters, perhaps with a mark after it. Such a word is one piece for
    the model, and the mark is another; all else goes through the tokenizer as it is.
    """

    def __init__(self, tokenizer: object, lead: str, code: str, special: list[str]) -> None:
        super().__init__(self._serialized, _KEPT_BYTES)
        self.tokenizer, self.lead, self.code, self.special = tokenizer, lead, code, special
        self.model = tokenizer.model.tokenize
        self.lead_name = lead.translate(_BYTE_NAMES)
        self.marks = {mark: self.whole(mark) for mark in ".,;:!?"}

    def whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _serialized(self, chunk: str) -> bytes:
        if _is_word(chunk):
            if chunk.isascii():
                piece = self.lead_name + chunk
            else:
                piece = self.lead_name + chunk.encode().decode("latin1").translate(_BYTE_NAMES)
            return array(self.code, [token.id for token in self.model(piece)]).tobytes()
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Odd
        if chunk[-1] in self.marks and _is_word(chunk[:-1]):
            return self[chunk[:-1]] + self.marks[chunk[-1]]
        if any(special in chunk for special in self.special):
            raise _Odd
        return self.whole(self.lead + chunk)


def _is_word(chunk: str) -> bool:
    """Only letters that have long been letters in every edition of Unicode."""
    return chunk.isalpha() and (chunk.isascii() or max(chunk) < "\u0500")


_BYTE_NAMES = dict(enumerate(byte_characters()))


class Serializer:
    """Texts to serialized ids, by the tokenizers library.

    A single blank or line break between two other characters always begins a new word of this
    vocabulary, so what stands between them is encoded once and kept. Texts where white space
    meets white space, or that hold a special token, are encoded whole.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        code = "H" if self.width == 2 else "I"
        self.after_blank = _Chunks(self.tokenizer, " ", code, special)
        self.bare = _Chunks(self.tokenizer, "", code, special)
        self.line_break = self.bare.whole("\n")

    def serialize(self, text: str) -> bytes:
        if not text:
            return b""
        after_blank, bare, parts = self.after_blank.__getitem__, self.bare.__getitem__, []
        try:
            for line in text.split("\n"):
                chunks = line.split(" ")
                parts.append(bare(chunks[0]) + b"".join(map(after_blank, chunks[1:])))
            return self.line_break.join(parts)
        except _Odd:
            return self.bare.whole(text)


@lru_cache(maxsize=2)
def serializer(path: str) -> Serializer:
    return Serializer(path)


@lru_cache(maxsize=2)
def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def train_dictionary(
    docs: DataFrame, vocabulary: str, samples: int, size: int, piece: int = 16384
) -> bytes:
    """A dictionary of up to ``size`` bytes from about ``samples`` pieces of texts of any length.

    Texts are cut into pieces of up to ``piece`` characters, so that a long one is drawn from as often
    as short ones of the same length together; pieces are drawn by a hash of their text and place,
    twice as many as wanted at most, and a text's copies count as one. Where there is too little to
    train on, the serialized ids themselves serve; with no texts at all there is no dictionary.
    """
    # Bytes are known without reading a text through; pieces beyond the last character are empty.
    pieces = F.ceil(F.octet_length("text") / piece)
    places = F.sequence(F.lit(0).cast("long"), pieces - 1)
    # One pass draws about as much as ``samples`` whole documents hold, and counts all pieces; a
    # text is hashed once, and which of its pieces are drawn is known before any is cut out.
    generous = samples / max(docs.count(), 1)
    mine = let(
        F.xxhash64("text"),
        lambda text: F.filter(
            F.transform(
                F.when(pieces > 0, places), lambda place: F.struct(place.alias("place"), F.xxhash64(text, place).alias("hash"))
            ),
            lambda one: drawn(one["hash"], generous),
        ),
    )
    part, seen = F.substring(F.col("text"), F.col("one.place") * piece + 1, F.lit(piece)), Observation()
    first = cut(
        docs.observe(seen, F.sum(pieces).alias("pieces"))
        .select("text", F.explode(mine).alias("one"))
        .select("one.hash", part.alias("part"))
        .where("part <> ''")
        .groupBy("hash")
        .agg(F.first("part").alias("part")),
        "dictionary-pieces",
    )
    rows = first.where(drawn(F.col("hash"), samples / max(seen.get["pieces"] or 0, 1)))
    encode = serializer(vocabulary).serialize
    arrays = [encode(row["part"]) for row in rows.orderBy("hash").limit(2 * samples).collect()]
    try:
        return zstandard.train_dictionary(size, arrays).as_bytes()
    except zstandard.ZstdError:
        return b"".join(arrays)[:size]


def _write_blocks(
    batches: Iterator[pa.RecordBatch], vocabulary: str, end: int, data: bytes
) -> Iterator[pa.RecordBatch]:
    tokens_of = serializer(vocabulary)
    dictionary = _dictionary(data)
    compress = zstandard.ZstdCompressor(level=_LEVEL, dict_data=dictionary).compress
    width, tail = tokens_of.width, np.array([end], f"<u{tokens_of.width}").tobytes()
    name, part = hashlib.sha256(data).hexdigest(), TaskContext.get().partitionId()
    block = start = size = 0
    ids: list[int | None] = []
    tokens: list[int] = []
    frames: list[bytes] = []

    def full() -> pa.RecordBatch:
        known = [i for i in ids if i is not None]
        row = {
            "part": part,
            "block": block,
            "start": start,
            "dictionary": name,
            "width": width,
            "first_id": min(known, default=None),
            "last_id": max(known, default=None),
            "ids": ids,
            "tokens": tokens,
            "offsets": np.cumsum([0, *map(len, frames)]).tolist(),
            "payload": b"".join(frames),
        }
        return pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)

    for batch in batches:
        for begin in range(0, batch.num_rows, 128):
            some = batch.slice(begin, 128)
            for doc_id, text in zip(*(c.to_pylist() for c in some.columns), strict=True):
                serialized = tokens_of.serialize(text or "") + tail
                frame = compress(serialized)
                if ids and (size + len(frame) > _BLOCK_BYTES or len(ids) >= _BLOCK_DOCUMENTS):
                    yield full()
                    block, start, size = block + 1, start + sum(tokens), 0
                    ids, tokens, frames = [], [], []
                ids.append(doc_id)
                tokens.append(len(serialized) // width)
                frames.append(frame)
                size += len(frame)
    if ids:
        yield full()


_BLOCK_SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("start", pa.int64()),
        ("dictionary", pa.string()),
        ("width", pa.int32()),
        ("first_id", pa.int64()),
        ("last_id", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("tokens", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end: int,
    text_col: str = "text",
    id_col: str = "doc_id",
    samples: int = 600,
    dictionary_bytes: int = 65536,
) -> None:
    """Encode all texts and write a file set to ``path``. Texts are shuffled once, by id range."""
    spark = docs.sparkSession
    rows = docs.select(
        docs[f"`{id_col}`"].cast("long").alias("id"), docs[f"`{text_col}`"].alias("text")
    )
    data = train_dictionary(rows, vocabulary, samples, dictionary_bytes)
    spark.createDataFrame(
        [(hashlib.sha256(data).hexdigest(), bytearray(data))], "hash string, data binary"
    ).coalesce(1).write.parquet(f"{path}/dictionary")
    order = (F.col("id"), F.xxhash64("text"))
    work = partial(_write_blocks, vocabulary=vocabulary, end=end, data=data)
    blocks = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(work, BLOCKS)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")


def _load_dictionary(spark: SparkSession, path: str) -> bytes:
    row = spark.read.parquet(f"{path}/dictionary").first()
    data = bytes(row["data"])
    if hashlib.sha256(data).hexdigest() != row["hash"]:
        raise ValueError(f"the dictionary of {path} is damaged")
    return data


def _frames(batch: pa.RecordBatch, data: bytes) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """Document id, place in the part and ids of each document of some blocks."""
    name = hashlib.sha256(data).hexdigest()
    decompress = zstandard.ZstdDecompressor(dict_data=_dictionary(data)).decompress
    for row in batch.to_pylist():
        if row["dictionary"] != name:
            raise ValueError("a block was written with another dictionary")
        start, payload, offsets = row["start"], memoryview(row["payload"]), row["offsets"]
        for i, doc_id in enumerate(row["ids"]):
            ids = np.frombuffer(
                decompress(payload[offsets[i] : offsets[i + 1]]), f"<u{row['width']}"
            )
            yield doc_id, start, ids.astype("<u4")
            start += len(ids)


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, if wanted, ``ids`` per document.

    ``start`` counts the ids of all documents before. Only the totals of the parts, one for each
    task that wrote, come to the driver.
    """
    data = _load_dictionary(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    size = F.aggregate("tokens", F.lit(0).cast("long"), lambda total, n: total + n)
    totals = blocks.groupBy("part").agg(F.max(F.col("start") + size).alias("total")).collect()
    begins, total = {}, 0
    for row in sorted(totals):
        begins[row["part"]], total = total, total + row["total"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("part").to_pylist()
            for begin in range(batch.num_rows):
                rows = list(_frames(batch.slice(begin, 1), data))
                out = {
                    "doc_id": pa.array([doc_id for doc_id, _, _ in rows], pa.int64()),
                    "start": [begins[parts[begin]] + start for _, start, _ in rows],
                    "n_tokens": [len(ids) for _, _, ids in rows],
                    "ids_crc32": [zlib.crc32(ids) for _, _, ids in rows],
                }
                if with_ids:
                    out["ids"] = pa.array([ids for _, _, ids in rows], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(out)

    return blocks.mapInArrow(work, schema + (", ids array<int>" if with_ids else ""))


def fetch(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents with one id, from their own frames only."""
    data = _load_dictionary(spark, path)
    decompress = zstandard.ZstdDecompressor(dict_data=_dictionary(data)).decompress
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    frame = F.explode(
        F.filter(
            F.transform(
                "ids",
                lambda i, at: F.when(
                    i == doc_id,
                    F.substring(
                        F.col("payload"),
                        (F.get("offsets", at) + 1).cast("int"),
                        (F.get("offsets", at + 1) - F.get("offsets", at)).cast("int"),
                    ),
                ),
            ),
            lambda f: f.isNotNull(),
        )
    )
    rows = (
        blocks.where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
        .select("width", frame.alias("frame"))
        .collect()
    )
    return [np.frombuffer(decompress(bytes(r["frame"])), f"<u{r['width']}").tolist() for r in rows]
