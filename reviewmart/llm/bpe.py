"""Byte-pair encoding by a queue of merges, and decoding by concatenation.

A word's symbols form a doubly linked list. A queue holds every adjacent pair that may merge, by
rank and place; popping one merges it and queues the pairs with the new neighbours. An entry whose
symbols have since changed is stale and skipped.

The vocabulary file gives tokens, ranks, special tokens and the rule that splits text into words.
Libraries differ in the Unicode version they know. Where that cannot matter (Latin letters, usual
punctuation) text is put into lower case and split here, everywhere else by the tokenizers library's
own normalizer and rule; merging is done here for all.

Words never reach across white space, so what a chunk of text between white space encodes to is
kept for the next time it is met, unless long, in tables of bounded bytes. Null and empty texts
have no ids; texts of any length are encoded whole, repeated rows each. An empty table stays empty.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from sys import getsizeof

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType
from tokenizers import Tokenizer

# Bytes of chunks kept per worker process, in each of two tables: with their tokens, and packed ids
# only. They hold some 350,000 and 200,000 usual words.
_KEPT_BYTES, _PACKED_BYTES = 120 << 20, 38 << 20
# Longer chunks, as in text without blanks, seldom come again and are not kept.
LONGEST_KEPT = 64
# What a dictionary needs for an entry, about.
_SLOT_BYTES = 100
# Documents whose ids are held at once.
_AT_ONCE = 256
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
# Characters whose case, composition and class are the same in every Unicode version in use.
_SETTLED = re.compile("[\x00-\u02ff\u2010-\u2027\u20ac]*")
# str.split takes these for white space too, the vocabulary's rule does not.
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(byte if byte in shown else next(others)) for byte in range(256)]


class Kept(dict):
    """Values made when first asked for and kept, in two tables of up to ``most_bytes`` each.

    A full table makes room for a new one, which takes over what is met again. What is kept never
    changes a value; keys of more than ``LONGEST_KEPT`` characters are not kept at all.
    """

    def __init__(self, make: Callable[[str], object], most_bytes: int) -> None:
        self.make, self.most_bytes, self.held_bytes = make, most_bytes, 0
        self.before: dict[str, object] = {}

    def __missing__(self, key: str) -> object:
        if len(key) > LONGEST_KEPT:
            return self.make(key)
        found = self.before.get(key)
        if found is None:
            found = self.make(key)
        size = _SLOT_BYTES + getsizeof(key) + getsizeof(found)
        if type(found) is tuple:
            size += sum(map(getsizeof, found))
        if self.held_bytes + size > self.most_bytes:
            self.before = dict(self)
            self.clear()
            self.held_bytes = 0
        self[key] = found
        self.held_bytes += size
        return found


class Encoder:
    """Encodes with the vocabulary file at ``path``: a byte-level BPE with word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.token = {i: token for token, i in (self.vocabulary | self.special).items()}
        ids = self.vocabulary
        self.merges = {
            (ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(model["merges"])
        }
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"])
        self.bytes = byte_characters()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        self.special_parts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.kept = Kept(self._chunk, _KEPT_BYTES)
        self.kept_packed = Kept(self._packed, _PACKED_BYTES)

    def encode_word(self, symbols: list[str]) -> list[int]:
        """Ids of one word, given as the characters that stand for its bytes."""
        symbols = [*symbols[:-1], symbols[-1] + self.suffix]
        ids: list[int] = [self.vocabulary[s] for s in symbols]
        n, merges = len(ids), self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [
            (found[0], i, ids[i], ids[i + 1])
            for i in range(n - 1)
            if (found := merges.get((ids[i], ids[i + 1])))
        ]
        heapq.heapify(queue)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if j < 0 or ids[i] != left or ids[j] != right:
                continue  # stale
            ids[i], ids[j] = merges[left, right][1], -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if found := merges.get((ids[i], ids[k])):
                    heapq.heappush(queue, (found[0], i, ids[i], ids[k]))
            h = before[i]
            if h >= 0 and (found := merges.get((ids[h], ids[i]))):
                heapq.heappush(queue, (found[0], h, ids[h], ids[i]))
        return [i for i in ids if i >= 0]

    def _ids(self, chunk: str) -> list[int]:
        if _SETTLED.fullmatch(chunk):
            lowered = unicodedata.normalize("NFC", chunk).lower()
            words = [[self.bytes[byte] for byte in word.encode()] for word in self.word.findall(lowered)]
        else:
            lowered = self.library.normalizer.normalize_str(chunk)
            words = [list(word) for word, _ in self.library.pre_tokenizer.pre_tokenize_str(lowered)]
        return [i for word in words for i in self.encode_word(word)]

    def _chunk(self, chunk: str) -> tuple[str, str, int]:
        """Ids and tokens of a chunk, each joined by blanks, and their number."""
        if chunk in self.special:
            return str(self.special[chunk]), chunk, 1
        ids = self._ids(chunk)
        return " ".join(map(str, ids)), self.decode(ids), len(ids)

    def _packed(self, chunk: str) -> bytes:
        """Ids of a chunk as 32-bit integers."""
        return array("i", [self.special[chunk]] if chunk in self.special else self._ids(chunk)).tobytes()

    def _chunks(self, text: str) -> list[str]:
        """What stands between white space, special tokens apart."""
        if "<|" in text:
            parts = self.special_parts.split(text)
            if len(parts) > 1:
                return [
                    chunk
                    for part in parts
                    for chunk in ([part] if part in self.special else self._chunks(part))
                ]
        if _ODD_SPACE.search(text):
            return [chunk for chunk in _SPACE.split(text) if chunk]
        return text.split()

    def encode(self, text: str | None) -> tuple[str, str, int]:
        """Ids and tokens of a text, each joined by blanks, and their number."""
        pieces = list(map(self.kept.__getitem__, self._chunks(text or "")))
        return (
            " ".join([piece[0] for piece in pieces]),
            " ".join([piece[1] for piece in pieces]),
            sum([piece[2] for piece in pieces]),
        )

    def pack(self, text: str | None) -> bytes:
        """Ids of a text as 32-bit integers."""
        return b"".join(map(self.kept_packed.__getitem__, self._chunks(text or "")))

    def decode(self, ids: list[int]) -> str:
        """The vocabulary's strings in order, by blanks; the vocabulary names no other joint."""
        return " ".join([self.token[i] for i in ids])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(text: Column, path: str) -> Column:
    """``n_tokens``, and ``ids_sha256`` and ``decoded_sha256`` of the blank-joined ids and tokens."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        encode = encoder(path).encode
        rows = [(n, _sha256(ids), _sha256(tokens)) for ids, tokens, n in map(encode, texts)]
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(text)


def with_ids(docs: DataFrame, text_col: str, path: str) -> DataFrame:
    """``docs`` with its text replaced by ``n_tokens`` and the array ``ids``.

    Columns that have these names already give way to them.
    """
    others = [field for field in docs.schema.fields if field.name not in (text_col, "n_tokens", "ids")]
    schema = StructType([*others]).add("n_tokens", LongType()).add("ids", ArrayType(IntegerType()))
    names = [field.name for field in others]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = encoder(path).pack
        for batch in batches:
            for begin in range(0, batch.num_rows, _AT_ONCE):
                some = batch.slice(begin, _AT_ONCE)
                packed = [pack(text) for text in some.column(len(names)).to_pylist()]
                sizes = np.array([len(ids) // 4 for ids in packed], np.int64)
                ids = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                    pa.array(np.frombuffer(b"".join(packed), np.int32)),
                )
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:-1], pa.array(sizes), ids], names=[*names, "n_tokens", "ids"]
                )

    # The text is the last column, whatever else is called as it is.
    return docs.select(*(docs[f"`{name}`"] for name in names), docs[f"`{text_col}`"]).mapInArrow(work, schema)


def decoded(ids: Column, path: str) -> Column:
    """The text that an array of ids stands for."""

    @F.pandas_udf("string")
    def texts(arrays: pd.Series) -> pd.Series:
        decode = encoder(path).decode
        return arrays.map(lambda a: None if a is None else decode([int(i) for i in a]))

    return texts(ids)
