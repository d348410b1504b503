"""Language identification with string kernels, Nyström landmarks and kernel ridge regression.

The kernel of two texts is the number of character n-grams that occur in both, over all n up to
``LONGEST`` (a blended spectrum of presences, not counts), divided by the geometric mean of their
own numbers. N-grams run over the lower-cased letters, with one blank between words and at both
ends, and are told apart by a hash of ``_BUCKET_BITS`` bits. Landmarks, drawn evenly from the
languages, span the feature space: a text is the row of its kernels with them, made whole batches at
a time as a product of presence matrices. One ridge regression per language against the rest, each
language weighing alike, scores that row; the highest wins.

Learning rows are a sample of bounded size, drawn by a hash of the text, so that neither copies of a
text nor the partitioning change it; a text with several languages has its most frequent one, of
equally frequent ones the first. Rows without a text, a letter or a language teach nothing. A null
text, or one without a letter, is ``und`` with score 0, and so is every text if nothing could be
learned (as from an empty table). Texts of any length are taken whole, in pieces. Repeated rows get
the same answer each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmart.operators.joins import USUAL, measured_bytes
from reviewmart.workspace import cut

UNKNOWN = "und"
LONGEST = 3
_BUCKET_BITS = 18
_WORD = re.compile(r"[^\W\d_]+")
# Characters hashed at once, and texts scored at once.
_PIECE, _BATCH = 1 << 20, 64


def grams(text: str | None) -> np.ndarray:
    """The buckets of the n-grams that occur in a text, ascending; none without a letter."""
    letters = _WORD.findall((text or "").lower())
    if not any(map(str.isalpha, "".join(letters))):
        return np.empty(0, np.uint32)
    joined = f" {' '.join(letters)} "
    found = np.empty(0, np.uint32)
    for begin in range(0, len(joined), _PIECE):
        # Pieces overlap by what an n-gram needs beyond its first character.
        piece = joined[begin : begin + _PIECE + LONGEST - 1]
        code = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        mixed, every = np.zeros(len(code), np.uint32), []
        for n in range(1, LONGEST + 1):
            if len(code) < n:
                break
            mixed = mixed[: len(code) - n + 1] * np.uint32(0x01000193) + code[n - 1 :] + np.uint32(n)
            hashed = mixed ^ (mixed >> np.uint32(15))
            every.append((hashed * np.uint32(0x9E3779B1)) >> np.uint32(32 - _BUCKET_BITS))
        found = np.unique(np.concatenate([found, *every]))
    return found


@dataclass(frozen=True)
class Landmarks:
    """Texts that others are compared with, as their n-grams' buckets."""

    texts: tuple[np.ndarray, ...]

    @cached_property
    def _vocabulary(self) -> np.ndarray:
        return np.unique(np.concatenate(self.texts))

    @cached_property
    def _presence(self) -> np.ndarray:
        """Vocabulary by landmarks: whether the n-gram occurs."""
        at = np.zeros((len(self._vocabulary), len(self.texts)), np.float32)
        for i, text in enumerate(self.texts):
            at[np.searchsorted(self._vocabulary, text), i] = 1
        return at

    @cached_property
    def _place(self) -> np.ndarray:
        """Each bucket's place in the vocabulary, or -1."""
        place = np.full(1 << _BUCKET_BITS, -1, np.int32)
        place[self._vocabulary] = np.arange(len(self._vocabulary))
        return place

    def kernels(self, rows: list[np.ndarray]) -> np.ndarray:
        """Kernels of texts, given by their n-grams, with all landmarks."""
        own = np.sqrt([max(len(text), 1) for text in self.texts])
        out = np.zeros((len(rows), len(self.texts)))
        for begin in range(0, len(rows), _BATCH):
            some = rows[begin : begin + _BATCH]
            present = np.zeros((len(some), len(self._vocabulary)), np.float32)
            for i, row in enumerate(some):
                places = self._place[row]
                present[i, places[places >= 0]] = 1
            # Sums of ones: exact in single precision, in whatever order they are added.
            shared = (present @ self._presence).astype(np.float64)
            sizes = np.sqrt([max(len(row), 1) for row in some])
            out[begin : begin + len(some)] = shared / sizes[:, None] / own
        return out

    def __getstate__(self) -> dict:
        return {"texts": self.texts}


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    landmarks: Landmarks | None = None
    weights: np.ndarray | None = None  # landmarks (and a constant) by languages

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language of each text, and its score from 0 to 1."""
        rows = [grams(text) for text in texts]
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(rows)
        kernels = self.landmarks.kernels(rows)
        scores = np.clip((1 + kernels @ self.weights[:-1] + self.weights[-1]) / 2, 0, 1)
        best = scores.round(9).argmax(1)
        return [
            (self.languages[b], round(float(score[b]), 6)) if len(row) else (UNKNOWN, 0.0)
            for row, b, score in zip(rows, best, scores, strict=True)
        ]


def sample(docs: DataFrame, text_col: str, lang_col: str, learn: Column | None, most: int) -> DataFrame:
    """``text`` and ``lang`` of about ``most`` different texts, as many of each language."""
    text, lang = docs[f"`{text_col}`"], docs[f"`{lang_col}`"]
    usable = text.isNotNull() & lang.isNotNull()
    if learn is not None:
        usable &= F.coalesce(learn, F.lit(False))
    rows = docs.where(usable).select(text.alias("text"), lang.cast("string").alias("lang"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("texts"))
    each = most / F.count("lang").over(Window.partitionBy())
    shares = cut(sizes.select("lang", (each / F.greatest("texts", F.lit(1))).alias("share")), "language-shares")
    # A row per language, whatever counts as one; which rows are drawn depends on the text and this
    # share alone.
    if measured_bytes(shares) <= USUAL.broadcast_bytes:
        shares = F.broadcast(shares)
    hashed = F.pmod(F.xxhash64("text", F.lit("language")), F.lit(1 << 30))
    chosen = rows.join(shares, "lang").where(hashed < F.col("share") * (1 << 30))
    counted = chosen.groupBy("text", "lang").agg(F.count("*").alias("rows"))
    first = F.min(F.struct((-F.col("rows")).alias("rows"), "lang"))
    return cut(counted.groupBy("text").agg(first.alias("first")).select("text", "first.lang"), "language-sample")


def fit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    learn: Column | None = None,
    most: int = 4000,
    landmarks: int = 128,
    ridge: float = 1e-4,
) -> Model:
    """Learn from the rows where ``learn`` holds (all if not given).

    About ``most`` texts and ``landmarks`` of them, at least two per language, are used: that, and
    the numbers of their n-grams, bounds what comes to the driver.
    """
    drawn_rows = sample(docs, text_col, lang_col, learn, most)
    ordered = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"lang": lang, "grams": found.astype(np.int32).tolist()}
                for text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                if len(found := grams(text))
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=_SPELT)

    languages = sorted(r["lang"] for r in drawn_rows.select("lang").distinct().collect())
    if not languages:
        return Model(())
    each = max(2, landmarks // len(languages))
    # The sample is bounded, so a language's part of it may be ordered in one task.
    first = drawn_rows.withColumn("place", F.row_number().over(ordered)).where(F.col("place") <= each)
    spelt_rows = first.select("text", "lang").mapInArrow(spelt, "lang string, grams array<int>").collect()
    texts = sorted((r["lang"], r["grams"]) for r in spelt_rows)
    if not texts:
        return Model(())
    chosen = Landmarks(tuple(np.array(found, np.uint32) for _, found in texts))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [(lang, found) for text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True) if len(found := grams(text))]
            kernels = chosen.kernels([found for _, found in some]).astype(np.float32)
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang for lang, _ in some], "kernels": [row.tobytes() for row in kernels]},
                schema=_COMPARED,
            )

    rows = sorted(
        (r["lang"], bytes(r["kernels"]))
        for r in drawn_rows.select("text", "lang").mapInArrow(compared, "lang string, kernels binary").collect()
    )
    known = tuple(sorted({lang for lang, _ in rows}))
    kernels = np.frombuffer(b"".join(row for _, row in rows), np.float32).reshape(len(rows), -1)
    label = np.array([known.index(lang) for lang, _ in rows])
    return Model(known, chosen, _weights(kernels.astype(np.float64), label, chosen, len(known), ridge))


_SPELT = pa.schema([("lang", pa.string()), ("grams", pa.list_(pa.int32()))])
_COMPARED = pa.schema([("lang", pa.string()), ("kernels", pa.binary())])


def _weights(kernels: np.ndarray, label: np.ndarray, chosen: Landmarks, n: int, ridge: float) -> np.ndarray:
    """Ridge regression of plus and minus one in the landmarks' feature space, for each language."""
    values, axes = np.linalg.eigh(chosen.kernels(list(chosen.texts)))
    useful = values > 1e-8 * values[-1]
    whiten = axes[:, useful] / np.sqrt(values[useful])
    rows = np.hstack([kernels @ whiten, np.ones((len(kernels), 1))])
    weight = 1.0 / (n * np.bincount(label, minlength=n)[label])
    target = np.where(label[:, None] == np.arange(n), 1.0, -1.0)
    gram = rows.T @ (rows * weight[:, None])
    gram[np.diag_indices(gram.shape[0] - 1)] += ridge
    solved = np.linalg.solve(gram, rows.T @ (target * weight[:, None]))
    return np.vstack([whiten @ solved[:-1], solved[-1:]])


def predicted(text: Column, model: Model) -> Column:
    """``lang_pred`` and ``score`` of a text."""

    @F.pandas_udf("lang_pred string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(model.predict(list(texts)), columns=["lang_pred", "score"])

    return of(text)


def held_out(key: Column) -> Column:
    """Whether a document's language is for testing only: a third of all, by the key's checksum."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
