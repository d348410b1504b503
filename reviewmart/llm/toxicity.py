"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

Features are words and the beginnings of words that are commoner in toxic texts, found by their
document counts among labelled texts; a text without any is as mild as can be. The model has one weight per feature, shared by all grades, and an ordered
threshold below each grade: P(grade > k) = sigmoid(w x - t_k). Labels say only whether a text is
toxic; a toxic text's grade, 1 to 3, follows from how much of it is made of words that occur in
toxic texts alone, by thirds of the labelled toxic texts.

Labelled rows are a sample of bounded size, drawn from each class by a hash of the text. A text counts
once in training, however many rows have it, and is toxic if at least half of all its labels say so.
Without both classes, as from an empty table, the model knows no feature and calls nothing toxic.
Null and empty texts have no words; texts of any length are graded whole; repeated rows get equal
grades, and of equally likely grades the lower one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmart.llm.common import drawn, text_of
from reviewmart.operators.joins import USUAL, measured_bytes
from reviewmart.workspace import cut

_WORD = re.compile(r"[^\W\d_]+")
_BEGINNINGS = (4, 5)
GRADES = 3


def features_of(text: str | None) -> tuple[Counter, int]:
    """How often each word, and each beginning of longer words, occurs; and the words in all."""
    counts: Counter = Counter()
    words = Counter(_WORD.findall((text or "").lower()))
    for word, n in words.items():
        counts[word] += n
        for length in _BEGINNINGS:
            if len(word) > length:
                counts["^" + word[:length]] += n
    return counts, sum(words.values())


def _value(count: int, words: int) -> float:
    """Weight of a feature in a text: the logarithm of its share in tenths of a percent."""
    return math.log1p(1000 * count / words)


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def above(self, text: str | None) -> list[float]:
        """P(grade > k) for k from 0."""
        words = Counter(_WORD.findall((text or "").lower()))
        known, weights = Counter(), self.weights
        for word, n in words.items():
            if word in weights:
                known[word] += n
            for length in _BEGINNINGS:
                if len(word) > length and (begin := "^" + word[:length]) in weights:
                    known[begin] += n
        total = sum(words.values())
        score = math.fsum(weights[f] * _value(n, total) for f, n in known.items())
        return [1 / (1 + math.exp(min(500.0, t - score))) for t in self.thresholds]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, text_col: str, key: str, label: str, most: int
) -> DataFrame:
    """``text`` and ``toxic`` of about ``most`` labelled texts of either class, drawn by hash."""
    votes = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("label_of"))
        .agg(F.sum(F.col(label).cast("double")).alias("toxic_votes"), F.count("*").alias("votes"))
    )
    texts = docs.select(docs[f"`{key}`"].alias("key"), text_of(docs, text_col).alias("text"))
    # The labels of all rows with a text, by the text's hash alone.
    judged = cut(
        texts.select("key", F.xxhash64("text").alias("hash"))
        .join(votes, F.col("key") == F.col("label_of"))
        .groupBy("hash")
        .agg((F.sum("toxic_votes") >= 0.5 * F.sum("votes")).alias("toxic")),
        "toxicity-texts",
    )
    n = {row["toxic"]: row["count"] for row in judged.groupBy("toxic").count().collect()}
    share = {toxic: most / n.get(toxic, most) for toxic in (False, True)}
    chosen = cut(
        judged.where(
            drawn(F.col("hash"), share[True]) & F.col("toxic")
            | drawn(F.col("hash"), share[False]) & ~F.col("toxic")
        ),
        "toxicity-labels",
    )
    # Bounded in expectation by the parameter, and measured all the same.
    if measured_bytes(chosen) <= USUAL.broadcast_bytes:
        chosen = F.broadcast(chosen)
    met = texts.select("text", F.xxhash64("text").alias("hash")).join(chosen, "hash")
    return cut(met.groupBy("text").agg(F.first("toxic").alias("toxic")), "toxicity-sample")


def _counted(sample: DataFrame) -> DataFrame:
    """``feature``, ``toxic`` and ``texts``, summed per task first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {False: Counter(), True: Counter()}
        for batch in batches:
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums[toxic].update(features_of(text)[0].keys())
        for toxic, counts in sums.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": pa.array(list(counts), pa.string()),
                    "toxic": pa.array([toxic] * len(counts), pa.bool_()),
                    "texts": pa.array(list(counts.values()), pa.int64()),
                }
            )

    return (
        sample.select("text", "toxic")
        .mapInArrow(work, "feature string, toxic boolean, texts long")
        .groupBy("feature")
        .agg(
            F.coalesce(F.sum(F.when(F.col("toxic"), F.col("texts"))), F.lit(0)).alias("toxic_texts"),
            F.coalesce(F.sum(F.when(~F.col("toxic"), F.col("texts"))), F.lit(0)).alias("clean_texts"),
        )
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text_col: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    most: int = 6000,
    most_features: int = 3000,
    least_texts: int = 4,
    rounds: int = 400,
) -> Model:
    """Learn from about ``most`` labelled texts a class and the ``most_features`` telling features."""
    sample = labelled_sample(docs, labels, text_col, key, label, most)
    sizes = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic or not n_clean:
        return Model({}, (50.0,) * GRADES)
    t, c = F.col("toxic_texts") + 0.5, F.col("clean_texts") + 0.5
    odds = F.log(t / (n_toxic + 1 - t)) - F.log(c / (n_clean + 1 - c))
    spread = F.sqrt(1 / t + 1 / (n_toxic + 1 - t) + 1 / c + 1 / (n_clean + 1 - c))
    chosen = (
        _counted(sample)
        .where(F.col("toxic_texts") + F.col("clean_texts") >= least_texts)
        .withColumn("score", odds / spread)
        .where(F.col("score") > 2)
        .orderBy(F.col("score").desc(), "feature")
        .limit(most_features)
        .collect()
    )
    number = {row["feature"]: i for i, row in enumerate(chosen)}
    marks = {
        row["feature"]
        for row in chosen
        if row["toxic_texts"] / n_toxic > 20 * row["clean_texts"] / n_clean
    }

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts, words = features_of(text)
                mine = sorted(counts.keys() & number.keys())
                marked = sum(n for f, n in counts.items() if f in marks)
                rows.append(
                    {
                        "toxic": toxic,
                        "marked": marked / words if words else 0.0,
                        "places": [number[f] for f in mine],
                        "values": [_value(counts[f], words) for f in mine],
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_SPARSE)

    rows = (
        sample.select("text", "toxic")
        .mapInArrow(sparse, "toxic boolean, marked double, places array<int>, values array<double>")
        .toArrow()
        .to_pylist()
    )
    rows.sort(key=lambda r: (r["toxic"], r["marked"], r["places"], r["values"]))
    return _fitted(rows, list(number), rounds)


_SPARSE = pa.schema(
    [
        ("toxic", pa.bool_()),
        ("marked", pa.float64()),
        ("places", pa.list_(pa.int32())),
        ("values", pa.list_(pa.float64())),
    ]
)


def _fitted(rows: list[dict], names: list[str], rounds: int, ridge: float = 1e-4) -> Model:
    """Maximum likelihood with a ridge, by full gradient steps with adaptive rates.

    Thresholds are a first one and positive steps, so they stay in order.
    """
    toxic = np.array([r["toxic"] for r in rows])
    marked = np.array([r["marked"] for r in rows])
    grade = np.zeros(len(rows), int)
    bounds = np.quantile(marked[toxic], [i / GRADES for i in range(1, GRADES)])
    grade[toxic] = 1 + np.searchsorted(bounds, marked[toxic], "right")
    row = np.repeat(np.arange(len(rows)), [len(r["places"]) for r in rows])
    place = np.concatenate([np.array(r["places"], int) for r in rows])
    value = np.concatenate([np.array(r["values"], float) for r in rows])
    above = grade[:, None] > np.arange(GRADES)  # what each threshold has to tell
    share = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())

    state = np.concatenate([np.zeros(len(names)), [0.0], np.zeros(GRADES - 1)])
    mean, square = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, rounds + 1):
        weights, first, steps = np.split(state, [len(names), len(names) + 1])
        thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
        score = np.bincount(row, weights[place] * value, len(rows))
        # Of adjacent cumulative probabilities, the difference is the grade's own.
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds, -500, 500)))
        edges = np.hstack([np.ones((len(rows), 1)), p, np.zeros((len(rows), 1))])
        own = np.maximum(edges[np.arange(len(rows)), grade] - edges[np.arange(len(rows)), grade + 1], 1e-12)
        slope = p * (1 - p)
        # d(own)/d(z_k): plus for the lower bound of the grade, minus for the upper.
        lower = np.zeros_like(p)
        lower[grade > 0, grade[grade > 0] - 1] = 1
        upper = np.zeros_like(p)
        upper[grade < GRADES, grade[grade < GRADES]] = 1
        pull = share[:, None] * slope * (lower - upper) / own[:, None]
        by_weight = np.bincount(place, pull.sum(1)[row] * value, len(names)) - ridge * weights
        by_threshold = -pull.sum(0)
        tail = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.concatenate([by_weight, tail[:1], tail[1:] * np.exp(steps)])
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        rate = 0.1 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
        state = state + rate * mean / (np.sqrt(square) + 1e-9)
    weights, first, steps = np.split(state, [len(names), len(names) + 1])
    thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
    kept = {name: float(w) for name, w in zip(names, weights, strict=True) if abs(w) > 1e-4}
    return Model(kept, tuple(map(float, thresholds)))


def graded(text: Column, model: Model) -> Column:
    """``expected_severity`` (0 to 3), ``grade`` (most likely) and ``toxic`` (grade 1 or more is
    likelier than not)."""

    @F.pandas_udf("expected_severity double, grade int, toxic boolean")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            above = model.above(text)
            own = [a - b for a, b in zip([1.0, *above], [*above, 0.0], strict=True)]
            rows.append((sum(above), own.index(max(own)), above[0] >= 0.5))
        return pd.DataFrame(rows, columns=["expected_severity", "grade", "toxic"])

    return of(text)
