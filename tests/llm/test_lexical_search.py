"""Bounds, and rankings over odd rows, copies and ties."""

import random
from collections import Counter

import brute
import numpy as np
import pytest

from reviewmart.llm import lexical_search as search

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def _got(docs, items, **options):
    return sorted(map(str, (tuple(r) for r in search.search(docs, items, **options).select("item_id", "rank", "doc_id", "score").collect())))


def _plain(docs, items, k=10):
    return sorted(map(str, brute.best_documents(docs, items, k)))


def _queries(texts, asked):
    counted = [Counter(search.terms(t.encode())) for t in texts]
    df = Counter(t for c in counted for t in c)
    words = tuple({t: n for t, n in Counter(search.terms(q.encode())).items() if t in df} for q in asked)
    weight = {t: 10_000 // df[t] for q in words for t in q}
    return search.Queries(tuple(range(len(asked))), words, weight, len(texts), sum(c.total() for c in counted))


def test_bounds_are_never_below_the_score():
    draw = random.Random(4)
    texts = [" ".join(f"w{min(int(draw.expovariate(0.2)), 60)}" for _ in range(draw.choice([1, 5, 40, 900]))) for _ in range(60)]
    queries = _queries(texts, [" ".join(f"w{draw.randint(0, 70)}" for _ in range(12)) for _ in range(20)])
    counts = [Counter(search.terms(t.encode())) for t in texts]
    rows = [(i, 0, c.total(), search._entries(search._Digests(), c)) for i, c in enumerate(counts)]
    close = 0
    for width in (64, 1 << 14):
        for number, bound in search._Bounds(queries).of(search._block(width, rows)):
            exact = np.array([queries.score(number, c, c.total()) for c in counts])
            assert (bound >= exact).all()
            close += (bound <= 1.05 * exact + 1).sum() if width > 64 else 0
    assert close > 0.9 * 20 * 60


def test_odd_rows(spark, odd):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    items = [(1, "ONE one word7 umlaut ümlaut 日本"), (2, None), (3, "... !"), (None, "a b c zeile"), (4, "one"), (4, "one"), (5, "nowhere")]
    table = spark.createDataFrame([(*item, 1, 2) for item in items], ITEMS + ", number int, rank int")
    assert _got(odd, table) == _plain(rows, items)


@pytest.mark.parametrize("k", [1, 10])
def test_copies_and_ties(spark, k):
    draw = random.Random(5)
    rows = [(i, "the same words again") for i in range(400)] + [(7, "the same words again")] * 5
    rows += [(1000 + i, " ".join(draw.choices("the same words or other ones here".split(), k=draw.randint(1, 12)))) for i in range(800)]
    items = [(1, "the same words"), (2, "other other ones"), (3, "here")]
    docs = spark.createDataFrame(rows, DOCS).repartition(6)
    assert _got(docs, spark.createDataFrame(items, ITEMS), k=k) == _plain(rows, items, k)


def test_parts_of_queries_find_the_same(spark, monkeypatch):
    rows = [(i, f"w{i % 7} w{i % 11} w{i % 13}") for i in range(300)]
    items = [(i, f"w{i} w{i + 1}") for i in range(12)]
    docs, asked = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)
    monkeypatch.setattr(search, "QUERY_CHARS", 20)
    assert _got(docs, asked) == _plain(rows, items)


def test_shuffled_candidates_find_the_same(spark, monkeypatch):
    rows = [(i, f"w{i % 7} w{i % 11} w{i % 13}") for i in range(300)]
    items = [(i, f"w{i} w{i + 1}") for i in range(12)]
    monkeypatch.setattr(search, "measured_bytes", lambda _: 1 << 40)
    assert _got(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)) == _plain(rows, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], DOCS), spark.createDataFrame([(1, "a")], ITEMS)
    assert _got(docs.limit(0), items) == _got(docs, items.limit(0)) == _got(docs.limit(0), items.limit(0)) == []
