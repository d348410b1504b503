"""Double arrays, and tries of odd, long and shared conversations."""

import random

import brute
import pytest

from reviewmart.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def _nodes(rows, **options):
    turns, convs = prefix_trie.rebuilt(prefix_trie.ordered(rows))
    return sorted(str(sorted(r.asDict().items())) for r in prefix_trie.trie(turns, convs, **options).collect())


def _plain(rows):
    return sorted(str(sorted(r.items())) for r in brute.prefix_nodes(rows))


def test_double_array():
    draw = random.Random(2)
    rows = sorted({tuple(draw.choices(range(1, 30), k=draw.randint(0, 6))) for _ in range(600)})
    trie = prefix_trie.DoubleArray([list(row) for row in rows])
    prefixes = {row[:n] for row in rows for n in range(1, len(row) + 1)}
    states = {prefix: trie.walk(list(prefix)) for prefix in prefixes}
    assert all(len(states[prefix]) == len(prefix) for prefix in prefixes)
    assert len({walked[-1] for walked in states.values()}) == len(prefixes)
    for _ in range(500):
        other = tuple(draw.choices(range(1, 32), k=4))
        known = max(n for n in range(5) if not n or other[:n] in prefixes)
        assert len(trie.walk(list(other))) == known


@pytest.mark.parametrize("sizes", [{}, {"segment": 4, "block": 16}, {"segment": 1, "block": 1}])
def test_odd_conversations(spark, sizes):
    draw = random.Random(1)
    rows = [
        (draw.choice([None, *range(-45, 90)]), draw.choice([None, 0, 1, 2, 3]), draw.choice([None, "u", "a"]), draw.choice([None, "", "x", "x y"]))
        for _ in range(500)
    ]
    rows += [(7, i, "u", f"w{i % 2}") for i in range(90)] + [(8, i, "u", f"w{i % 2}") for i in range(70)]
    # Copies, and many that differ in their last turn only.
    rows += [(c, i, "u", f"same {i}") for c in range(1000, 1080) for i in range(9)]
    rows += [(c, 9, "u", f"end {c % 50}") for c in range(1040, 1080)]
    table = spark.createDataFrame([(*row, 1, 2) for row in rows], SCHEMA + ", conv int, place int").repartition(5)
    assert _nodes(table, **sizes) == _plain(rows)


def test_turnless_and_very_long(spark):
    long = "word " * 200_000
    # 1 has too few turns for what its number asks of a base that is not there.
    rows = [(21, 0, "u", "only"), (40, 0, "u", long), (40, 1, None, None), (41, 0, "u", long), (41, 1, "u", long)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert _nodes(table) == _plain(rows)


def test_no_conversations(spark):
    assert _nodes(spark.createDataFrame([], SCHEMA)) == []
    assert _nodes(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA)) == []


def test_ids_of_a_large_group_are_listed_in_pieces(spark, monkeypatch):
    rows = [(c, 0, "u", "hello") for c in range(0, 40_000, 20)]
    assert _nodes(spark.createDataFrame(rows, SCHEMA).repartition(7)) == _plain(rows)
