"""Queries against their SQL counterparts, over the smallest tables and over odd rows."""

from collections import Counter

import duckdb
import pytest
from samples import SF, TEXTS

from reviewmart.llm import oracle, queries

STATEMENTS = oracle.oracle_sql()


def _bags(spark, folder, name):
    got = queries.queries()[name](spark, folder)
    db = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark"):
        at = f"{folder}/{table}.parquet"
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{at}{'' if folder == SF else '/*.parquet'}')")
    want = db.execute(STATEMENTS[name])
    columns = sorted(column[0] for column in want.description)
    order = [column[0] for column in want.description]
    rows = [tuple(str(row[order.index(c)]) for c in columns) for row in want.fetchall()]
    assert sorted(got.columns) == columns
    return Counter(tuple(str(row[c]) for c in columns) for row in got.collect()), Counter(rows)


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_smallest_tables(spark, name):
    got, want = _bags(spark, SF, name)
    assert got == want


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_odd_rows(spark, tmp_path, name):
    secret, address = "token = q8Zr51LmX0vT77b", "write Kestrel at ann@mail.example.org today"
    short = [t for t in TEXTS if not t or len(t) < 5000]
    texts = [*short, *[f"{secret} {address} number {i}" for i in range(4)], "loose q8Zr51LmX0vT77bYYwaE33 end"]
    texts += [f"Kestrel {'far away ' * 30} ann@mail.example.org and KESTREL {i}" for i in range(4)]
    texts += [f"Falcon at 10.1.{i}.1 and {'away ' * 30}" for i in range(3)] + [f"far away and at {i}" for i in range(40)]
    rows = [(i, t, f"s{i % 5}" if i % 4 else None, "en" if i % 2 else None) for i, t in enumerate(texts)]
    rows += [(None, "a b c", None, None), (3, "one", "s3", "en"), (3, "one", "s3", "en")]
    schema = "doc_id long, text string, source string, lang string"
    spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    vectors = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, None), (4, [0.0, 0.0]), (5, []), (6, [1.0]), (7, [3.0, 0.2])]
    vectors += [(8, [None, 1.0]), (9, [float("nan"), 1.0]), (10, [1.0, 0.0])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").coalesce(1)
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    turns = [(c, t, r, x) for c in (None, -21, -20, 0, 1, 19, 20, 21) for t in (None, 0, 0, 2) for r, x in ((None, None), ("u", "a b"))]
    turns += [(c, t, "u", f"turn {t}") for c in range(40, 60) for t in range(40)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    table.coalesce(2).write.parquet(f"{tmp_path}/conversations.parquet")
    items = [(1, "Number of ADDRESS at a b c"), (None, None), (2, ""), (3, "one one ümlaut 日本"), (3, "one one ümlaut 日本")]
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    got, want = _bags(spark, str(tmp_path), name)
    assert got == want
    if name == "op1_pii":
        assert sum(r["n_term"] > 0 for r in queries.op1_pii(spark, str(tmp_path)).collect()) >= 7
