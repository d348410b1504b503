"""Tables that readers can rely on: refreshed at once, and in buckets."""

import os
import random
from uuid import uuid4

import pytest
from pyarrow import parquet
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reviewmart.operators.joins import bucketed_x_users, fct_x_users
from reviewmart.plans import marts
from reviewmart.sources.writers import bucketed_table, cluster_layout, load_fact, refresh_table, z_order_layout

ROWS = [(f"u{i % 7}" if i % 5 else None, f"p{i % 3}", f"2020-0{1 + i % 9}-01 00:00:00", 3.0, i % 2 == 0) for i in range(60)]


@pytest.fixture
def name(spark):
    name = f"table_{uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _versions(root):
    return sorted(os.listdir(root))


def test_refresh(spark, name, tmp_path):
    root = str(tmp_path)
    assert refresh_table(spark.range(3), name, root).count() == 3
    reader = spark.table(name)
    first = reader.collect()
    assert refresh_table(spark.range(5), name, root).count() == 5
    # A query made before still finds its files.
    assert reader.collect() in (first, spark.range(5).collect())
    assert refresh_table(spark.range(7), name, root).count() == 7
    assert len(_versions(root)) == 2


def test_a_failed_refresh_changes_nothing(spark, name, tmp_path):
    root = str(tmp_path)
    refresh_table(spark.range(3), name, root)
    broken = spark.range(9).select(F.when(F.col("id") > 4, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException):
        refresh_table(broken, name, root)
    assert spark.table(name).count() == 3
    refresh_table(spark.range(4), name, root)
    assert spark.table(name).count() == 4
    assert len(_versions(root)) == 2


def test_another_schema(spark, name, tmp_path):
    refresh_table(spark.range(3), name, str(tmp_path))
    wider = spark.range(2).withColumn("more", F.lit("x"))
    assert refresh_table(wider, name, str(tmp_path)).columns == ["id", "more"]
    assert sorted(spark.table(name).collect()) == sorted(wider.collect())


def _files_read(path, column, value):
    """Files of which the statistics do not rule out the value."""
    found = 0
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                meta = parquet.ParquetFile(f"{folder}/{name}").metadata
                place = meta.schema.names.index(column)
                stats = [meta.row_group(i).column(place).statistics for i in range(meta.num_row_groups)]
                found += any(s.min <= value <= s.max for s in stats if s is not None and s.has_min_max)
    return found


def test_files_read_for_a_user_and_for_a_product(spark, reviews, tmp_path):
    draw = random.Random(6)
    rows = [(f"u{draw.randint(0, 400):03}", f"p{draw.randint(0, 400):03}", "2020-01-01 00:00:00") for _ in range(6000)]
    # A third of all rows are one user's.
    rows += [("u123", f"p{draw.randint(0, 400):03}", "2020-01-01 00:00:00") for _ in range(3000)] + [(None, "p1", "2020-01-02 00:00:00")]
    all_ = reviews(*rows).withColumn("review_month", F.date_trunc("month", "timestamp"))
    load_fact(all_, str(tmp_path / "z"), 16, z_order_layout)
    load_fact(all_, str(tmp_path / "c"), 16, cluster_layout)
    files = _files_read(str(tmp_path / "z"), "asin", "p200") + 0
    total = sum(name.endswith(".parquet") for _, _, names in os.walk(tmp_path / "z") for name in names)
    assert total >= 12
    for column, values in (("user_id", ("u050", "u200", "u350")), ("asin", ("p050", "p200", "p350"))):
        assert all(_files_read(str(tmp_path / "z"), column, value) <= total * 0.6 for value in values), column
    assert _files_read(str(tmp_path / "c"), "asin", "p200") > files
    both = [sorted(map(str, spark.read.parquet(str(tmp_path / name)).select(*all_.columns).collect())) for name in "zc"]
    assert both[0] == both[1] == sorted(map(str, all_.collect()))


def test_layout_of_few_values(spark, reviews, tmp_path):
    for rows in ([("u", "p", "2020-01-01 00:00:00")] * 5, [(None, None, "2020-01-01 00:00:00")]):
        all_ = reviews(*rows).withColumn("review_month", F.date_trunc("month", "timestamp"))
        assert z_order_layout(all_).count() == len(rows)


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


def test_buckets_join_where_they_lie(spark, reviews, items, tmp_path, conf):
    all_ = reviews(*ROWS)
    users = marts.dim_users(all_, items(("p1", 2.0)))
    bucketed = bucketed_table(all_, f"r_{uuid4().hex}", str(tmp_path / "r"), buckets=4)
    known = bucketed_table(users, f"u_{uuid4().hex}", str(tmp_path / "u"), buckets=4)
    joined = bucketed_x_users(bucketed, known)
    moved, plan = _exchanges(joined)
    assert moved == 0 and "SortMergeJoin" in plan
    key = lambda row: str(sorted(row.asDict().items()))
    assert sorted(map(key, joined.collect())) == sorted(map(key, fct_x_users(all_, users).collect()))


def test_users_of_buckets_move_no_review(spark, reviews, items, tmp_path):
    all_, catalog = reviews(*ROWS), items(("p1", 2.0), ("p2", 3.0))
    bucketed = bucketed_table(all_, f"r_{uuid4().hex}", str(tmp_path / "r"), buckets=4)
    users = marts.dim_users(bucketed, catalog)
    moved, plan = _exchanges(users)
    # What moves is the items, to be summed up per product before they are sent to every task.
    assert moved == 1 and "Exchange hashpartitioning(asin" in plan and "BroadcastHashJoin" in plan
    assert sorted(users.collect()) == sorted(marts.dim_users(all_, catalog).collect())
