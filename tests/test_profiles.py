"""Profiles that grow with their table, within the sketches' error."""

import os

import pytest
from pyspark.sql import functions as F

from reviewmart.operators.profiles import merged_profile, update_profile


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "table"), str(tmp_path / "state")


def _rows(spark, begin, end):
    return spark.range(begin, end).select(
        "id",
        (F.col("id") % 1000).alias("few"),
        F.when(F.col("id") % 4 > 0, F.col("id") * 0.5).alias("half"),
        F.concat(F.lit("t"), F.col("id") % 5000).alias("text"),
        F.lit(None).cast("string").alias("nothing"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("day"),
    )


def test_new_files_only(spark, paths):
    table, state = paths
    _rows(spark, 0, 40_000).repartition(4).write.parquet(table)
    assert len(update_profile(spark, table, state)) == 4
    assert update_profile(spark, table, state) == []
    _rows(spark, 30_000, 100_000).repartition(3).write.mode("append").parquet(table)
    fresh = update_profile(spark, table, state)
    assert len(fresh) == 3
    got = {r["column_name"]: r for r in merged_profile(spark, table, state).collect()}
    exact = {"id": 100_000, "few": 1000, "half": 75_000, "text": 5000, "nothing": 0, "day": 300}
    for name, distinct in exact.items():
        assert abs(got[name]["distinct_values"] - distinct) <= 0.05 * distinct, name
        assert got[name]["row_count"] == 110_000
    assert got["half"]["filled"] == 82_500 and got["nothing"]["filled"] == 0
    assert got["text"]["quartiles"] is None and got["nothing"]["quartiles"] is None
    for quantile, want in zip(got["id"]["quartiles"], (27_500, 45_000, 72_500), strict=True):
        assert abs(quantile - want) <= 0.03 * 110_000
    assert got["day"]["data_type"] == "date" and len(got["day"]["quartiles"]) == 3


def test_files_that_are_gone(spark, paths):
    table, state = paths
    _rows(spark, 0, 1000).repartition(2).write.parquet(table)
    update_profile(spark, table, state)
    first = sorted(name for name in os.listdir(table) if name.endswith(".parquet"))[0]
    left = spark.read.parquet(*(f"{table}/{n}" for n in os.listdir(table) if n.endswith(".parquet") and n != first)).count()
    os.remove(f"{table}/{first}")
    spark.catalog.refreshByPath(table)
    assert {r["row_count"] for r in merged_profile(spark, table, state).collect()} == {left}


def test_empty_table(spark, paths):
    table, state = paths
    _rows(spark, 0, 0).write.parquet(table)
    update_profile(spark, table, state)
    rows = merged_profile(spark, table, state).collect()
    assert all(r["filled"] == 0 for r in rows)
