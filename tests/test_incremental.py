"""Loading by month range: as one full load, without reading what was loaded before."""

import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from reviewmart.functions.times import review_month
from reviewmart.operators.joins import JoinLimits
from reviewmart.plans import incremental, marts

ROWS = [
    ("u1", "a", "2020-01-05 10:00:00", 5.0, True),
    ("u1", "a", "2020-01-05 11:00:00", 3.0, None),
    ("u1", "b", "2020-01-31 23:59:59", 1.0, False),
    ("u2", "a", "2020-02-01 00:00:00", 2.0, True),
    (None, "a", "2020-02-03 00:00:00", 4.0, True),
    ("u1", "a", "2020-03-31 12:00:00", 1.0, True),
    ("u2", None, "2020-03-02 12:00:00", 2.0, True),
    ("u3", "gone", "2021-01-31 12:00:00", 3.0, False),
]


def _rows(df):
    return sorted(str(sorted(row.asDict().items())) for row in df.collect())


@pytest.fixture
def catalog(items):
    """One product is listed twice, one without a price."""
    return items(("a", 10.0), ("a", 20.0, "Toys"), ("b", None))


def _load(spark, reviews, out, *ranges):
    for first, last in ranges:
        incremental.load_months(reviews, out, date(*first), date(*last))
    return out


@pytest.mark.parametrize("limits", [JoinLimits(), JoinLimits(broadcast_bytes=-1, fair_rows=1)])
def test_months_one_by_one_equal_one_load(spark, reviews, catalog, time, tmp_path, limits):
    all_ = reviews(*ROWS)
    out = _load(spark, all_, str(tmp_path), *(((2020, m, 9), (2020, m, 9)) for m in (3, 1, 2)), ((2020, 4, 1), (2021, 1, 1)))
    got = incremental.fct_reviews(spark, out, catalog, time, limits)
    assert _rows(got) == _rows(marts.fct_reviews(all_, catalog, time))
    assert _rows(incremental.dim_users(spark, out, catalog, limits)) == _rows(marts.dim_users(all_, catalog))


def test_a_month_is_replaced_and_emptied(spark, reviews, catalog, time, tmp_path):
    out = _load(spark, reviews(*ROWS), str(tmp_path), ((2020, 1, 1), (2021, 12, 1)))
    left = reviews(*(row for row in ROWS if "2020-02" not in row[2] and row[0] != "u2"))
    _load(spark, left, out, ((2020, 2, 1), (2020, 3, 31)))
    assert _rows(incremental.fct_reviews(spark, out, catalog, time)) == _rows(marts.fct_reviews(left, catalog, time))
    assert _rows(incremental.dim_users(spark, out, catalog)) == _rows(marts.dim_users(left, catalog))
    _load(spark, reviews(*ROWS), out, ((2020, 2, 29), (2020, 3, 1)))
    assert _rows(incremental.dim_users(spark, out, catalog)) == _rows(marts.dim_users(reviews(*ROWS), catalog))


def test_prices_change_without_a_load(spark, reviews, items, catalog, tmp_path):
    out = _load(spark, reviews(*ROWS), str(tmp_path), ((2020, 1, 1), (2021, 12, 1)))
    shutil.rmtree(f"{out}/{incremental.REVIEWS}")  # the users need no review
    dearer = items(("a", 99.0), ("b", 1.0), ("gone", 7.0))
    assert _rows(incremental.dim_users(spark, out, dearer)) == _rows(marts.dim_users(reviews(*ROWS), dearer))


def test_a_load_needs_its_own_months_only(spark, reviews, catalog, time, tmp_path):
    """Earlier deliveries may be gone when later ones are loaded; ratings are over all history."""
    out = str(tmp_path / "out")
    for month in ("2020-01", "2020-02", "2020-03", "2021-01"):
        delivered = reviews(*(row for row in ROWS if row[2].startswith(month)))
        day = date.fromisoformat(f"{month}-01")
        incremental.load_months(delivered, out, day, day)
    assert _rows(incremental.fct_reviews(spark, out, catalog, time)) == _rows(marts.fct_reviews(reviews(*ROWS), catalog, time))


def test_months_are_chosen_in_the_scan(spark, reviews, catalog, time, tmp_path):
    staged = str(tmp_path / "staged")
    reviews(*ROWS).write.parquet(staged)
    out = _load(spark, spark.read.parquet(staged), str(tmp_path / "out"), ((2020, 1, 1), (2021, 12, 1)))
    fact = incremental.fct_reviews(spark, out, catalog, time)
    march = F.col("review_month") == F.lit(datetime(2020, 3, 1))
    plan = fact.where(march)._jdf.queryExecution().executedPlan().toString()
    # The reviews' scan is left to one month; the others are of the calendar and a written summary.
    assert plan.count("PartitionFilters: [isnotnull(review_month") == 1
    assert plan.count("user_id#") > 0 and len([1 for line in plan.splitlines() if "FileScan" in line and "user_id" in line]) == 1
    assert fact.where(march).count() == 3
    chosen = spark.read.parquet(staged).where(F.col("timestamp") >= F.lit(datetime(2020, 3, 1)))
    pushed = chosen.withColumn("review_month", review_month(F.col("timestamp")))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in pushed


def test_ranges(spark, reviews, catalog, time, tmp_path):
    with pytest.raises(ValueError):
        _load(spark, reviews(*ROWS), str(tmp_path), ((2020, 2, 1), (2020, 1, 1)))
    none = reviews(*ROWS).limit(0)
    out = _load(spark, none, str(tmp_path / "none"), ((2020, 1, 1), (2020, 12, 1)))
    _load(spark, reviews(*ROWS), out, ((2020, 12, 31), (2021, 1, 1)))
    assert incremental.fct_reviews(spark, out, catalog, time).count() == 1
