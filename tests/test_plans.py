"""What Catalyst makes of the models over staged Parquet."""

import re

import pytest
from pyspark.sql import functions as F

from reviewmart.operators import rows
from reviewmart.operators.aggregates import active_days, item_avg
from reviewmart.plans import dashboard, staging
from reviewmart.sources import readers, writers


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    from reviewmart.checks import tables

    path = str(tmp_path_factory.mktemp("staged") / "review")
    raw = tables.raw_reviews(spark, "/root/testdata/sf0.001")
    writers.write_reviews_parquet(staging.stage_reviews(raw), path)
    return readers.external_table(spark, "staged_for_plans", path)


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(staged):
    plan = _plan(item_avg(staging.stg_reviews(staged)))
    assert "PushedFilters: [IsNotNull(rating), IsNotNull(timestamp)]" in plan
    assert "ReadSchema: struct<rating:double,parent_asin:string,timestamp:timestamp>" in plan


def test_slicer_reaches_the_scan(conf, staged):
    conf(spark__sql__maxMetadataStringLength="2000")
    plan = _plan(rows.verified_slicer(staging.stg_reviews(staged), True))
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(verified_purchase,true\)", plan)


def test_dedup_keeps_best_rows_before_the_shuffle(staged):
    plan = _plan(rows.dedup_reviews(staging.stg_reviews(staged)))
    assert re.search(r"WindowGroupLimit .*Final(.|\n)*Exchange(.|\n)*WindowGroupLimit .*Partial", plan)


def test_distinct_days_are_aggregated_before_the_shuffle(staged):
    grouped = staging.stg_reviews(staged).groupBy("user_id")
    plan = _plan(grouped.agg(active_days(F.col("timestamp")).alias("d")))
    final = plan.split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 2
    assert "Expand" not in final


def test_top_users_are_not_sorted_globally(spark):
    users = spark.range(1000).selectExpr(
        "string(id) as user_id", "id % 9 as review_count", "0.0D as total_spent"
    )
    plan = _plan(dashboard.top10_users(users))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
