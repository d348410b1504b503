from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from reviewmart import schemas
from reviewmart.operators.joins import JoinLimits
from reviewmart.operators.quality import require_schema
from reviewmart.operators.rows import dedup_reviews
from reviewmart.plans import marts
from reviewmart.sources import writers


def test_user_measures(reviews, items):
    users = marts.dim_users(
        reviews(
            ("one", "a", "2020-01-01 10:00:00", 3.0, None),
            ("same", "a", "2020-01-01 01:00:00", 3.0, False),
            ("same", "b", "2020-01-01 23:00:00", 3.0, True),
            ("span", "a", "2020-01-01 23:00:00"),
            ("span", "gone", "2020-01-04 12:00:00"),
            ("span", None, "2020-01-11 01:00:00"),
            (None, "a", "2020-01-01"),
        ),
        items(("a", 10.0), ("b", None)),
    )
    got = {row["user_id"]: row.asDict() for row in require_schema(users, schemas.DIM_USERS).collect()}
    assert set(got) == {"one", "same", "span"}

    def of(name):
        return [got[user][name] for user in ("one", "same", "span")]

    assert of("verified_purchase_count") == [0, 1, 3]
    assert of("review_count") == [1, 2, 3]
    assert of("active_days") == [1, 1, 3]
    assert of("avg_days_between_reviews") == [None, 0.0, 5.0]
    assert of("total_spent") == [10.0, 10.0, 10.0]
    assert got["span"]["first_review_date"] == datetime(2020, 1, 1, 23)
    assert got["span"]["last_review_date"] == datetime(2020, 1, 11, 1)


def test_user_measures_count_every_listing_of_an_item(reviews, items):
    """The summary join must equal the row-by-row join of the definition."""
    some = reviews(
        ("u", "a", "2020-01-01"), ("u", "b", "2020-01-03"), ("v", "a", "2020-01-01", 2.0, False)
    )
    listed = items(("a", 10.0), ("a", 1.0), ("a", None), ("b", 5.0), (None, 3.0))
    got = {r["user_id"]: r.asDict() for r in marts.dim_users(some, listed).collect()}
    joined = some.join(listed.select("asin", "price"), "asin", "left").groupBy("user_id").agg(
        F.count("*").alias("n"),
        F.count_if("verified_purchase").alias("ok"),
        F.sum(F.coalesce("price", F.lit(0.0))).alias("spent"),
    )
    for row in joined.collect():
        user = got[row["user_id"]]
        assert (user["review_count"], user["verified_purchase_count"]) == (row["n"], row["ok"])
        assert user["total_spent"] == row["spent"]
    assert got["u"]["avg_days_between_reviews"] == 2 / 3


def _fact(reviews, items, time):
    return marts.fct_reviews(reviews, items, time)


def test_fact_columns(reviews, items, time):
    fact = _fact(
        reviews(
            ("u", "a", "2020-02-29 23:59:59", 5.0),
            ("v", "a", "1994-01-01", 2.0),
            (None, None, "2020-01-01", 1.0),
            ("w", "unlisted", "2020-01-01", 1.0),
        ),
        items(("a", 3.5, "Toys")),
        time,
    )
    rows = {r["user_id"]: r for r in require_schema(fact, schemas.FCT_REVIEWS).collect()}
    assert fact.columns == schemas.FCT_REVIEWS.fieldNames()
    u = rows["u"]
    assert u["review_id_power_bi"] == bytes(u["review_id"]).hex()
    assert (u["price"], u["category"], u["store"]) == (3.5, "Toys", "shop")
    assert (u["avg_rating"], u["rating_diff_from_avg"]) == (3.5, 1.5)
    assert (str(u["review_date"]), u["day_name"]) == ("2020-02-29", "Saturday")
    assert u["review_month"] == datetime(2020, 2, 1)
    assert rows["v"]["review_date"] is None and rows["v"]["rating_diff_from_avg"] == -1.5
    assert rows[None]["avg_rating"] is None and rows[None]["rating_diff_from_avg"] is None
    assert (rows["w"]["avg_rating"], rows["w"]["price"]) == (1.0, None)


def test_fact_repeats_reviews_of_items_listed_twice(reviews, items, time):
    fact = _fact(
        reviews(("u", "a", "2020-01-01", 4.0), ("v", "a", "2020-01-01", 2.0)),
        items(("a", 1.0), ("a", 2.0)),
        time,
    )
    assert Counter((r["user_id"], r["price"], r["avg_rating"]) for r in fact.collect()) == {
        (user, price, 3.0): 1 for user in "uv" for price in (1.0, 2.0)
    }


def _loaded(fact, path):
    rows = writers.read_fact(fact.sparkSession, path).collect()
    return Counter((r["user_id"], r["review_month"].strftime("%m"), r["rating"]) for r in rows)


def test_load_replaces_only_the_months_it_brings(reviews, items, time, tmp_path):
    path, listed = str(tmp_path / "fact"), items(("a", 1.0))
    first = _fact(reviews(("u", "a", "2020-01-05", 1.0), ("u", "a", "2020-02-05", 1.0)), listed, time)
    twice = ("u", "a", "2020-02-07", 5.0)
    second = _fact(reviews(twice, twice, ("u", "a", "2020-03-05", 5.0)), listed, time)
    writers.load_fact(first, path)
    for _ in range(2):  # loading again changes nothing
        writers.load_fact(second, path)
        assert _loaded(second, path) == {
            ("u", "01", 1.0): 1,
            ("u", "02", 5.0): 2,
            ("u", "03", 5.0): 1,
        }
    back = writers.read_fact(second.sparkSession, path)
    assert back.dtypes == second.dtypes
    plan = back.where("review_month = timestamp '2020-01-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(review_month" in plan


@pytest.mark.parametrize("broadcast_bytes", [10**9, -1])
def test_context_counts_the_same_reviews_either_way(reviews, items, broadcast_bytes):
    some = reviews(
        ("u", "a", "2020-01-01", 4.0), ("v", "a", "2020-01-01", 4.0), ("w", None, "2020-01-01", 2.0)
    )
    context = marts.review_context(
        some,
        items(("a", 1.0), ("a", 3.0), ("a", 3.0)),
        ["price"],
        ["rating"],
        JoinLimits(broadcast_bytes),
    )
    assert sorted(context.columns) == ["n", "price", "rating"]
    assert {(r["price"], r["rating"], r["n"]) for r in context.collect()} == {
        (1.0, 4.0, 2),
        (3.0, 4.0, 4),
        (None, 2.0, 1),
    }


def test_layout_changes_no_value(spark, reviews, items, time, tmp_path):
    """Keys that were made elsewhere stay as they are."""
    fact = _fact(reviews(*[(f"u{i}", "a", "2020-01-05") for i in range(50)]), items(("a", 1.0)), time)
    own = fact.withColumn("review_id", F.encode(F.concat(F.lit("mine-"), "user_id"), "utf-8"))
    own = own.withColumn("review_id_power_bi", F.concat(F.lit("mine-"), "user_id"))
    writers.load_fact(own, str(tmp_path / "fact"))
    back = writers.read_fact(spark, str(tmp_path / "fact"))
    bag = lambda df: Counter(map(str, df.collect()))
    assert bag(back) == bag(own)


def test_the_fact_keeps_the_keys_of_its_reviews(reviews, items, time):
    own = reviews(("u", "a", "2020-01-05")).withColumn("review_id", F.encode(F.lit("mine"), "utf-8"))
    row = _fact(own, items(("a", 1.0)), time).first()
    assert (bytes(row["review_id"]), row["review_id_power_bi"]) == (b"mine", b"mine".hex())


def test_files_of_a_month_hold_separate_users(spark, conf, reviews, items, time, tmp_path):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = reviews(*[(f"u{i % 700:03d}", "a", "2020-01-05") for i in range(4000)])
    fact = marts.fct_reviews(rows.repartition(8), items(("a", 1.0)), time)
    writers.load_fact(fact, str(tmp_path / "fact"), partitions=6)
    ranges = []
    for file in (tmp_path / "fact").glob("review_month=*/*.parquet"):
        users = [r[0] for r in spark.read.parquet(str(file)).select("user_id").collect()]
        assert users == sorted(users)
        ranges.append((users[0], users[-1]))
    assert len(ranges) >= 5
    ranges.sort()
    # Neighbours may share the one user at their border.
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_a_busy_user_is_split(spark, conf, reviews, items, time, tmp_path):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = reviews(*[("u", "a", f"2020-01-05 {i % 24:02d}:{i // 24 % 60:02d}:00") for i in range(1440)])
    fact = marts.fct_reviews(rows, items(("a", 1.0)), time)
    writers.load_fact(fact, str(tmp_path / "fact"), partitions=6)
    files = list((tmp_path / "fact").glob("review_month=*/*.parquet"))
    assert max(spark.read.parquet(str(f)).count() for f in files) < 600


def test_large_summaries_give_the_same_models(spark):
    """The shuffled, spread joins against the broadcast ones, over the smallest test tables."""
    from reviewmart.checks.queries import SHUFFLED, Models, comparable

    models = Models(spark, "/root/testdata/sf0.001")
    bag = lambda df: Counter(tuple(row) for row in comparable(df).collect())
    assert bag(models.fct_reviews(SHUFFLED)) == bag(models.fct_reviews())
    assert bag(models.dim_users(SHUFFLED)) == bag(models.dim_users())


def test_dedup_keeps_one_best_review_per_key(spark, reviews):
    same = ("u", "a", "2020-01-01")
    some = reviews(same, same, ("u", "b", "2020-01-01"), ("u", "ab", "2020-01-01"))
    votes = some.withColumn("helpful_votes", F.monotonically_increasing_id() % 7)
    kept = dedup_reviews(votes)
    best = votes.groupBy("review_id").agg(F.max("helpful_votes").alias("v"))
    assert kept.count() == best.count() == 3
    assert kept.join(best, "review_id").where("helpful_votes <> v").count() == 0
    assert kept.columns == votes.columns
