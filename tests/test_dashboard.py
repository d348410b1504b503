import pytest

from reviewmart.plans import dashboard, marts


@pytest.fixture
def fact(reviews, items, time):
    return marts.fct_reviews(
        reviews(
            ("u", "a", "2020-01-05", 5.0, True),
            ("u", "b", "2020-01-06", 3.0, False),
            ("v", "a", "2021-01-05", 2.0, True),
            ("v", "gone", "1990-03-01", 1.0, None),
        ),
        items(("a", 10.0, "Toys"), ("b", None, "Books")),
        time,
    )


def _dict(df, key, value):
    return {row[key]: row[value] for row in df.collect()}


def test_by_year(fact):
    assert _dict(dashboard.reviews_by_year(fact), "year", "review_count") == {2020: 2, 2021: 1, None: 1}
    assert _dict(dashboard.reviews_by_year(fact, True), "year", "review_count") == {2020: 1, 2021: 1}


def test_category_trend(fact):
    found = {
        (r["category"], r["review_month"].strftime("%Y-%m")): r["avg_rating"]
        for r in dashboard.category_rating_trend(fact).collect()
    }
    assert found == {
        ("Toys", "2020-01"): 5.0,
        ("Toys", "2021-01"): 2.0,
        ("Books", "2020-01"): 3.0,
        (None, "1990-03"): 1.0,
    }


def test_share(fact):
    shares = dashboard.category_share(fact)
    assert _dict(shares, "category", "share") == {"Toys": 0.5, "Books": 0.25, None: 0.25}
    assert dict(shares.dtypes)["share"] == "double"
    assert _dict(dashboard.category_share(fact, False), "category", "share") == {"Books": 1.0}


def test_top_users_break_ties_by_name(spark):
    users = spark.createDataFrame(
        [(f"u{i:02d}", 5, 1.0 * i) for i in range(12)] + [("top", 9, 0.0)],
        "user_id string, review_count long, total_spent double",
    )
    found = [r["user_id"] for r in dashboard.top10_users(users).collect()]
    assert found == ["top", *(f"u{i:02d}" for i in range(9))]


def test_months(fact):
    months = {r["month"]: (r["review_count"], r["avg_price"]) for r in dashboard.monthly_reviews_price(fact).collect()}
    assert months == {1: (3, 10.0), 3: (1, None)}
    assert dashboard.monthly_reviews_price(fact, by_calendar_month=True).count() == 3


def test_weekdays(fact):
    assert _dict(dashboard.weekday_trend(fact), "day_name", "review_count") == {
        "Sunday": 1,
        "Monday": 1,
        "Tuesday": 1,
        None: 1,
    }
