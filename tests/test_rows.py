"""Filling prices by groups, and keys that run together."""

import pytest

from reviewmart.operators.rows import dedup_reviews, impute_price, key_collisions
from reviewmart.schemas import DIM_ITEMS


@pytest.fixture
def shop(spark):
    def build(*rows):
        full = [(f"p{i}", "t", category, store, price, 4.0, 1.0) for i, (category, store, price) in enumerate(rows)]
        return spark.createDataFrame(full, DIM_ITEMS)

    return build


def test_price_levels(shop):
    items = shop(
        ("A", "x", 1.0), ("A", "x", 3.0), ("A", "x", None), ("A", "y", 10.0), ("A", "z", None), ("B", "x", None),
        (None, "x", 7.0), (None, "x", None), (None, None, None), ("A", None, None),
    )
    got = {r["asin"]: (r["price"], r["price_from"]) for r in impute_price(items).collect()}
    assert got == {
        "p0": (1.0, "item"), "p1": (3.0, "item"), "p2": (2.0, "category+store"), "p3": (10.0, "item"),
        "p4": (3.0, "category"), "p5": (5.0, "all"), "p6": (7.0, "item"), "p7": (7.0, "category+store"),
        "p8": (7.0, "category"), "p9": (3.0, "category"),
    }
    assert impute_price(items).columns == [*items.columns, "price_from"]


def test_without_any_price(shop):
    row = impute_price(shop(("A", "x", None))).first()
    assert (row["price"], row["price_from"]) == (None, None)
    assert impute_price(shop(("A", "x", 1.0)).limit(0)).count() == 0


def test_shifted_parts_share_an_id(reviews):
    shifted = reviews(
        ("ab", "c", "2020-01-01 00:00:00"), ("a", "bc", "2020-01-01 00:00:00"), ("a", "bc", "2020-01-01 00:00:00"),
        (None, "abc", "2020-01-01 00:00:00"), ("", "abc", "2020-01-01 00:00:00"), ("x", "y", "2020-01-01 00:00:00"),
    )
    assert dedup_reviews(shifted).count() == 2
    assert dedup_reviews(shifted, exact=True).count() == 5
    assert [(r["keys"], r["reviews"]) for r in key_collisions(shifted).collect()] == [(4, 5)]
    assert key_collisions(reviews(("x", "y", "2020-01-01 00:00:00"))).isEmpty()
