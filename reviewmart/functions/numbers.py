"""Casts that give null instead of failing, price parsing and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the first unsigned decimal number in a text.
FIRST_NUMBER = r"\d+(?:\.\d+)?"


def safe_double(value: Column) -> Column:
    return value.try_cast("double")


def clean_price(text: Column) -> Column:
    """The first number in a price text; null if it holds none."""
    return safe_double(F.regexp_substr(text, F.lit(FIRST_NUMBER)))


def round_cents(value: Column) -> Column:
    """Two decimals, halves away from zero, without negative zero."""
    return F.signum(value) * F.floor(F.abs(value) * 100 + 0.5) / 100 + F.lit(0.0)


def rating_diff(rating: Column, avg_rating: Column) -> Column:
    return round_cents(rating - avg_rating)
