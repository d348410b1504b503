"""Epoch milliseconds, calendar parts and month floors, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Largest number of seconds whose microseconds still fit a 64-bit timestamp.
_MAX_SECONDS = 9_223_372_036_854


def ms_to_timestamp(ms: Column) -> Column:
    """Whole seconds, cut toward zero; null where no timestamp can hold the value."""
    seconds = F.call_function("div", ms, F.lit(1000))
    return F.timestamp_seconds(F.when(seconds.between(-_MAX_SECONDS, _MAX_SECONDS), seconds))


def ts_parts(ts: Column) -> list[Column]:
    """``year``, ``month`` and ``day`` of a timestamp."""
    return [
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
    ]


def review_date(ts: Column) -> Column:
    return F.to_date(ts)


def review_month(ts: Column) -> Column:
    """First moment of the month, still a timestamp."""
    return F.date_trunc("MONTH", ts)


def sunday_week(day: Column) -> Column:
    """Week of the year, 0 to 53; weeks start on Sunday, days before the first one are week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7)
