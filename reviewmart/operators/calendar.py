"""The day calendar."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.functions.times import sunday_week

# The calendar's first and last day.
FIRST_DAY = date(1995, 1, 1)
LAST_DAY = date(2026, 12, 31)
# Days a calendar may have: a thousand years. More than that comes from a broken time.
MOST_DAYS = 365_250


def calendar(
    spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY, most_days: int = MOST_DAYS
) -> DataFrame:
    """One row per day, both ends included; a ``ValueError`` for a span beyond ``most_days``."""
    days = (last - first).days + 1
    if days > most_days:
        raise ValueError(f"{first} to {last} is {days} days, more than {most_days}")
    number = F.col("id").cast("int")
    return spark.range(max(days, 0)).select(F.date_add(F.lit(first), number).alias("date_day"))


def calendar_of(df: DataFrame, day: Column, most_days: int = MOST_DAYS) -> DataFrame:
    """One row per day from the earliest to the latest ``day`` in ``df``; none without days.

    The two bounds are read first. Days beyond the year 9999 are outside any calendar too.
    """
    low, high = F.unix_date(F.min(day)), F.unix_date(F.max(day))
    bounds = df.agg(low.alias("low"), high.alias("high")).first()
    if bounds["low"] is None:
        return calendar(df.sparkSession, FIRST_DAY, FIRST_DAY - timedelta(days=1))
    epoch = date(1970, 1, 1).toordinal()
    span = bounds["high"] - bounds["low"] + 1
    if span > most_days or not 1 <= bounds["low"] + epoch <= bounds["high"] + epoch <= date.max.toordinal():
        raise ValueError(f"the days span {span} days, more than {most_days}, or leave the calendar")
    first, last = (date.fromordinal(bounds[name] + epoch) for name in ("low", "high"))
    return calendar(df.sparkSession, first, last, most_days)


def dim_time(days: DataFrame) -> DataFrame:
    """Calendar attributes of each ``date_day``. Weekdays run from 1 = Sunday to 7 = Saturday."""
    day = F.col("date_day")
    weekday = F.dayofweek(day)
    return days.select(
        day,
        F.year(day).cast("long").alias("year"),
        F.month(day).cast("long").alias("month"),
        F.dayofmonth(day).cast("long").alias("day"),
        F.quarter(day).cast("long").alias("quarter"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        sunday_week(day).cast("long").alias("week_of_year"),
        weekday.cast("long").alias("day_of_week"),
        weekday.isin(1, 7).alias("is_weekend"),
    )


def holiday_flag(time: DataFrame, holidays: DataFrame) -> DataFrame:
    """Mark the days listed in ``holidays`` (``date``, ``name``); one listed twice stays one row."""
    day = F.col("date").alias("date_day")
    named = holidays.groupBy(day).agg(F.min("name").alias("holiday_name"))
    marked = time.join(named, "date_day", "left")
    return marked.withColumn("is_holiday", F.col("holiday_name").isNotNull())
