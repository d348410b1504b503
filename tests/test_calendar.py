from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from reviewmart.functions.times import ms_to_timestamp
from reviewmart.operators.calendar import FIRST_DAY, calendar, calendar_of, dim_time, holiday_flag
from reviewmart.operators.quality import check_not_null, check_unique, require_schema
from reviewmart.schemas import DIM_TIME


def test_whole_calendar_against_python(spark, time):
    rows = require_schema(time, DIM_TIME).orderBy("date_day").collect()
    assert len(rows) == 11_688
    assert sum(row["is_weekend"] for row in rows) == 3_339
    for i, row in enumerate(rows):
        day = FIRST_DAY + timedelta(days=i)
        assert row["date_day"] == day
        assert (row["year"], row["month"], row["day"]) == (day.year, day.month, day.day)
        assert row["quarter"] == (day.month + 2) // 3
        assert row["day_name"] == day.strftime("%A")
        assert row["month_name"] == day.strftime("%B")
        assert row["week_of_year"] == int(day.strftime("%U"))
        assert row["day_of_week"] == day.isoweekday() % 7 + 1
        assert row["is_weekend"] == (day.isoweekday() >= 6)


def test_calendar_keys_hold(time):
    assert check_not_null(time, "dim_time", "date_day").first()["failures"] == 0
    assert check_unique(time, "dim_time", "date_day").first()["failures"] == 0


def test_bounds(spark):
    assert calendar(spark, date(2020, 2, 28), date(2020, 3, 1)).count() == 3
    days = spark.createDataFrame([(date(2021, 1, 5),), (date(2021, 1, 1),)], "d date")
    assert [r[0].day for r in calendar_of(days, F.col("d")).collect()] == [1, 2, 3, 4, 5]


def test_a_broken_time_gives_a_clear_error(spark):
    far = spark.createDataFrame([(1_600_000_000_000,), (1_600_000_000_000_000,)], "ms long")
    with pytest.raises(ValueError, match="18499999|days"):
        calendar_of(far, F.to_date(ms_to_timestamp(F.col("ms"))))
    with pytest.raises(ValueError, match="more than 10"):
        calendar(spark, date(2020, 1, 1), date(2020, 1, 11), most_days=10)
    none = spark.createDataFrame([(None,)], "d date")
    assert calendar_of(none, F.col("d")).count() == 0


def test_holidays_mark_days_without_multiplying_them(spark):
    days = dim_time(calendar(spark, date(2020, 12, 24), date(2020, 12, 26)))
    listed = spark.createDataFrame(
        [(date(2020, 12, 25), "Christmas"), (date(2020, 12, 25), "Xmas")], "date date, name string"
    )
    marked = holiday_flag(days, listed).orderBy("date_day").collect()
    assert [(r["holiday_name"], r["is_holiday"]) for r in marked] == [
        (None, False),
        ("Christmas", True),
        (None, False),
    ]
