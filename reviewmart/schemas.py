"""Declared schemas: what is read, what is staged, and what each model promises."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_text, _long, _double, _flag = StringType(), LongType(), DoubleType(), BooleanType()
_int, _moment, _date = IntegerType(), TimestampType(), DateType()

RAW_REVIEW = _schema(
    timestamp=_long,
    rating=_double,
    helpful_votes=_long,
    title=_text,
    text=_text,
    asin=_text,
    verified_purchase=_flag,
    parent_asin=_text,
    user_id=_text,
)

# Some raw files carry the review time under another name; staging accepts either.
RAW_REVIEW_ANY_TIME = StructType([*RAW_REVIEW.fields, StructField("sort_timestamp", _long, True)])

RAW_ITEM = _schema(
    main_category=_text,
    parent_asin=_text,
    average_rating=_double,
    rating_number=_double,
    price=_text,
    categories=ArrayType(ArrayType(_text)),
    title=_text,
    store=_text,
)

STAGED_REVIEW = _schema(
    timestamp_ms=_long,
    rating=_double,
    helpful_votes=_long,
    title=_text,
    text=_text,
    asin=_text,
    verified_purchase=_flag,
    parent_asin=_text,
    user_id=_text,
    year=_int,
    month=_int,
    day=_int,
    timestamp=_moment,
)

STAGED_ITEM = RAW_ITEM

STG_REVIEWS = _schema(
    review_id=BinaryType(),
    asin=_text,
    user_id=_text,
    rating=_double,
    verified_purchase=_flag,
    helpful_votes=_long,
    timestamp=_moment,
    year=_long,
    month=_long,
    day=_long,
)

STG_ITEMS = _schema(
    asin=_text,
    category=_text,
    title=_text,
    store=_text,
    price=_double,
    average_rating=_double,
    rating_number=_double,
)

DIM_ITEMS = _schema(
    asin=_text,
    title=_text,
    category=_text,
    store=_text,
    price=_double,
    average_rating=_double,
    rating_number=_double,
)

DIM_USERS = _schema(
    user_id=_text,
    verified_purchase_count=_long,
    review_count=_long,
    first_review_date=_moment,
    last_review_date=_moment,
    active_days=_long,
    avg_days_between_reviews=_double,
    total_spent=_double,
)

DIM_TIME = _schema(
    date_day=_date,
    year=_long,
    month=_long,
    day=_long,
    quarter=_long,
    day_name=_text,
    month_name=_text,
    week_of_year=_long,
    day_of_week=_long,
    is_weekend=_flag,
)

FCT_REVIEWS = _schema(
    review_id=BinaryType(),
    review_id_power_bi=_text,
    user_id=_text,
    asin=_text,
    rating=_double,
    verified_purchase=_flag,
    helpful_votes=_long,
    timestamp=_moment,
    review_month=_moment,
    price=_double,
    category=_text,
    store=_text,
    avg_rating=_double,
    rating_diff_from_avg=_double,
    review_date=_date,
    day_name=_text,
)

MODELS = {
    "stg_reviews": STG_REVIEWS,
    "stg_items": STG_ITEMS,
    "dim_items": DIM_ITEMS,
    "dim_users": DIM_USERS,
    "dim_time": DIM_TIME,
    "fct_reviews": FCT_REVIEWS,
}

# Columns that must be filled and unique, by model.
KEYS = {
    "stg_items": "asin",
    "dim_items": "asin",
    "dim_users": "user_id",
    "dim_time": "date_day",
}
