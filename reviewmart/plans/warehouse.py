"""Staged Parquet to a complete star schema on disk, with its key checks."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart import schemas
from reviewmart.operators.calendar import FIRST_DAY, LAST_DAY, calendar, dim_time, holiday_flag
from reviewmart.operators.quality import check_keys, require_schema
from reviewmart.operators.rows import handle_missing
from reviewmart.plans import marts
from reviewmart.plans.staging import stg_items, stg_reviews
from reviewmart.session import apply_conf
from reviewmart.sources.readers import external_table
from reviewmart.sources.writers import load_fact, materialize_table, materialize_view, read_fact
from reviewmart.workspace import run_folder, stored_bytes


def build(
    spark: SparkSession,
    review_path: str,
    item_path: str,
    out: str,
    clean_reviews: Callable[[DataFrame], DataFrame] | None = None,
    first_day: date = FIRST_DAY,
    last_day: date = LAST_DAY,
    holidays: DataFrame | None = None,
    missing: dict[str, float | str] | None = None,
) -> dict[str, DataFrame]:
    """Refresh the dimensions, load the fact's months and return every model plus ``checks``.

    ``clean_reviews`` is applied to the staging model first, e.g. ``dedup_reviews``; what it
    leaves is a table then, written once. ``holidays`` (``date``, ``name``) are marked in the
    calendar, and ``missing`` gives values for unknown item columns. The dimensions' keys are
    checked before the fact is touched: if a check fails, no fact is loaded and ``fct_reviews``
    is missing from what is returned.
    """
    out = out.rstrip("/")
    apply_conf(spark, stored_bytes(spark, review_path) + stored_bytes(spark, item_path))
    reviews = stg_reviews(external_table(spark, "stg_reviews_ext", review_path))
    if clean_reviews:
        reviews = materialize_table(clean_reviews(reviews), f"{out}/stg_reviews")
    items = stg_items(external_table(spark, "stg_items_ext", item_path))
    if missing:
        items = handle_missing(items, missing)

    models = {
        "stg_reviews": materialize_view(reviews, "stg_reviews"),
        "stg_items": materialize_view(items, "stg_items"),
    }

    def refresh(name: str, df: DataFrame) -> DataFrame:
        checked = require_schema(df, schemas.MODELS[name])
        if name == "dim_time" and holidays is not None:
            checked = holiday_flag(checked, holidays)
        models[name] = materialize_table(checked, f"{out}/{name}")
        return models[name]

    with run_folder(spark):
        item_table = refresh("dim_items", marts.dim_items(items))
        time_table = refresh("dim_time", dim_time(calendar(spark, first_day, last_day)))
        per_item = marts.item_context(reviews, item_table)
        counts = per_item.groupBy("asin").agg(F.max("rows").alias("rows"))
        refresh("dim_users", marts.dim_users(reviews, item_table, counts=counts))

        models["checks"] = materialize_table(check_keys(models), f"{out}/checks")
        if not models["checks"].where("failures > 0").isEmpty():
            return models
        fact = require_schema(
            marts.fct_reviews(reviews, item_table, time_table, per_item=per_item),
            schemas.FCT_REVIEWS,
        )
        fact_path = f"{out}/fct_reviews"
        load_fact(fact, fact_path, derived=marts.fct_derived())
    models["fct_reviews"] = read_fact(spark, fact_path)
    return models
