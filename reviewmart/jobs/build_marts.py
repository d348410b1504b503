"""Staged Parquet to the star schema; exits with an error if a key check fails."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.operators.calendar import FIRST_DAY, LAST_DAY
from reviewmart.operators.rows import dedup_reviews, key_collisions
from reviewmart.plans.warehouse import build


# Shared ids that are printed.
_NAMED = 100


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--reviews", default="staging/review")
    args.add_argument("--items", default="staging/item")
    args.add_argument("--output", required=True)
    args.add_argument("--dedup", action="store_true", help="keep one review per review_id")
    args.add_argument(
        "--exact-keys",
        action="store_true",
        help="with --dedup, keep reviews that share an id by accident, and name such ids",
    )
    args.add_argument("--first-day", type=date.fromisoformat, default=FIRST_DAY)
    args.add_argument("--last-day", type=date.fromisoformat, default=LAST_DAY)
    args.add_argument("--holidays", help="CSV file with the columns date and name, to be marked")
    args.add_argument("--missing-price", type=float, help="price of items without one")
    args.add_argument("--missing-category", help="category of items without one")
    chosen = args.parse_args(argv)

    spark = SparkSession.builder.appName("build marts").getOrCreate()
    holidays = None
    if chosen.holidays:
        listed = spark.read.csv(chosen.holidays, header=True, schema="date date, name string")
        holidays = listed.where(F.col("date").isNotNull())
    def clean(reviews: DataFrame) -> DataFrame:
        if chosen.exact_keys:
            for row in key_collisions(reviews).orderBy("review_id").limit(_NAMED).collect():
                print(f"{bytes(row['review_id']).hex()}: {row['keys']} keys in {row['reviews']} reviews")
        return dedup_reviews(reviews, exact=chosen.exact_keys)

    missing = {"price": chosen.missing_price, "category": chosen.missing_category}
    models = build(
        spark,
        chosen.reviews,
        chosen.items,
        chosen.output,
        clean if chosen.dedup else None,
        chosen.first_day,
        chosen.last_day,
        holidays,
        {name: value for name, value in missing.items() if value is not None},
    )
    failed = models["checks"].where("failures > 0").collect()
    if failed:
        raise SystemExit("\n".join(f"{c['model']}.{c['column_name']}: {c['check']} fails "
                                   f"{c['failures']} times" for c in failed))


if __name__ == "__main__":
    main()
