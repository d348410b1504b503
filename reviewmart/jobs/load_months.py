"""Staged Parquet to the star schema, one range of months at a time.

Only the range's reviews are read. Items and calendar are refreshed, and the user dimension is made
anew from the states of all months, each as a catalog table that readers never see half done.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from reviewmart import schemas
from reviewmart.operators.calendar import FIRST_DAY, LAST_DAY, calendar, dim_time
from reviewmart.operators.quality import check_keys, require_schema
from reviewmart.plans import incremental, marts
from reviewmart.plans.staging import stg_items, stg_reviews
from reviewmart.session import apply_conf
from reviewmart.sources.readers import scan_parquet
from reviewmart.sources.writers import refresh_table
from reviewmart.workspace import run_folder, stored_bytes


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--reviews", default="staging/review")
    args.add_argument("--items", default="staging/item")
    args.add_argument("--output", required=True)
    args.add_argument("--database", default="default", help="catalog database of the dimensions")
    args.add_argument("--first", type=date.fromisoformat, required=True, help="a day of the first month")
    args.add_argument("--last", type=date.fromisoformat, required=True, help="a day of the last month")
    args.add_argument("--first-day", type=date.fromisoformat, default=FIRST_DAY)
    args.add_argument("--last-day", type=date.fromisoformat, default=LAST_DAY)
    chosen = args.parse_args(argv)

    spark = SparkSession.builder.appName("load months").getOrCreate()
    out = chosen.output.rstrip("/")
    apply_conf(spark, stored_bytes(spark, chosen.reviews) + stored_bytes(spark, chosen.items))
    reviews = stg_reviews(scan_parquet(spark, chosen.reviews))
    dimensions = {
        "dim_items": marts.dim_items(stg_items(scan_parquet(spark, chosen.items))),
        "dim_time": dim_time(calendar(spark, chosen.first_day, chosen.last_day)),
    }
    failed = check_keys(dimensions).where("failures > 0").collect()
    if failed:
        raise SystemExit("\n".join(f"{c['model']}.{c['column_name']}: {c['check']} fails "
                                   f"{c['failures']} times" for c in failed))

    def refresh(name: str, df):
        checked = require_schema(df, schemas.MODELS[name])
        return refresh_table(checked, f"{chosen.database}.{name}", f"{out}/{name}")

    with run_folder(spark):
        tables = {name: refresh(name, df) for name, df in dimensions.items()}
        incremental.load_months(reviews, out, chosen.first, chosen.last)
        refresh("dim_users", incremental.dim_users(spark, out, tables["dim_items"]))


if __name__ == "__main__":
    main()
