"""Raw review JSON lines to staged Parquet."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from reviewmart.jobs.staging import options, parsed, read_rows, start
from reviewmart.plans.staging import stage_reviews
from reviewmart.schemas import RAW_REVIEW_ANY_TIME
from reviewmart.sources.ledger import ARCHIVE, stage_pending
from reviewmart.sources.readers import scan_reviews_json
from reviewmart.sources.writers import write_reviews_parquet
from reviewmart.workspace import run_folder


def main(argv: list[str] | None = None) -> None:
    chosen = parsed(options(__doc__, "raw/reviews/*.jsonl.gz", "staging/review"), argv)
    spark = start("stage reviews", chosen)
    if chosen.ledger:
        scan = lambda paths: scan_reviews_json(
            spark, paths, RAW_REVIEW_ANY_TIME, chosen.skip_broken_files
        )
        stage = lambda raw: stage_reviews(raw, ARCHIVE)
        fresh = stage_pending(spark, chosen.input, chosen.output, chosen.ledger, scan, stage)
        print(f"archives staged: {len(fresh)}")
        return
    scan = scan_reviews_json(spark, chosen.input, RAW_REVIEW_ANY_TIME, chosen.skip_broken_files)
    with run_folder(spark):
        raw = read_rows(spark, chosen, RAW_REVIEW_ANY_TIME, scan)
        # Times that no timestamp can hold become null, and their reviews are left out of the models.
        beyond = F.count_if(F.col("timestamp_ms").isNotNull() & F.col("timestamp").isNull())
        seen = Observation("staged reviews")
        staged = stage_reviews(raw).observe(seen, F.count("*").alias("rows"), beyond.alias("beyond"))
        write_reviews_parquet(staged, chosen.output, chosen.partitions)
    print(f"reviews: {seen.get['rows']}, with a time out of range: {seen.get['beyond']}")


if __name__ == "__main__":
    main()
