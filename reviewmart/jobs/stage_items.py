"""Raw item JSON lines to staged Parquet."""

from __future__ import annotations

from reviewmart.jobs.staging import options, parsed, read_rows, start
from reviewmart.plans.staging import stage_items
from reviewmart.schemas import RAW_ITEM
from reviewmart.sources.ledger import ARCHIVE, stage_pending
from reviewmart.sources.readers import scan_items_json
from reviewmart.sources.writers import write_items_parquet
from reviewmart.workspace import run_folder


def main(argv: list[str] | None = None) -> None:
    chosen = parsed(options(__doc__, "raw/meta/*.jsonl.gz", "staging/item"), argv)
    spark = start("stage items", chosen)
    if chosen.ledger:
        scan = lambda paths: scan_items_json(spark, paths, chosen.skip_broken_files)
        stage = lambda raw: stage_items(raw, ARCHIVE)
        fresh = stage_pending(spark, chosen.input, chosen.output, chosen.ledger, scan, stage)
        print(f"archives staged: {len(fresh)}")
        return
    scan = scan_items_json(spark, chosen.input, chosen.skip_broken_files)
    with run_folder(spark):
        raw = read_rows(spark, chosen, RAW_ITEM, scan)
        write_items_parquet(stage_items(raw), chosen.output, chosen.partitions)


if __name__ == "__main__":
    main()
