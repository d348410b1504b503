import gzip
import json
import os
from uuid import uuid4

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reviewmart.jobs import build_marts, load_months, stage_items, stage_reviews
from reviewmart.plans import incremental, staging
from reviewmart.sources import ledger
from reviewmart.sources.readers import scan_reviews_json
from reviewmart.sources.writers import read_fact


@pytest.fixture
def landed(tmp_path):
    def land(folder, rows):
        (tmp_path / folder).mkdir()
        with gzip.open(tmp_path / folder / "All.jsonl.gz", "wt") as out:
            out.writelines(json.dumps(row) + "\n" for row in rows)

    day = 86_400_000
    review = {"rating": 4.0, "timestamp": 10_000 * day, "parent_asin": "a", "user_id": "u"}
    land("reviews", [review, review, {**review, "user_id": "v", "timestamp": 10_050 * day}, {}])
    return tmp_path, land


def _run(root, *extra):
    stage_reviews.main(
        ["--input", f"{root}/reviews/*.jsonl.gz", "--output", f"{root}/review", "--partitions", "2"]
    )
    stage_items.main(["--input", f"{root}/meta/*.jsonl.gz", "--output", f"{root}/item"])
    build_marts.main(
        ["--reviews", f"{root}/review", "--items", f"{root}/item", "--output", f"{root}/marts", *extra]
    )


def test_raw_files_to_star_schema(spark, landed):
    root, land = landed
    land("meta", [{"parent_asin": "a", "price": "$5.00", "main_category": "Toys"}])
    _run(root)
    read = spark.read.parquet
    assert read(f"{root}/review").count() == 4
    fact = read(f"{root}/marts/fct_reviews")
    assert fact.count() == 3
    assert fact.select("review_month").distinct().count() == 2
    users = {r["user_id"]: r["total_spent"] for r in read(f"{root}/marts/dim_users").collect()}
    assert users == {"u": 10.0, "v": 5.0}
    assert read(f"{root}/marts/dim_time").count() == 11_688
    _run(root, "--dedup")
    assert read(f"{root}/marts/fct_reviews").count() == 2


def test_staging_with_a_ledger(spark, landed, capsys):
    root, _ = landed
    out = f"{root}/review"

    def run():
        stage_reviews.main(["--input", f"{root}/reviews/*.jsonl.gz", "--output", out, "--ledger", f"{root}/ledger"])
        spark.catalog.refreshByPath(out)
        return capsys.readouterr().out.strip().splitlines()[-1], spark.read.parquet(out).count()

    def archive(name, n):
        with gzip.open(root / "reviews" / name, "wt") as file:
            file.writelines(json.dumps({"rating": 1.0, "timestamp": i}) + "\n" for i in range(n))

    assert run() == ("archives staged: 1", 4)
    assert run() == ("archives staged: 0", 4)
    archive("New one.jsonl.gz", 7)
    assert run() == ("archives staged: 1", 11)
    # A changed archive replaces its own rows; an empty one is not read again.
    archive("New one.jsonl.gz", 9)
    archive("Empty.jsonl.gz", 0)
    assert run() == ("archives staged: 2", 13)
    assert run() == ("archives staged: 0", 13)
    assert "archive" in spark.read.parquet(out).columns
    with pytest.raises(SystemExit):
        stage_reviews.main(["--input", "x", "--ledger", "y", "--partitions", "2"])


def test_a_broken_run_is_staged_again(spark, landed, monkeypatch):
    root, _ = landed
    scan = lambda paths: scan_reviews_json(spark, paths)
    stage = lambda raw: staging.stage_reviews(raw, ledger.ARCHIVE)
    args = (spark, f"{root}/reviews/*.jsonl.gz", f"{root}/review", f"{root}/ledger", scan)

    def broken(raw):
        return stage(raw).where(F.raise_error(F.lit("lost")).isNull())

    with pytest.raises(PySparkException):
        ledger.stage_pending(*args, broken)
    assert len(ledger.stage_pending(*args, stage)) == 1
    assert spark.read.parquet(f"{root}/review").count() == 4


def test_month_by_month(spark, landed):
    root, land = landed
    land("meta", [{"parent_asin": "a", "price": "$5.00", "main_category": "Toys"}])
    _run(root)
    whole = spark.read.parquet(f"{root}/marts/dim_users").collect()
    database = f"months_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    for first, last in (("1997-07-01", "1997-07-31"), ("1997-05-01", "1997-05-01")):
        load_months.main(
            ["--reviews", f"{root}/review", "--items", f"{root}/item", "--output", f"{root}/months"]
            + ["--database", database, "--first", first, "--last", last]
        )
    assert sorted(spark.table(f"{database}.dim_users").collect()) == sorted(whole)
    fact = incremental.fct_reviews(
        spark, f"{root}/months", spark.table(f"{database}.dim_items"), spark.table(f"{database}.dim_time")
    )
    assert fact.count() == 3 and fact.schema.fieldNames() == read_fact(spark, f"{root}/marts/fct_reviews").columns
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_shared_ids_are_named_and_kept(spark, landed, capsys):
    root, land = landed
    land("meta", [{"parent_asin": "a"}])
    with gzip.open(root / "reviews" / "Shifted.jsonl.gz", "wt") as out:
        for user, product in (("ab", "c"), ("a", "bc"), ("a", "bc")):
            out.write(json.dumps({"rating": 1.0, "timestamp": 0, "parent_asin": product, "user_id": user}) + "\n")
    _run(root, "--dedup")
    assert spark.read.parquet(f"{root}/marts/stg_reviews").count() == 3
    assert "keys in" not in capsys.readouterr().out
    _run(root, "--dedup", "--exact-keys")
    assert spark.read.parquet(f"{root}/marts/stg_reviews").count() == 4
    assert "2 keys in 3 reviews" in capsys.readouterr().out


def test_failing_key_checks_end_the_job(spark, landed):
    root, land = landed
    land("meta", [{"parent_asin": "a"}, {"parent_asin": "a"}])
    with pytest.raises(SystemExit, match="dim_items.asin: unique fails 1 times"):
        _run(root)
    assert not (root / "marts" / "fct_reviews").exists()


def test_calendar_bounds_holidays_and_missing_values(spark, landed):
    root, land = landed
    land("meta", [{"parent_asin": "a", "price": None, "main_category": None}])
    (root / "holidays.csv").write_text("date,name\n1997-05-19,Whit Monday\n")
    _run(
        root, "--first-day", "1997-05-01", "--last-day", "1997-05-31",
        "--holidays", f"{root}/holidays.csv", "--missing-price", "2.5", "--missing-category", "Other",
    )
    days = spark.read.parquet(f"{root}/marts/dim_time")
    assert days.count() == 31
    assert [(r["date_day"].day, r["holiday_name"]) for r in days.where("is_holiday").collect()] == [(19, "Whit Monday")]
    fact = spark.read.parquet(f"{root}/marts/fct_reviews").collect()
    assert {(r["price"], r["category"]) for r in fact} == {(2.5, "Other")}
    assert {r["user_id"]: r["review_date"] is not None for r in fact} == {"u": True, "v": False}


def test_quarantine_and_reports(spark, landed, capsys):
    root, land = landed
    with gzip.open(root / "reviews" / "More.jsonl.gz", "wt") as out:
        out.write('{"rating": 4.0\n{"rating": "x", "timestamp": 1}\n{"rating": 1.0, "timestamp": 9223372036854775807}\n')
    whole = gzip.compress(b'{"rating": 2.0, "timestamp": 2}\n' * 50_000)
    (root / "reviews" / "Cut.jsonl.gz").write_bytes(whole[: len(whole) // 2])
    stage_reviews.main(
        ["--input", f"{root}/reviews/*.jsonl.gz", "--output", f"{root}/review", "--skip-broken-files"]
    )
    said = capsys.readouterr().out
    assert "Cut.jsonl.gz" in said and "More" not in said
    (root / "reviews" / "Cut.jsonl.gz").unlink()
    stage_reviews.main(
        ["--input", f"{root}/reviews/*.jsonl.gz", "--output", f"{root}/review", "--quarantine", f"{root}/bad"]
    )
    said = capsys.readouterr().out
    assert "unparseable lines: 1" in said and "mistyped lines: 1" in said
    assert "reviews: 6, with a time out of range: 1" in said
    assert spark.read.parquet(f"{root}/bad").count() == 2


def test_build_leaves_no_intermediate_tables_and_dedups_once(spark, landed, tmp_path):
    from reviewmart.workspace import shared_folder

    root, land = landed
    land("meta", [{"parent_asin": "a", "price": "$5.00"}])
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    _run(root, "--dedup")
    assert set(os.listdir(folder)) == before
    assert spark.read.parquet(f"{root}/marts/stg_reviews").count() == 2
    plan = spark.table("stg_reviews")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_file_size_of_the_staging_jobs(spark, landed, conf):
    root, land = landed
    advised = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    conf(**{advised.replace(".", "__"): "64MB"})
    land("meta", [{"parent_asin": "a"}])
    stage_items.main(
        ["--input", f"{root}/meta/*.jsonl.gz", "--output", f"{root}/item", "--file-bytes", "1GB"]
    )
    assert spark.conf.get(advised) == "1GB"
    assert spark.read.parquet(f"{root}/item").count() == 1
