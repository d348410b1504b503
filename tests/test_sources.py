import gzip
import json

import pytest
from pyspark.sql import functions as F

from reviewmart.operators.rows import resolve_ts_column, valid_reviews
from reviewmart.plans.staging import stage_items, stage_reviews
from reviewmart.schemas import RAW_ITEM, RAW_REVIEW, RAW_REVIEW_ANY_TIME, STAGED_ITEM, STAGED_REVIEW
from reviewmart.sources import readers, writers


@pytest.fixture
def raw(tmp_path):
    def write(name, *lines):
        with gzip.open(tmp_path / name, "wt") as out:
            out.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)
        return str(tmp_path / "*.jsonl.gz")

    return write


def test_malformed_line_is_all_null_and_later_dropped(spark, raw):
    path = raw("a.jsonl.gz", "{broken", {"rating": 5.0, "timestamp": 1500, "extra": 1})
    raw("b.jsonl.gz", {"rating": "bad", "timestamp": 2500, "asin": "x"})
    scanned = readers.scan_reviews_json(spark, path)
    rows = sorted(scanned.collect(), key=str)
    assert scanned.schema == RAW_REVIEW
    assert len(rows) == 3
    assert [row for row in rows if all(value is None for value in row)]
    assert [row["asin"] for row in rows if row["timestamp"] == 2500] == ["x"]
    assert valid_reviews(stage_reviews(scanned)).count() == 1


def test_item_types(spark, raw):
    path = raw(
        "i.jsonl.gz",
        {"parent_asin": "a", "price": 12.5, "categories": ["x", "y"], "rating_number": "12"},
        {"parent_asin": "b", "price": 5, "categories": [["x"]], "average_rating": "bad"},
        {"parent_asin": "c", "price": None, "categories": []},
    )
    rows = {row["parent_asin"]: row for row in readers.scan_items_json(spark, path).collect()}
    assert [rows[k]["price"] for k in "abc"] == ["12.5", "5", None]
    assert [rows[k]["categories"] for k in "abc"] == [None, [["x"]], []]
    assert rows["a"]["rating_number"] is None
    assert rows["b"]["average_rating"] is None
    assert stage_items(readers.scan_items_json(spark, path)).schema == STAGED_ITEM


def test_either_time_column(spark, raw):
    path = raw(
        "t.jsonl.gz",
        {"rating": 1, "sort_timestamp": 1000, "timestamp": 2000},
        {"rating": 2, "timestamp": 3000},
    )
    scanned = readers.scan_reviews_json(spark, path, RAW_REVIEW_ANY_TIME)
    staged = stage_reviews(scanned)
    assert [f.name for f in staged.schema] == STAGED_REVIEW.fieldNames()
    assert staged.dtypes == [(f.name, f.dataType.simpleString()) for f in STAGED_REVIEW]
    assert {r["timestamp_ms"] for r in staged.collect()} == {1000, 3000}
    with pytest.raises(ValueError, match="timestamp"):
        resolve_ts_column(scanned.drop("timestamp", "sort_timestamp"))


def test_truncated_archive_can_be_passed_over(spark, raw, tmp_path):
    path = raw("good.jsonl.gz", {"rating": 1.0, "timestamp": 1})
    whole = gzip.compress(b'{"rating": 2.0, "timestamp": 2}\n' * 50_000)
    (tmp_path / "cut.jsonl.gz").write_bytes(whole[: len(whole) // 2])
    kept = readers.scan_reviews_json(spark, path, skip_broken_files=True)
    assert kept.where("rating = 1").count() == 1
    with pytest.raises(Exception, match="(?i)unexpected end|EOF|FAILED_READ"):
        readers.scan_reviews_json(spark, path).collect()


def test_corrupt_lines_are_set_aside_with_their_file(spark, raw):
    path = raw("q.jsonl.gz", "{broken", "", "[1]", {"rating": 4.0, "timestamp": 7}, {"rating": "bad", "asin": "x"})
    good, bad = readers.split_corrupt(spark, path, RAW_REVIEW)
    assert good.schema.fieldNames() == RAW_REVIEW.fieldNames()
    assert {(r["timestamp"], r["asin"]) for r in good.collect()} == {(7, None), (None, "x")}
    lines = {r["line"]: (r["reason"], r["file"]) for r in bad.collect()}
    assert {line: reason for line, (reason, _) in lines.items()} == {
        "{broken": "unparseable",
        "[1]": "unparseable",
        '{"rating": "bad", "asin": "x"}': "mistyped",
    }
    assert all(name.endswith("q.jsonl.gz") for _, name in lines.values())


def test_items_with_flat_categories_stay(spark, raw):
    path = raw("i.jsonl.gz", *({"parent_asin": k, "price": 5, "categories": ["x", "y"]} for k in "abc"))
    good, bad = readers.split_corrupt(spark, path, RAW_ITEM)
    key = lambda r: str(r)
    assert sorted(good.collect(), key=key) == sorted(readers.scan_items_json(spark, path).collect(), key=key)
    assert [r["reason"] for r in bad.collect()] == ["mistyped"] * 3


def test_broken_files_are_named(spark, raw, tmp_path):
    path = raw("good.jsonl.gz", {"rating": 1.0})
    whole = gzip.compress(b'{"rating": 2.0}\n' * 50_000)
    (tmp_path / "cut.jsonl.gz").write_bytes(whole[: len(whole) // 2])
    assert [name.rsplit("/", 1)[1] for name in readers.broken_files(spark, path)] == ["cut.jsonl.gz"]


@pytest.mark.parametrize("partitions", [None, 3])
def test_staged_sinks_overwrite(spark, tmp_path, partitions):
    path = str(tmp_path / "out")
    for rows in (500, 200):
        writers.write_reviews_parquet(spark.range(rows).toDF("x"), path, partitions)
    assert readers.scan_parquet(spark, path).count() == 200
    if partitions:
        assert len(list((tmp_path / "out").glob("*.parquet"))) == partitions
    writers.write_items_parquet(spark.range(7).toDF("x"), path, partitions)
    assert readers.scan_parquet(spark, path).count() == 7


def test_repartition_spreads_one_partition(spark):
    one = spark.range(0, 1000, 1, 1)
    assert writers.repartition(one, 5).rdd.getNumPartitions() == 5
    assert writers.repartition(one).count() == 1000


@pytest.mark.parametrize("permanent", [False, True])
def test_external_table_reads_in_place(spark, tmp_path, permanent):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    name = f"outside_{permanent}".lower()
    for _ in range(2):  # naming it again replaces the name only
        readers.external_table(spark, name, path, permanent)
        assert spark.table(name).count() == 3
    spark.sql(f"DROP {'TABLE' if permanent else 'VIEW'} {name}")
    assert spark.read.parquet(path).count() == 3


def test_view_is_lazy_and_table_is_a_full_refresh(spark, tmp_path):
    path = str(tmp_path / "src")
    spark.range(3).write.parquet(path)
    view = writers.materialize_view(spark.read.parquet(path).select(F.col("id") * 2), "doubled")
    assert view.count() == spark.table("doubled").count() == 3
    table = str(tmp_path / "table")
    assert writers.materialize_table(spark.range(9), table).count() == 9
    assert writers.materialize_table(spark.range(4), table).count() == 4


def test_external_table_spares_a_table_with_own_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    spark.range(5).write.saveAsTable("owning")
    with pytest.raises(ValueError, match="owning"):
        readers.external_table(spark, "owning", path, permanent=True)
    assert spark.table("owning").count() == 5
    spark.sql("DROP TABLE owning")
