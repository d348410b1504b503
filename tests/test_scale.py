"""That work is divided by its size and that queries do not read their input again and again."""

from datetime import date

import pytest

from reviewmart.checks import queries as registered
from reviewmart.checks import tables
from reviewmart.operators import joins
from reviewmart.plans import incremental, marts
from reviewmart.sources import writers

_REVIEWS = (
    "timestamp long, rating double, helpful_votes long, title string, text string, asin string, "
    "verified_purchase boolean, parent_asin string, user_id string"
)


@pytest.fixture
def many(spark, conf, monkeypatch):
    """Raw reviews that make more than three fair shuffle partitions."""
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="16k")
    made = spark.range(20_000).selectExpr(
        "id * 40000000 AS timestamp", "1.0D + id % 5 AS rating", "id AS helpful_votes",
        "if(id % 2 = 0, 'F', 'O') AS title", "CAST(NULL AS STRING) AS text",
        "concat('P', id % 97, '-', id) AS asin", "id % 3 = 0 AS verified_purchase",
        "concat('P', id % 97) AS parent_asin", "concat('U', id % 311) AS user_id",
    )
    monkeypatch.setattr(tables, "raw_reviews", lambda *_: made.to(spark.createDataFrame([], _REVIEWS).schema))


def _files(monkeypatch, holder, name):
    """Paths that a reading function is given while a query runs."""
    seen, real = [], getattr(holder, name)

    def noted(spark, paths, *rest, **named):
        seen.append(paths)
        return real(spark, paths, *rest, **named)

    monkeypatch.setattr(holder, name, noted)
    return seen


def test_deliveries_are_divided_by_their_size(spark, many, monkeypatch):
    seen = _files(monkeypatch, registered.readers, "scan_reviews_json")
    assert registered.queries()["staged_by_ledger"](spark, "").count() == 20_000
    assert len(seen) == 2 and all(len(paths) > 4 for paths in seen)


def test_a_growing_table_is_divided_by_its_size(spark, many, monkeypatch):
    seen = _files(monkeypatch, registered.profiles, "merged_profile")
    got = registered.queries()["merged_profile"](spark, "").collect()
    assert {row["row_count"] for row in got} == {20_000}
    assert len(spark.read.parquet(seen[0]).inputFiles()) > 5


def test_ranks_of_many_ranges_stay_compiled(spark):
    """A halving written as one expression per range was beyond what is compiled."""
    rows = [(f"u{i:04}" if i % 50 else None, f"p{i % 40:02}", i) for i in range(2000)]
    fact = spark.createDataFrame(rows, "user_id string, asin string, n long").selectExpr(
        "user_id", "asin", "timestamp_seconds(n) AS timestamp", "date'2020-01-01' AS review_month"
    )
    laid = writers.z_order_layout(fact)
    assert str(laid._jdf.queryExecution().optimizedPlan()).count("CASE WHEN") <= 2 * 6
    ranked = writers._ranked(fact, "user_id", "_rank", 64)
    ranges = ranked.groupBy("_rank").count().orderBy("_rank").collect()
    assert [row["_rank"] for row in ranges] == list(range(64))
    bounds = ranked.where("user_id IS NOT NULL").groupBy("_rank").agg({"user_id": "min"}).orderBy("_rank")
    least = [row[1] for row in bounds.collect()]
    assert least == sorted(least)
    assert ranked.where("user_id IS NULL AND _rank <> 0").isEmpty()
    got, want = (sorted(map(str, df.collect())) for df in (laid, fact))
    assert got == want


@pytest.fixture
def stored(spark, tmp_path, monkeypatch):
    """Raw reviews and items as tables; returns whether a frame reads the raw reviews."""
    days = spark.range(3_000).selectExpr(
        "id * 100000000 + 631152000000 AS timestamp", "1.0D + id % 5 AS rating", "id AS helpful_votes",
        "'F' AS title", "CAST(NULL AS STRING) AS text", "concat('P', id % 97, '-', id) AS asin",
        "id % 3 = 0 AS verified_purchase", "concat('P', id % 97) AS parent_asin",
        "if(id % 50 = 0, NULL, concat('U', id % 311)) AS user_id",
    )
    days.write.parquet(str(tmp_path / "raw-lines"))
    items = spark.range(80).selectExpr(
        "concat('C', id % 3) AS main_category", "concat('P', id) AS parent_asin", "4.0D AS average_rating",
        "10.0D AS rating_number", "'$5.5' AS price", "array(array('a')) AS categories",
        "'t' AS title", "'s' AS store",
    )
    items.write.parquet(str(tmp_path / "raw-parts"))
    monkeypatch.setattr(tables, "raw_reviews", lambda *_: spark.read.parquet(str(tmp_path / "raw-lines")))
    monkeypatch.setattr(tables, "raw_items", lambda *_: spark.read.parquet(str(tmp_path / "raw-parts")))
    return lambda df: any("raw-lines" in path for path in df.inputFiles())


def _given(monkeypatch, holder, name):
    """The frames that a function is given first while a query runs."""
    seen, real = [], getattr(holder, name)

    def noted(df, *rest, **named):
        seen.append(df)
        return real(df, *rest, **named)

    monkeypatch.setattr(holder, name, noted)
    return seen


@pytest.mark.parametrize(
    "name",
    ["fct_x_item_avg", "fct_x_item_avg_shuffled", "rating_diff", "fct_reviews", "fct_reviews_shuffled", "dim_users"],
)
def test_reviews_read_twice_are_a_table(spark, stored, name):
    got = registered.queries()[name](spark, "")
    assert not stored(got)
    assert got.count() == (311 if name == "dim_users" else 3_000)


@pytest.mark.parametrize(
    "name, holder, step, rows",
    [
        ("fct_x_users_bucketed", writers, "bucketed_table", 3_000),
        ("loaded_category_share", writers, "load_fact", 4),
        ("fct_insert_overwrite", writers, "load_fact", None),
        ("fct_incremental", incremental, "load_months", 3_000),
        ("dim_users_incremental", incremental, "load_months", 311),
    ],
)
def test_what_is_written_comes_from_the_table(spark, stored, monkeypatch, name, holder, step, rows):
    seen = _given(monkeypatch, holder, step)
    got = registered.queries()[name](spark, "").count()
    assert seen and not any(map(stored, seen))
    assert rows is None or got == rows


@pytest.mark.parametrize("name", ["model_rows", "schema_contract"])
def test_models_are_made_of_saved_ones(spark, stored, monkeypatch, name):
    seen = _given(monkeypatch, writers, "materialize_table")
    registered.queries()[name](spark, "").collect()
    assert [stored(df) for df in seen] == [True] + 5 * [False]


def test_reviews_per_item_are_counted_once(spark, stored):
    m = registered.Models(spark, "")
    context = m.context("rating", attributes=["category"], limits=registered.SHUFFLED)
    assert not stored(context)
    assert context.agg({"n": "sum"}).first()[0] == 3_000


def test_reviews_of_known_averages_are_not_counted_again(spark, stored, monkeypatch):
    labels = _labels(monkeypatch)
    registered.queries()["fct_x_item_avg_shuffled"](spark, "")
    assert "rows-per-asin" not in labels and "heavy-asin" in labels


def _labels(monkeypatch):
    labels, real = [], joins.cut

    def noted(df, label, *rest, **named):
        labels.append(label)
        return real(df, label, *rest, **named)

    monkeypatch.setattr(joins, "cut", noted)
    return labels


def test_derived_columns_are_made_after_the_layout(spark, stored, tmp_path):
    m, laid = registered.Models(spark, ""), []

    def layout(fact, partitions):
        laid.append(fact.columns)
        return writers.cluster_layout(fact, partitions)

    fact = m.fct_reviews()
    writers.load_fact(fact, str(tmp_path / "fact"), layout=layout, derived=marts.fct_derived())
    assert not set(laid[0]) & {"review_id_power_bi", "rating_diff_from_avg"}
    loaded = writers.read_fact(spark, str(tmp_path / "fact"))
    assert sorted(map(str, loaded.collect())) == sorted(map(str, fact.collect()))


def test_months_of_user_products_are_not_summed_on_their_own(spark, stored, tmp_path, monkeypatch):
    m, out = registered.Models(spark, ""), str(tmp_path / "months")
    incremental.load_months(m.review_table, out, date(1990, 1, 1), date(2010, 12, 31))
    seen = _given(monkeypatch, incremental, "lookup")
    got = incremental.dim_users(spark, out, m.item_table)
    assert "Aggregate" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    shown = [sorted(map(str, df.select(sorted(df.columns)).collect())) for df in (got, m.dim_users())]
    assert shown[0] == shown[1]
