import pytest
from pyspark.sql import functions as F

from reviewmart.operators import quality, rows
from reviewmart.schemas import DIM_ITEMS, MODELS, STG_ITEMS


def test_key_checks_count_rows_and_values(items):
    bad = items(("a", 1.0), ("a", 1.0), ("a", 2.0), ("b", 1.0), (None, 1.0), (None, 2.0))
    assert quality.check_not_null(bad, "dim_items", "asin").first()["failures"] == 2
    assert quality.check_unique(bad, "dim_items", "asin").first()["failures"] == 1
    both = quality.check_keys({"dim_items": bad, "stg_items": items(("a", 1.0))})
    assert {(r["model"], r["check"]): r["failures"] for r in both.collect()} == {
        ("stg_items", "not_null"): 0,
        ("stg_items", "unique"): 0,
        ("dim_items", "not_null"): 2,
        ("dim_items", "unique"): 1,
    }


def test_contract_names_what_differs(items):
    odd = items(("a", 1.0)).withColumn("price", F.col("price").cast("string")).drop("store")
    odd = odd.withColumn("colour", F.lit("red"))
    found = quality.schema_contract(odd, "dim_items", DIM_ITEMS).where("not ok").collect()
    assert {(r["column_name"], r["expected_type"], r["actual_type"]) for r in found} == {
        ("price", "double", "string"),
        ("store", "string", None),
        ("colour", None, "string"),
    }
    with pytest.raises(ValueError, match="colour.*price.*store"):
        quality.require_schema(odd, DIM_ITEMS)
    assert quality.require_schema(items(("a", 1.0)), STG_ITEMS).count() == 1
    assert set(MODELS) >= {"stg_reviews", "fct_reviews"}


def test_profile(items):
    found = {r["column_name"]: r for r in quality.profile(items(("a", None), (None, 2.0))).collect()}
    assert found["asin"]["row_count"] == 2
    assert (found["asin"]["filled"], found["price"]["filled"], found["title"]["filled"]) == (1, 1, 2)
    assert found["price"]["data_type"] == "double"


def test_missing_values_are_replaced_and_nan_is_not_missing(items):
    some = items(("a", None, None), ("b", float("nan"), "Toys"))
    filled = {r["asin"]: r for r in rows.handle_missing(some, {"price": 0.0, "category": "?"}).collect()}
    assert (filled["a"]["price"], filled["a"]["category"]) == (0.0, "?")
    assert str(filled["b"]["price"]) == "nan" and filled["b"]["category"] == "Toys"


def test_row_operators(spark):
    staged = spark.createDataFrame(
        [("Books", "a", "v1", [["x"]]), ("Books", "b", "v2", []), ("Toys", None, "v3", None)],
        "main_category string, parent_asin string, asin string, categories array<array<string>>",
    )
    assert [r[0] for r in rows.category_distinct(staged, "Books").collect()] == ["Books"]
    assert [r["parent_asin"] for r in rows.has_categories(staged).collect()] == ["a"]
    assert rows.rename_keys(staged).columns == ["category", "asin", "categories"]
    assert [r["asin"] for r in rows.rename_keys(staged).collect()] == ["a", "b", None]
    assert rows.distinct_values(staged, "main_category").count() == 2
    assert rows.row_count(staged).first()["row_count"] == 3
    assert rows.sample_rows(staged, 2).count() == 2
    assert rows.select_columns(staged, "asin").columns == ["asin"]


def test_slicer_leaves_unknown_flags_to_all(spark):
    flags = spark.createDataFrame([(True,), (False,), (None,)], "verified_purchase boolean")
    assert [rows.verified_slicer(flags, choice).count() for choice in (True, False, None)] == [1, 1, 3]
