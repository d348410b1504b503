"""Key checks, schema contracts and column profiles, each returned as a small table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewmart.schemas import KEYS


def _verdict(failures: DataFrame, check: str, model: str, column: str) -> DataFrame:
    return failures.agg(F.count("*").alias("failures")).select(
        F.lit(check).alias("check"),
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        "failures",
    )


def check_not_null(df: DataFrame, model: str, column: str) -> DataFrame:
    """Counts rows whose key is missing; 0 passes."""
    return _verdict(df.where(F.col(column).isNull()), "not_null", model, column)


def check_unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Counts key values that occur more than once; 0 passes."""
    repeated = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )
    return _verdict(repeated, "unique", model, column)


def check_key(df: DataFrame, model: str, column: str) -> DataFrame:
    """Both checks in one pass over ``df``."""
    key, n = F.col(column), F.col("n")
    found = df.groupBy(key).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.when(key.isNull(), n)), F.lit(0)).alias("not_null"),
        F.count_if(key.isNotNull() & (n > 1)).alias("unique"),
    )
    verdicts = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(model).alias("model"),
            F.lit(column).alias("column_name"),
            F.col(check).alias("failures"),
        )
        for check in ("not_null", "unique")
    ]
    return found.select(F.inline(F.array(*verdicts)))


def check_keys(models: dict[str, DataFrame]) -> DataFrame:
    """Both checks on every declared key among ``models``."""
    checks = [
        check_key(models[model], model, column)
        for model, column in KEYS.items()
        if model in models
    ]
    return reduce(DataFrame.unionAll, checks)


def schema_contract(df: DataFrame, model: str, expected: StructType) -> DataFrame:
    """Declared against actual type of each column; reads no rows.

    A column that is missing, or not declared, has a null on that side.
    """
    declared = {field.name: field.dataType.simpleString() for field in expected}
    actual = dict(df.dtypes)
    rows = [
        (model, name, declared.get(name), actual.get(name), declared.get(name) == actual.get(name))
        for name in [*declared, *(extra for extra in actual if extra not in declared)]
    ]
    schema = "model string, column_name string, expected_type string, actual_type string, ok boolean"
    return df.sparkSession.createDataFrame(rows, schema)


def model_rows(models: dict[str, DataFrame]) -> DataFrame:
    """How many rows each model has."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("model"), "row_count")
        for name, df in models.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def require_schema(df: DataFrame, expected: StructType) -> DataFrame:
    """``df`` unchanged, or a ``ValueError`` naming the columns that break the contract."""
    want = [(field.name, field.dataType.simpleString()) for field in expected]
    broken = set(want) ^ set(df.dtypes)
    if broken:
        raise ValueError(f"schema contract broken for {sorted({name for name, _ in broken})}")
    return df


def profile(df: DataFrame) -> DataFrame:
    """Type, row count and filled-value count of each column, in one pass."""
    counts = [F.count(F.col(name)).alias(f"n{i}") for i, name in enumerate(df.columns)]
    totals = df.agg(F.count("*").alias("row_count"), *counts)
    columns = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col("row_count"),
            F.col(f"n{i}").alias("filled"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return totals.select(F.inline(F.array(*columns)))
