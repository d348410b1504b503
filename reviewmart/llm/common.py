"""Conventions all training-data operators share.

An operator takes a DataFrame and the names of the columns it works on. It returns the input row
in one struct column, ``doc``, beside its own columns, so that input columns may have any names.
A null text counts as the empty text unless the operator says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space; everything else belongs to words.
SPACES = " \t\n\x0b\x0c\r"
_SPACE_RUN = r"[\x20\x09-\x0D]+"
# A word with what follows it up to the next.
_WORD = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def as_doc(df: DataFrame) -> Column:
    """The whole input row as the struct column ``doc``."""
    return F.struct(*(df[f"`{name}`"] for name in df.columns)).alias("doc")


def text_of(df: DataFrame, name: str) -> Column:
    return F.coalesce(df[f"`{name}`"], F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Maximal runs without ASCII white space, in order."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, _SPACE_RUN)
    )


def n_words(text: Column) -> Column:
    """How many words there are, without making them: each becomes one character."""
    marks = F.regexp_replace(F.ltrim(text, F.lit(SPACES)), _WORD, "x")
    return F.length(marks).cast("long")


def count_of(text: Column, characters: str) -> Column:
    """How many code points of ``text`` are among ``characters``, which are ASCII.

    Runs of them are replaced: translate() makes a string of every character of the text.
    """
    runs = "[" + "".join(f"\\x{ord(c):02X}" for c in characters) + "]+"
    return (F.length(text) - F.length(F.regexp_replace(text, runs, ""))).cast("long")


def drawn(key: Column, share: float) -> Column:
    """Whether a row is among the given share of all, by a hash of ``key`` alone."""
    return F.pmod(F.xxhash64(key, F.lit("drawn")), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))
