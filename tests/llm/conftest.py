import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from samples import CLASHING, SF, TEXTS  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls everywhere, empty and very long texts, repeats and clashing names."""
    rows = [(i, text, "src0" if i % 3 else None, None) for i, text in enumerate(TEXTS)]
    rows += [(None, "nobody knows this one", None, "en"), (3, "one", "src1", "en"), (3, "one", "src1", "en")]
    names = CLASHING.split()
    wide = [(*row, *([7] * len(names))) for row in rows]
    schema = "doc_id long, text string, source string, lang string, " + ", ".join(f"{n} int" for n in names)
    return spark.createDataFrame(wide, schema).repartition(4)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
