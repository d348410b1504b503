"""The review's surrogate key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def review_id(user_id: Column, parent_asin: Column, ts: Column) -> Column:
    """MD5 of user, product family and time text, as bytes.

    Missing parts count as empty text and there is no separator, so two reviews by one user
    of one product in one second share a key.
    """
    time_text = F.concat(ts.cast("string"), F.lit("+00"))
    parts = [F.coalesce(part, F.lit("")) for part in (user_id, parent_asin, time_text)]
    return F.unhex(F.md5(F.concat(*parts)))


def exact_review_key(user_id: Column, parent_asin: Column, ts: Column) -> Column:
    """MD5 that tells apart what ``review_id`` does not: each part with its length, missing ones apart."""
    parts = [
        F.coalesce(F.concat(F.char_length(part).cast("string"), F.lit(":"), part), F.lit("-"))
        for part in (user_id, parent_asin, ts.cast("string"))
    ]
    return F.unhex(F.md5(F.concat(*parts)))


def review_id_hex(key: Column) -> Column:
    """The key as lower-case hexadecimal text."""
    return F.lower(F.hex(key))
