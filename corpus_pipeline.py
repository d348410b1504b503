"""From raw documents to token ids: five stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read back as the next stage's ``docs``. All but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.llm import bpe, mixing, quality_rules, secret_scan, simhash
from reviewmart.llm.common import as_doc, documents
from reviewmart.workspace import cut, run_folder

SHINGLE = 3
MAX_BITS = 3


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that the fixed limits or the learned rules reject.

    Null and empty texts have too few words and go. Repeated rows share a verdict; rules are learned
    from the rows' labels, each row counting once, and without labels only the limits decide.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    measured = cut(quality_rules.measures(docs), "quality-documents")
    rules = quality_rules.fit(quality_rules.labelled(measured, labels))
    return quality_rules.judge(measured, rules).where("kept").select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: the one with the smallest id.

    Null and empty texts are near-duplicates of each other. Of rows alike, or with one id, one stays.
    """
    marked = cut(
        docs.select(
            as_doc(docs),
            F.col("doc_id").alias("id"),
            simhash.fingerprint(F.col("text"), SHINGLE).alias("fingerprint"),
        ),
        "simhash-documents",
    )
    return simhash.kept_rows(marked, MAX_BITS).select("doc.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put live secrets out of the texts; ``n_chars`` follows the text.

    Null and empty texts stay as they are, and so does a row without a live secret, null ``n_chars``
    included. Repeated rows are changed alike.
    """
    scanned = secret_scan.scan(docs)
    text = secret_scan.redact(F.col("doc.text"), F.col("secrets"))
    changed = F.exists("secrets", lambda s: s["live"])
    fresh = {
        "text": text,
        "n_chars": F.when(changed, F.length(text)).otherwise(F.col("doc.n_chars")).cast("long"),
    }
    return scanned.select(
        *(fresh.get(name, F.col(f"doc.`{name}`")).alias(name) for name in docs.columns)
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and leave out documents so that sources meet their targets.

    A null source is one of its own. Null and empty texts have no size and are repeated as often as
    their source is whole, 0 times where that is less than once or the source has no words at all;
    of rows alike, as many as the target takes.
    """
    return mixing.repeated(mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document; none for a null or empty text. Repeated rows stay repeated."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return bpe.with_ids(docs.select("doc_id", "source", "text"), "text", vocabulary)


STAGES = [
    ("quality rules", reject_low_quality),
    ("simhash near-duplicates", drop_near_duplicates),
    ("secret scan", redact_secrets),
    ("source mixing", mix_sources),
    ("byte-pair encoding", encode),
]

# Learned rules and fingerprints are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; of what they write, only the last one's rows stay."""
    docs, last = documents(spark, sf_dir), STAGES[-1][0]
    with run_folder(spark):
        for name, stage in STAGES:
            label = "pipeline-" + name.replace(" ", "-")
            docs = cut(stage(spark, docs, sf_dir), label, lasting=name == last)
    return docs
