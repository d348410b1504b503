"""The numbered operators over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.llm import (
    bpe,
    embedding_dedup,
    language_id,
    lexical_search,
    mixing,
    pii,
    prefix_trie,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    token_files,
    toxicity,
)
from reviewmart.llm import spans as S
from reviewmart.llm.common import documents
from reviewmart.workspace import cut, fresh_path

SIMHASH_SHINGLE = 3
SIMHASH_BITS = 3


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise(documents(spark, sf_dir).select("doc_id", "text"))
    spans, kinds = F.col("spans"), pii.KINDS
    base = F.filter(spans, lambda s: s["kind"] != "term")
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        *(S.count_kind(spans, kind).alias(f"n_{kind}") for kind in kinds[:4]),
        F.sha2(S.listed(base, kinds, by_start=False), 256).alias("base_sha256"),
        S.listed(spans, kinds, by_start=False).alias("spans"),
        S.count_kind(spans, "term").alias("n_term"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard(documents(spark, sf_dir), shards=40)
    return sharded.select(
        F.col("doc.doc_id").alias("doc_id"),
        "size",
        F.crc32(F.coalesce("doc.text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write(documents(spark, sf_dir).select("doc_id", "text"), path, vocabulary, end=2)
    return token_files.read(spark, path, with_ids=False)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = embedding_dedup.link(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    vec_id = F.col("doc.vec_id")
    return linked.select(
        vec_id.alias("vec_id"), "n_links", "component_id", (vec_id == F.col("component_id")).alias("kept")
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    marked = cut(
        docs.select(
            F.col("doc_id").alias("id"),
            simhash.fingerprint(F.col("text"), SIMHASH_SHINGLE).alias("fingerprint"),
        ),
        "simhash",
    )
    groups = simhash.classes(marked, SIMHASH_BITS)
    return marked.join(groups, "fingerprint").select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.select("doc_id", toxicity.graded(F.col("text"), model).alias("graded")).select(
        "doc_id", "graded.*"
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return mixed.select(
        "doc.doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir).select("doc_id", "text", "source", "lang"))
    secrets, kinds = F.col("secrets"), secret_scan.KINDS
    base = F.filter(secrets, lambda s: s["kind"] != "random")
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        *(S.count_kind(secrets, kind).alias(f"n_{kind}") for kind in kinds[:3]),
        F.sha2(S.listed(base, kinds, by_start=True), 256).alias("base_sha256"),
        S.listed(secrets, kinds, by_start=True).alias("spans"),
        F.size(F.filter(secrets, lambda s: s["live"])).cast("long").alias("n_live"),
        *(S.listed(secrets, kinds, by_start=True, field=name).alias(name) for name in ("owners", "repositories")),
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return documents(spark, sf_dir).select(
        "doc_id", bpe.encoded(F.col("text"), vocabulary).alias("encoded")
    ).select("doc_id", "encoded.*")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    measured = cut(
        quality_rules.measures(docs).select(F.struct("doc.doc_id").alias("doc"), "m"),
        "quality-measures",
    )
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = quality_rules.fit(quality_rules.labelled(measured, labels))
    return quality_rules.judge(measured, rules).select(
        "doc.doc_id",
        *(f"m.{name}" for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        "base_failed",
        "kept",
        "rule",
    )


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs, learn=F.col("doc_id").isNotNull() & ~held_out)
    return docs.select(
        "doc_id", held_out.alias("held_out"), language_id.predicted(F.col("text"), model).alias("predicted")
    ).select("doc_id", "held_out", "predicted.*")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns, convs = prefix_trie.rebuilt(prefix_trie.ordered(rows))
    return prefix_trie.trie(turns, convs)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(
        documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_pii,
        op2_sharding,
        op3_token_files,
        op4_embedding_dedup,
        op5_simhash,
        op6_toxicity,
        op7_mixing,
        op8_secrets,
        op9_bpe,
        op10_quality_rules,
        op11_language_id,
        op12_prefix_trie,
        op13_lexical_search,
    )
    return {query.__name__: query for query in every}
