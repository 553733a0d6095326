"""The queries of this subpackage, each a thin use of its operator over the whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from girder.llm import (
    byte_bpe,
    decontaminate,
    fingerprints,
    language_id,
    oracles,
    repeats,
    sharding,
    simhash_links,
    token_files,
    toxicity,
    url_filter,
)
from girder.llm.common import held_out, table, written


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    found = decontaminate.overlaps(docs, benchmark)
    return found.groupBy(F.col("id").alias("doc_id"), F.col("item").alias("item_id")).agg(
        F.max(F.col("end") - F.col("start")).alias("overlap_words"),
        F.max("matches").alias("matches"),
        F.max("similarity").alias("similarity"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels, ~held_out())
    found = toxicity.score(docs, model)
    return found.select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = byte_bpe.encode(table(spark, sf_dir, "documents"), path)
    return byte_bpe.decode(ids, path).select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shards(table(spark, sf_dir, "documents"))
    return dealt.select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judge(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.learn(docs, ~held_out()))
    return found.select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    folder, files = token_files.write(table(spark, sf_dir, "documents"), definition, end_id=2)
    return token_files.read(folder, files).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc").alias("ids_crc32")
    )


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.removed(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_links.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = written(fingerprints.edited_fingerprints(docs), "fingerprints")
    # searched: the documents whose id is divisible by 20, against all
    asked = F.coalesce(F.col("id") % 20 == 0, F.lit(False))
    found = fingerprints.counts_within(rows, rows.filter(asked))
    counted = rows.filter(asked).join(found, "fp").unionByName(
        rows.filter(~asked).withColumn("n_within", F.lit(None).cast("long"))
    )
    hexed = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    return counted.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        hexed("fp").alias("fingerprint"),
        hexed("edited_fp").alias("edited_fingerprint"),
        fingerprints.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        fingerprints.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        "n_within",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_hilbert_sharding": op4_hilbert_sharding,
    "op5_url_filter": op5_url_filter,
    "op6_language_id": op6_language_id,
    "op7_token_files": op7_token_files,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_document_fingerprints": op10_document_fingerprints,
}
def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)
