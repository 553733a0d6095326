"""A corpus for training: five stages, each over all that the one before kept.

Every stage but the last returns the columns of ``documents``. Its decisions take effect: rejected, near
copied and contaminated documents go, repeated passages are cut out of their texts, and the last
stage returns token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from girder.llm import byte_bpe, decontaminate, language_id, near_copies, repeats, word_windows
from girder.llm.common import deleted, held_out, importable, table, tidied, written

#: A passage that no two texts may share: over 50 words, or so many bytes (some 45 words).
PASSAGE_WORDS = 51
PASSAGE_WORDS_GRAM = 17
PASSAGE = 280
PASSAGE_GRAM = 96


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with calibrated confidence.

    Null and empty texts and those without a letter are rejected. A very long text is judged whole. Equal rows
    are judged alike. An empty table stays empty. Extra columns stay under any names, also below.
    """
    importable(spark)
    tidied(spark)
    model = language_id.learn(docs, ~held_out())
    tidied(spark)
    return language_id.accepted(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, likeness 0.8.

    The smallest doc_id stays, a null one only if the group has no other; of equal rows any one. Null, empty and
    blank texts are copies of each other. Very long texts are compared whole.
    """
    importable(spark)
    tidied(spark)
    return near_copies.one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also stand elsewhere; n_chars is that of what is left.

    All holders of a passage lose it, equal rows all their text if it is long enough. A null text stays null,
    with null n_chars; a text without repeats is unchanged. Very long texts are searched whole.
    """
    importable(spark)
    tidied(spark)
    short = word_windows.repeated_spans(docs, PASSAGE_WORDS, PASSAGE_WORDS_GRAM)
    tidied(spark)
    cut = repeats.without_repeats(docs, more=short, window=PASSAGE, gram=PASSAGE_GRAM)
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item overlaps.

    Null and empty texts overlap nothing and stay, as all do if the benchmark is empty. Equal rows share their
    verdict. Very long texts are searched whole.
    """
    importable(spark)
    tidied(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian, four bytes each) and the hash of what they decode to.

    One row for each row, equal ones too; a null text has no ids. Very long texts are encoded whole.
    """
    importable(spark)
    tidied(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    kept = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    made = byte_bpe.decode(byte_bpe.encode(kept, path), path)
    return made.select(
        F.col("id").alias("doc_id"), "n_tokens", "ids", F.sha2("decoded", 256).alias("text_sha256")
    )


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("passages", passages),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: No stage but the last could be stated in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again; what a stage has read
    is deleted once its result is written."""
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        deleted(read)
        read = docs
    return docs
