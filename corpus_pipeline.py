"""From raw documents to token ids: quality rules, near duplicates, benchmark leaks, secrets, tokens.

Each stage takes what its predecessor kept, all of it, and all but the last return the columns of
``documents``. The table may hold repeated or null ids; the stages' own docstrings say what becomes
of them: a stage drops rows by id, so rows of one id share its fate, and rows without id are dropped
only by their own quality.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import (
    decontaminate,
    near_dedup,
    quality_rules,
    secrets,
    sentencepiece_codec,
)
from wordloom.llm.shared import fresh_path, settled

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id is in ``gone`` (doc_id)."""
    out = gone.select(F.col("doc_id").alias("_gone")).where("_gone is not null").distinct()
    left = docs.select(*COLUMNS)
    return left.join(out, left.doc_id == F.col("_gone"), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Of rows of one id, each must be kept."""
    gone = settled(quality_rules.judge(docs).where("not kept").select("doc_id"), "rejected")
    kept = _without(docs, gone)
    # without an id a row cannot be looked up; it stays if it passes the fixed rules by itself
    if gone.where("doc_id is null").isEmpty():
        return kept
    text = F.coalesce("text", F.lit(""))
    words = quality_rules.words_of(text)
    own_failed = (F.size(words) < quality_rules.MIN_WORDS) | (
        100 * quality_rules.repeated_words(words) > quality_rules.REPEAT_PERCENT * F.size(words)
    )
    return kept.where(F.col("doc_id").isNotNull() | ~own_failed)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id."""
    return _without(docs, near_dedup.near_duplicates(docs).where("not kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontaminate.leaks(docs, benchmark))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in them masked."""
    return secrets.redact(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of every document."""
    return sentencepiece_codec.encode(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip"
    )


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scan", secret_scan),
    ("tokens", tokens),
]

#: Robust estimates, sketches and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = fresh_path(spark, f"stage-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
