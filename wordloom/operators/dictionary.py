"""Stems by a dictionary: each distinct token of a corpus is stemmed once and joined back.

Prose repeats its tokens, so the dictionary is far smaller than the text. Spark broadcasts it if it turns out
small; otherwise tokens and dictionary are shuffled to each other, and a token of all documents is met in as
many places as there are slices, by a hash of the document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.porter import stem
from wordloom.functions.text import token_array
from wordloom.operators.words import drop_words

#: Copies of the dictionary that the tokens are dealt to.
SLICES = 16


def stem_dictionary(tokens: DataFrame, column: str = "token", slices: int = SLICES) -> DataFrame:
    """``(token, term, slice)``: the stem of every distinct token, once for each slice."""
    if slices < 1:
        raise ValueError("a dictionary has a slice at least")
    once = tokens.select(F.col(column).alias("token")).where(F.col("token").isNotNull()).distinct()
    stemmed = once.select("token", stem(F.col("token")).alias("term"))
    return stemmed.select("*", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))


def _translated(rows: DataFrame, slices: int) -> DataFrame:
    """Rows ``(doc_id, token, ...)`` with the token's stem as ``term`` in its place."""
    dictionary = stem_dictionary(rows, slices=slices)
    placed = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(slices)).cast("int"))
    return placed.join(dictionary, ["token", "slice"]).drop("token", "slice")


def document_terms_by_dictionary(
    docs: DataFrame,
    stopwords=None,
    tokenizer: str = "apostrophe",
    doc_id: str = "doc_id",
    text: str = "text",
    slices: int = SLICES,
) -> DataFrame:
    """``(doc_id, term)``, each stem once per document; rows as ``document_terms``."""
    distinct = F.array_distinct(token_array(text, tokenizer))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.explode_outer(distinct).alias("token"))
    rows = rows.where(F.col("token") != "")
    if stopwords is not None:
        rows = drop_words(rows, stopwords, "token")
    return _translated(rows, slices).distinct()


def document_frequency_by_dictionary(
    docs: DataFrame,
    stopwords=None,
    tokenizer: str = "apostrophe",
    doc_id: str = "doc_id",
    text: str = "text",
    slices: int = SLICES,
) -> DataFrame:
    """``(term, df)``; rows as ``document_frequency``."""
    terms = document_terms_by_dictionary(docs, stopwords, tokenizer, doc_id, text, slices)
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def term_frequency_by_dictionary(
    docs: DataFrame,
    df_table: DataFrame | None = None,
    tokenizer: str = "alpha",
    doc_id: str = "doc_id",
    text: str = "text",
    slices: int = SLICES,
) -> DataFrame:
    """``(doc_id, term, tf)``; rows as ``term_frequency``.

    Tokens are counted per document before they meet the dictionary, stems after it.
    """
    tokens = docs.select(F.col(doc_id).alias("doc_id"), F.explode_outer(token_array(text, tokenizer)).alias("token"))
    counts = tokens.where(F.col("token") != "").groupBy("doc_id", "token").agg(F.count("*").alias("n"))
    terms = _translated(counts, slices).groupBy("doc_id", "term").agg(F.sum("n").alias("tf"))
    if df_table is not None:
        terms = terms.join(df_table, "term", "left_semi")
    return terms.select("doc_id", "term", "tf")
