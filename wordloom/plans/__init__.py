"""Operators combined: one DataFrame feeds the next, with no file between."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wordloom.operators import (
    cooccurrence_pairs,
    document_frequency,
    tf_idf,
    top_terms,
    top_words,
    word_count,
)
from wordloom.operators.frequency import DEFAULT_DOCUMENTS
from wordloom.sources.wordlists import FEW_WORDS


def is_few(k: int) -> bool:
    """Whether a top-k list is small by its limit, without counting it."""
    return k <= FEW_WORDS


def frequent_words(docs: DataFrame, k: int = 50, stopwords=None) -> DataFrame:
    """``(word, cnt)``: the ``k`` most frequent words that are no stopwords."""
    return top_words(word_count(docs, stopwords), k)


def frequent_word_pairs(
    docs: DataFrame, distance: int, k: int = 50, stopwords=None, **options
) -> DataFrame:
    """Co-occurrence among the ``k`` most frequent words."""
    vocabulary = frequent_words(docs, k, stopwords).select("word")
    return cooccurrence_pairs(docs, distance, vocabulary, small_lists=is_few(k), **options)


def frequent_term_scores(
    docs: DataFrame,
    k: int = 100,
    stopwords=None,
    n_documents: int = DEFAULT_DOCUMENTS,
    one_row_per_document: bool = False,
) -> DataFrame:
    """TF-IDF of every document for the ``k`` terms of highest document frequency."""
    table = document_frequency(docs, stopwords, one_row_per_document=one_row_per_document)
    return tf_idf(docs, top_terms(table, k), n_documents, small_table=is_few(k))
