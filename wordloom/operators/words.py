"""Tokens, word counts and the most frequent words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.text import token_array
from wordloom.sources.wordlists import as_words


def tokens(texts: DataFrame, tokenizer: str, text: str = "text", keep=()) -> DataFrame:
    """One row per token: the columns ``keep`` and ``word``.

    ``explode_outer`` here, as everywhere in this package: for a plain ``explode`` the optimizer
    adds a filter that the array is not empty, which tokenizes every text a second time, and
    below any repartitioning. The filter on the token removes the outer rows as well.
    """
    exploded = texts.select(*keep, F.explode_outer(token_array(text, tokenizer)).alias("word"))
    return exploded.where(F.col("word") != "")


def _listed(rows: DataFrame, words) -> DataFrame:
    return as_words(rows.sparkSession, words).select(F.col("word").alias("listed_word"))


def drop_words(rows: DataFrame, words, column: str = "word") -> DataFrame:
    """Rows whose ``column`` is not in the list; rows with a NULL there stay.

    Spark broadcasts a list under ``spark.sql.autoBroadcastJoinThreshold``, by its known size or
    by what adaptive execution measures, and joins a larger one by shuffle, splitting hot words.
    """
    return rows.join(_listed(rows, words), F.col(column) == F.col("listed_word"), "left_anti")


def keep_words(rows: DataFrame, words, column: str = "word") -> DataFrame:
    """Rows whose ``column`` is in the list; joined as in ``drop_words``."""
    return rows.join(_listed(rows, words), F.col(column) == F.col("listed_word"), "left_semi")


def token_counts(texts: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``(word, cnt)`` over all tokens."""
    return tokens(texts, tokenizer, text).groupBy("word").agg(F.count("*").alias("cnt"))


def word_count(
    texts: DataFrame, stopwords=None, tokenizer: str = "trim_punct", text: str = "text"
) -> DataFrame:
    """``(word, cnt)`` without stopwords.

    The stopword join is stated on the counts. Spark moves it below the aggregate when the
    list is small enough to broadcast; otherwise it joins one row per distinct word, so a hot
    word never makes a hot join key.
    """
    counts = token_counts(texts, tokenizer, text)
    return counts if stopwords is None else drop_words(counts, stopwords)


def top_words(counts: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` most frequent words; ties go to the smaller word."""
    return counts.orderBy(F.desc("cnt"), F.asc("word")).limit(k)
