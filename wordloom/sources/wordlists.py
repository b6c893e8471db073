"""Stopword lists and vocabularies: one-column DataFrames ``(word)`` without duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.text import strip_controls

# A short English list for examples and checks. Real lists are read from files.
SHORT_STOPWORDS = """
a an and are as at be but by for from had has have he her his in is it its not of on or she
that the their they this to was were which with you
""".split()

# Up to this many words an expression may hold as a literal; larger lists are joined.
LITERAL_WORDS = 10_000

# What counts as a small list.
FEW_WORDS = 100_000
FEW_BYTES = 16 << 20


def parse_stopwords(lines: DataFrame, column: str = "line") -> DataFrame:
    """One word per line, trimmed and lower-cased; blank lines are skipped."""
    word = F.lower(strip_controls(column))
    return lines.select(word.alias("word")).where(F.col("word") != "").distinct()


def parse_vocabulary(lines: DataFrame, column: str = "line") -> DataFrame:
    """The first field of each line, lower-cased; what follows white space (a count) is ignored.

    A line that starts with white space has an empty first field and gives no word.
    """
    word = F.lower(strip_controls(F.split(column, r"\s+", 2)[0]))
    return lines.select(word.alias("word")).where(F.col("word") != "").distinct()


def read_stopwords(spark: SparkSession, path) -> DataFrame:
    return parse_stopwords(spark.read.text(path), "value")


def read_vocabulary(spark: SparkSession, path) -> DataFrame:
    return parse_vocabulary(spark.read.text(path), "value")


def read_checked_vocabulary(spark: SparkSession, path) -> DataFrame:
    """A vocabulary, read once to see that it holds a word; ``ValueError`` if not."""
    return require_words(read_vocabulary(spark, path), f"vocabulary {path}")


def require_words(words: DataFrame, what: str = "vocabulary") -> DataFrame:
    """``words``, if a job finds a row in it; ``ValueError`` otherwise."""
    if words.isEmpty():
        raise ValueError(f"{what} is empty")
    return words


def word_set(spark: SparkSession, words: Sequence[str]) -> DataFrame:
    """A word list given in code.

    A short one is a literal, which the optimizer takes for small and broadcasts; one of more
    than ``LITERAL_WORDS`` becomes a table of unknown size, which it does not.
    """
    distinct = sorted({w for w in words if w})
    if not distinct or len(distinct) > LITERAL_WORDS:
        return spark.createDataFrame([(w,) for w in distinct], "word string")
    return spark.range(1).select(F.explode(F.lit(distinct)).alias("word"))


def are_few(words: DataFrame | Sequence[str]) -> bool:
    """Whether a list given in code is small in rows and bytes; a DataFrame's size is not known."""
    if isinstance(words, DataFrame) or len(words) > FEW_WORDS:
        return False
    return sum(len(w.encode()) for w in words) <= FEW_BYTES


def as_words(spark: SparkSession, words: DataFrame | Sequence[str]) -> DataFrame:
    """A word list given in either form, as a DataFrame."""
    return words if isinstance(words, DataFrame) else word_set(spark, words)
