"""Tests of a word against a list, for use inside a row.

A list that is not written into the plan is one value of it, read once by a scalar subquery. Such a value may not
stand inside a higher-order function, so that a test comes in two parts: ``value``, to be selected as a column
first, and ``holds(value, word)``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.sources.wordlists import as_words

#: Up to so many words of a list given in code stand in the plan as a set.
SET_WORDS = 1_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


@dataclass(frozen=True)
class Listed:
    """A word list inside a row; ``value`` is None where the plan holds the words."""

    value: Column | None
    holds: Callable[[Column | None, Column], Column]


def are_in_code(words) -> bool:
    """Whether a list is given in code and short enough for a set in the plan."""
    return words is not None and not isinstance(words, DataFrame) and len(words) <= SET_WORDS


def literal_list(words) -> Listed:
    """A list given in code, as a set that is built once."""
    listed = sorted({w for w in words if w})
    return Listed(None, lambda _, word: word.isin(listed) if listed else F.lit(False))


def short_list(words: DataFrame) -> Listed:
    """A short DataFrame ``(word)``: an array of buckets, as many as the root of its length, by a hash of the word."""
    rows = words.where(F.col("word").isNotNull()).select("word").distinct()
    listed = rows.agg(F.array_sort(F.collect_list("word")).alias("w"))

    def bucket(word: Column, n: Column) -> Column:
        return F.pmod(F.hash(word), n)

    def table(all_words: Column) -> Column:
        n = F.greatest(F.ceil(F.sqrt(F.size(all_words))), F.lit(1)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), n - 1), lambda b: F.filter(all_words, lambda w: bucket(w, n) == b)
        )

    buckets = listed.select(let(F.col("w"), table).alias("b")).scalar()
    return Listed(buckets, lambda b, word: F.array_contains(F.get(b, bucket(word, F.size(b))), word))


def in_row(spark, words) -> Listed:
    """A small list given in either form."""
    if are_in_code(words):
        return literal_list(words)
    return short_list(as_words(spark, words))
