"""Bloom filters over word lists: built by an aggregate, tested inside a row.

A filter is one value, an array of 64-bit numbers of a stated length, whatever the list's: a longer list only
lets more words through that are not in it. No listed word is ever rejected, so an exact join after the
filter gives the same rows as the join alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.operators.lists import Listed
from wordloom.operators.words import drop_words, keep_words
from wordloom.sources.wordlists import as_words

#: Numbers in a filter (1 MiB), and bits that a word sets: one word in 260 passes by chance at 600,000 listed.
SLOTS = 1 << 17
HASHES = 4


def _bits(word: Column, slots: int, hashes: int) -> list[Column]:
    """Positions of a word's bits, by the two halves of one hash."""
    h = F.xxhash64(word)
    first, step = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return [F.pmod(first + step * i if i else first, F.lit(slots * 64)) for i in range(hashes)]


def bloom_filter(words: DataFrame, column: str = "word", slots: int = SLOTS, hashes: int = HASHES) -> DataFrame:
    """One row ``(bits)``: the filter of the words in ``column``; NULLs are left out.

    Each task sets the bits of its words first; ``slots`` rows at most are gathered into the array.
    """
    if slots < 1 or hashes < 1:
        raise ValueError("a Bloom filter needs a slot and a hash")
    some = words.where(F.col(column).isNotNull())
    at = some.select(F.explode(F.array(*_bits(F.col(column), slots, hashes))).alias("bit"))
    set_bits = at.select(
        F.floor(F.col("bit") / 64).cast("int").alias("slot"),
        F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("bits"),
    )
    empty = words.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"), F.lit(0).cast("long").alias("bits"))
    slotted = set_bits.unionByName(empty).groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    row = slotted.agg(F.array_sort(F.collect_list(F.struct("slot", "bits"))).alias("s"))
    return row.select(F.transform("s", lambda x: x["bits"]).alias("bits"))


def filtered(words: DataFrame, column: str = "word", slots: int = SLOTS, hashes: int = HASHES) -> Listed:
    """The filter as a list: it holds every word of ``words`` and a few others."""

    def holds(bits: Column, word: Column) -> Column:
        tests = [
            F.getbit(F.get(bits, F.floor(bit / 64).cast("int")), (bit % 64).cast("int")) == 1
            for bit in _bits(word, slots, hashes)
        ]
        return reduce(lambda a, b: a & b, tests)

    return Listed(bloom_filter(words, column, slots, hashes).scalar(), holds)


def _passes(words: DataFrame, column: str, slots: int) -> Column:
    test = filtered(words, slots=slots)
    return test.holds(test.value, F.col(column))


def keep_words_by_filter(rows: DataFrame, words, column: str = "word", slots: int = SLOTS) -> DataFrame:
    """``keep_words`` for a list too long to broadcast: only rows that pass its filter are shuffled to it."""
    listed = as_words(rows.sparkSession, words)
    return keep_words(rows.where(_passes(listed, column, slots)), listed, column)


def drop_words_by_filter(rows: DataFrame, words, column: str = "word", slots: int = SLOTS) -> DataFrame:
    """``drop_words`` for a list too long to broadcast: rows that its filter rejects stay where they are.

    Only the others, of listed words and a few more, are shuffled to the list. ``rows`` are made twice, so this
    is for lists of rare words; rows with a NULL stay.
    """
    listed = as_words(rows.sparkSession, words)
    doubtful = F.coalesce(_passes(listed, column, slots), F.lit(False))
    return rows.where(~doubtful).unionByName(drop_words(rows.where(doubtful), listed, column))
