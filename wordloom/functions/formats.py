"""Text forms of results, as the sinks write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pair_text(word: Column | str, neighbor: Column | str) -> Column:
    """``(word,neighbor)``."""
    return F.format_string("(%s,%s)", word, neighbor)


def stripe_text(entries: Column | str) -> Column:
    """``{a=1, b=2}`` from an array of (neighbor, cnt) structs, in the array's order."""
    parts = F.transform(
        entries, lambda e: F.concat(e["neighbor"], F.lit("="), e["cnt"].cast("string"))
    )
    return F.concat(F.lit("{"), F.array_join(parts, ", "), F.lit("}"))


def score_text(score: Column | str) -> Column:
    """A score with six decimals."""
    return F.format_string("%.6f", score)
