"""Tab-separated text sinks. All take ``mode`` as ``DataFrameWriter`` does."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.formats import pair_text, score_text, stripe_text
from wordloom.sinks.clustered import files_of, lookup, write_clustered
from wordloom.sinks.documents import write_documents

__all__ = [
    "count_lines",
    "files_of",
    "lookup",
    "pair_lines",
    "score_lines",
    "stripe_lines",
    "tsv_lines",
    "write_clustered",
    "write_documents",
    "write_pairs",
    "write_scores",
    "write_stripes",
    "write_tsv",
]


def tsv_lines(df: DataFrame, *fields: Column) -> DataFrame:
    """``(value)``: the fields of a row joined by tabs; a NULL is an empty field."""
    texts = (F.coalesce(f.cast("string"), F.lit("")) for f in fields)
    return df.select(F.concat_ws("\t", *texts).alias("value"))


def count_lines(df: DataFrame) -> DataFrame:
    """``key<TAB>value``: the columns in their order."""
    return tsv_lines(df, *(F.col(c) for c in df.columns))


def pair_lines(pairs: DataFrame) -> DataFrame:
    """``(word,neighbor)<TAB>count``."""
    return tsv_lines(pairs, pair_text("word", "neighbor"), F.col("cnt"))


def stripe_lines(stripes: DataFrame, parts: int = 1) -> DataFrame:
    """``word<TAB>{a=1, b=2}`` of stripes in one part, else ``word<TAB>part<TAB>{a=1, b=2}``."""
    part = [F.col("part")] if parts > 1 else []
    return tsv_lines(stripes, F.col("word"), *part, stripe_text("entries"))


def score_lines(scores: DataFrame) -> DataFrame:
    """``doc_id<TAB>term<TAB>score``, the score with six decimals."""
    return tsv_lines(scores, F.col("doc_id"), F.col("term"), score_text("score"))


def _write(lines: DataFrame, path: str, mode: str) -> None:
    lines.write.mode(mode).text(path)


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists", order_by=None) -> None:
    """The lines of ``count_lines``.

    ``order_by`` sorts the files among each other and inside, by range partitioning; without
    it the rows stay where they are.
    """
    _write(count_lines(df if order_by is None else df.orderBy(order_by)), path, mode)


def write_pairs(
    pairs: DataFrame, path: str, mode: str = "errorifexists", ordered: bool = False
) -> None:
    """The lines of ``pair_lines``."""
    _write(pair_lines(pairs.orderBy("word", "neighbor") if ordered else pairs), path, mode)


def write_stripes(
    stripes: DataFrame,
    path: str,
    mode: str = "errorifexists",
    ordered: bool = False,
    parts: int = 1,
) -> None:
    """The lines of ``stripe_lines``; ``parts`` as the stripes were made with."""
    lines = stripe_lines(stripes.orderBy("word", "part") if ordered else stripes, parts)
    _write(lines, path, mode)


def write_scores(
    scores: DataFrame, path: str, mode: str = "errorifexists", ordered: bool = False
) -> None:
    """The lines of ``score_lines``."""
    _write(score_lines(scores.orderBy("doc_id", "term") if ordered else scores), path, mode)
