"""Corpus readers: text files as lines, and document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.text import clean_document_id, line_array


def drop_long_lines(lines: DataFrame, max_bytes: int | None, column: str = "line") -> DataFrame:
    """Drop every line whose UTF-8 size, with a one-byte terminator, reaches ``max_bytes``."""
    if max_bytes is None:
        return lines
    return lines.where(F.octet_length(column) + 1 < max_bytes)


def read_lines(spark: SparkSession, path, max_bytes: int | None = None) -> DataFrame:
    """Text files as ``(line)``. LF, CR and CRLF each end a line."""
    return drop_long_lines(spark.read.text(path).withColumnRenamed("value", "line"), max_bytes)


def read_document_lines(
    spark: SparkSession, path, max_bytes: int | None = None, clean_ids: bool = False
) -> DataFrame:
    """Text files as ``(doc_id, line)``; the document id is the base name of the file.

    Files of the same name in two folders are one document. ``clean_ids`` deletes every
    ``.txt`` from the name.
    """
    # The name is percent-encoded as in a URI, where a plus sign stands for itself.
    encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    name = F.url_decode(encoded)
    doc_id = clean_document_id(name) if clean_ids else name
    lines = spark.read.text(path).select(doc_id.alias("doc_id"), F.col("value").alias("line"))
    return drop_long_lines(lines, max_bytes)


def document_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A document table as ``(doc_id, line_no, line)``."""
    lines = docs.select(doc_id, F.posexplode_outer(line_array(text)).alias("line_no", "line"))
    return lines.where(F.col("line").isNotNull())


def read_table(spark: SparkSession, path, *columns: str) -> DataFrame:
    """Columns of a Parquet table, spread over the cluster if the table has few splits.

    A table of fewer splits than twice the cores (one small file, say) would leave cores idle
    through the tokenizing that follows, and its text is cheap to move. A large table has far
    more splits, and its text is never shuffled.
    """
    table = spark.read.parquet(path).select(*columns)
    wanted = 2 * spark.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() < wanted:
        return table.repartition(wanted)
    return table
