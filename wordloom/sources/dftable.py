"""Document-frequency tables in tab-separated text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.text import strip_controls


def parse_df_table(lines: DataFrame, column: str = "line") -> DataFrame:
    """``(term, df)`` from lines ``term<TAB>df``.

    Lines are trimmed first. A line without exactly two fields, or whose second field is no
    32-bit integer, is skipped. A term on two lines is an error: files have no line order to
    decide which one counts.
    """
    fields = F.split(strip_controls(column), "\t")
    rows = (
        lines.select(fields.alias("fields"))
        .where(F.size("fields") == 2)
        .select(
            strip_controls(F.col("fields")[0]).alias("term"),
            strip_controls(F.col("fields")[1]).alias("number"),
        )
        .where(F.col("number").rlike("^[+-]?[0-9]+$"))
        .select("term", F.col("number").try_cast("int").cast("bigint").alias("df"))
        .where(F.col("df").isNotNull())
    )
    twice = F.raise_error(F.concat(F.lit("duplicate term in the table: "), F.col("term")))
    return (
        rows.groupBy("term")
        .agg(F.max("df").alias("df"), F.count("*").alias("n"))
        .select("term", F.when(F.col("n") == 1, F.col("df")).otherwise(twice).alias("df"))
    )


def read_df_table(spark: SparkSession, path) -> DataFrame:
    return parse_df_table(spark.read.text(path), "value")


def read_checked_df_table(spark: SparkSession, path) -> DataFrame:
    """A table, read once to see that it holds a term; ``ValueError`` if not."""
    table = read_df_table(spark, path)
    if table.isEmpty():
        raise ValueError(f"table {path} is empty")
    return table
