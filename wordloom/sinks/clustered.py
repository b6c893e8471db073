"""Results laid out by key: files of consecutive key ranges with an index of them, for lookups.

``path/data`` holds sorted files, no two of which share a key range but at one key; ``path/index`` has a row for
each: (file, first, last, rows). A lookup reads the index and then only the files whose range holds a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_clustered(df: DataFrame, path: str, key: str, files: int, mode: str = "errorifexists") -> None:
    """Write ``df`` in about ``files`` files of consecutive ranges of ``key``, sorted by it.

    Ranges are of about equal numbers of rows; rows of one key stay in one file. NULL keys come first.
    """
    if files < 1:
        raise ValueError("a clustered table has a file at least")
    ranged = df.repartitionByRange(files, F.col(key)).sortWithinPartitions(key)
    ranged.write.mode(mode).parquet(f"{path}/data")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data")
    index = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls")
    )
    index.coalesce(1).write.mode(mode).parquet(f"{path}/index")


def files_of(spark: SparkSession, path: str, keys) -> list[str]:
    """Files of a clustered table that may hold one of ``keys``; at most as many as there are files."""
    wanted = sorted(set(keys))
    index = spark.read.parquet(f"{path}/index")
    tests = [F.col("first") <= F.lit(k) for k in wanted], [F.col("last") >= F.lit(k) for k in wanted]
    hit = F.lit(False)
    for low, high in zip(*tests, strict=True):
        hit = hit | (low & high)
    return [r.file for r in index.where(hit).select("file").collect()]


def lookup(spark: SparkSession, path: str, key: str, keys) -> DataFrame:
    """Rows of a clustered table with one of ``keys``, from the files whose range holds one."""
    keys = list(keys)
    table = spark.read.parquet(f"{path}/data")
    found = files_of(spark, path, keys) if keys else []
    if not found:
        return table.where(F.lit(False))
    return spark.read.schema(table.schema).parquet(*found).where(F.col(key).isin(keys))
