"""A stored co-occurrence matrix: stripes in a bucketed table, into which new stripes are merged.

The table is bucketed by (word, part), so that a merge shuffles the new stripes to the old ones and leaves the
old ones where they are, and a part stays the bounded row that its number of parts makes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of a stored matrix: its size / 256 MB, say.
BUCKETS = 64
#: Tasks, and files, that a bucket is written by.
WRITERS = 4


def save_stripes(stripes: DataFrame, table: str, buckets: int = BUCKETS, path: str | None = None, mode: str = "errorifexists") -> None:
    """Write ``(word, part, entries)`` as a table bucketed by (word, part), ``WRITERS`` sorted files for each bucket.

    A task holds rows of one bucket only: hashes that are equal modulo a multiple of ``buckets`` are equal modulo it.
    """
    placed = stripes.select("word", "part", "entries").repartition(WRITERS * buckets, "word", "part")
    writer = placed.write.mode(mode).bucketBy(buckets, "word", "part").sortBy("word", "part")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def merged_entries(old: Column, new: Column) -> Column:
    """Two arrays of (neighbor, cnt), each without a repeated neighbor, as one; counts of a neighbor are added.

    Sorted together, a neighbor of both stands twice in a row: the second entry takes both counts.
    """

    def summed(both: Column) -> Column:
        def total(e: Column, i: Column) -> Column:
            before, after = F.get(both, i - 1), F.get(both, i + 1)
            count = e["cnt"] + F.when(before["neighbor"] == e["neighbor"], before["cnt"]).otherwise(0)
            more = F.coalesce(after["neighbor"] == e["neighbor"], F.lit(False))
            return F.struct(F.struct(e["neighbor"].alias("neighbor"), count.alias("cnt")).alias("e"), more.alias("more"))

        last = F.filter(F.transform(both, total), lambda x: ~x["more"])
        return F.transform(last, lambda x: x["e"])

    none = F.array().cast("array<struct<neighbor:string,cnt:bigint>>")
    both = F.array_sort(F.concat(F.coalesce(old, none), F.coalesce(new, none)))
    return F.get(F.transform(F.array(both), summed), F.lit(0))


def merge_into_stored(stored: DataFrame, stripes: DataFrame) -> DataFrame:
    """``(word, part, entries)``: a stored matrix with new stripes added, both made with equal ``parts``.

    Only ``stripes`` are shuffled, to the buckets of ``stored`` (a table of ``save_stripes``). Rows are those of
    ``merge_stripes``.
    """
    new = stripes.select("word", "part", F.col("entries").alias("new_entries"))
    both = stored.select("word", "part", "entries").join(new, ["word", "part"], "full_outer")
    return both.select("word", "part", merged_entries(F.col("entries"), F.col("new_entries")).alias("entries"))
