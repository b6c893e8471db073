"""Connected components of a distributed graph by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.shared import settled

#: Edge directions up to which a graph is kept in one partition, so that rounds need no shuffle.
FEW_EDGES = 200_000
#: Parts in which the nodes of one label look it up.
SLICES = 8


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b); comp is the smallest node reachable.

    Each round takes the least label among a node's neighbours, then the label of that label, so
    that the number of rounds grows with the logarithm of a chain's length rather than with the
    chain. Counts of a hot node are reduced in each task first. Only the number of changed labels
    reaches the driver. Self-loops and repeated edges are harmless; no edges give no rows. A graph of
    at most ``FEW_EDGES`` is read into one partition of a few megabytes; the steps are the same.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settled(both.where("a is not null and b is not null").distinct(), "edges")
    few = both.count() <= FEW_EDGES

    def placed(df: DataFrame) -> DataFrame:
        return df.coalesce(1) if few else df

    both = placed(both)
    labels = settled(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp")).select(
            "node", F.least("node", "comp").alias("comp")
        ),
        "labels",
    )
    labels = placed(labels)
    while True:
        near = (
            both.join(labels, both.b == labels.node)
            .groupBy("a")
            .agg(F.min("comp").alias("near"))
        )
        step = labels.join(near, labels.node == near.a, "left").select(
            "node", "comp", F.least("comp", "near").alias("new")
        )
        # only labels that moved themselves are looked up; those of one label come in slices
        moved = step.where("new < node").select(
            F.col("node").alias("up"), F.col("new").alias("upper"), F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("part")
        )
        sliced = step.withColumn("slice", F.pmod(F.xxhash64("node"), F.lit(SLICES)).cast("int"))
        jumped = sliced.join(moved, (sliced.new == moved.up) & (sliced.slice == moved.part), "left").select(
            "node", "comp", F.least("new", "upper").alias("new")
        )
        jumped = placed(settled(jumped, "labels"))
        labels = jumped.select("node", F.col("new").alias("comp"))
        if jumped.where("comp <> new").isEmpty():
            return labels
