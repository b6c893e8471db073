"""Mixing sources to target weights by Sainte-Laguë apportionment (operator 13).

Every source has a target of words. The mix is cut into blocks of equal length, and the blocks are
given to the sources one after the other, each to the source with the highest quotient target / (2k + 1),
k being the blocks it has. A source's blocks go the same way to its shards, whose votes are their
words. Inside a shard the documents lie end to end in a seeded order, over and over; the shard's
quota takes the first blocks of that stream, so that no document is taken again before all others
of its shard, and at most one document of a shard is cut.

The highest quotients are not played out seat by seat. Two divisors that surely give too few and too
many seats leave about two candidates for each party, and only these are ranked.

Only sizes travel: (source, doc_id, size) is read from the texts once. What reaches the driver are
sums and the number of candidates in each range of a sort.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.shared import settled

#: Weights of the sources in order of code points, repeated as needed.
WEIGHTS = (1, 2, 3)
#: No source and no document is taken more often.
MOST = 3
SEED = 13
#: Words of a block at most; a block is a thousandth of the smallest target where that is less.
BLOCK_WORDS = 1024
BLOCKS = 1000
#: Shards of the whole table, dealt to sources by their rows, and the fewest rows of a shard beside others.
SHARDS = 4096
SHARD_ROWS = 256
#: Equal rows (same source, id and size) that one step writes out.
COPIES = 4096


def words_of(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its place in a total order, from 0. Ranges are sorted apart; their sizes are collected."""
    ranges = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranges = settled(ranges, "ranges")
    sizes = dict(ranges.groupBy("_range").count().collect())
    last = max(sizes, default=0)
    before = list(accumulate((sizes.get(i, 0) for i in range(last)), initial=0))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranges.withColumn(
        name, place + F.element_at(F.array(*map(F.lit, before)), F.col("_range") + 1).cast("long")
    ).drop("_range")


def sizes(docs: DataFrame) -> DataFrame:
    """(source, doc_id, size, copies): equal rows are one row with their number."""
    rows = docs.select(
        F.col("source").cast("string").alias("source"),
        F.col("doc_id").cast("long").alias("doc_id"),
        words_of(F.col("text").cast("string")).alias("size"),
    )
    return rows.groupBy("source", "doc_id", "size").agg(F.count("*").alias("copies"))


def targets(sized: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, sid, rows, source_size, weight, target) for the sources of ``sizes``.

    The sources share the words of all by weight; one whose share is over ``most`` times its size
    gets just that, and the others share the rest, until none is above. Each round only raises the
    level, words per weight, and collects three sums.
    """
    by_source = sized.groupBy("source").agg(
        F.sum("copies").alias("rows"), F.sum(F.col("size") * F.col("copies")).alias("source_size")
    )
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    sources = _ranked(by_source, [F.col("source").asc_nulls_last()], "sid").withColumn(
        "weight", F.element_at(cycle, (F.col("sid") % len(weights)).cast("int") + 1)
    )
    sources = settled(sources, "sources")
    full = F.col("source_size") * float(most)
    level, known = 0.0, -1
    while True:
        above = F.col("weight") * level > full
        at = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, full).otherwise(0.0)).alias("given"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("weights"),
            F.count_if(above).alias("n"),
        ).first()
        if at["n"] == known or not at["weights"]:
            break
        known, level = at["n"], (at["all"] - at["given"]) / at["weights"]
    return sources.withColumn("target", F.when(above, full).otherwise(F.col("weight") * level))


def _bounds(votes: Column, all_votes: Column, seats: Column, parties: Column) -> tuple[Column, Column]:
    """Seats that a party has under a divisor giving too few in all, and under one giving too many."""

    def rounded(total: Column) -> Column:
        share = F.when(all_votes > 0, votes * F.greatest(total, F.lit(0.0)) / all_votes).otherwise(0.0)
        return F.floor(share + 0.5).cast("long")

    half = parties / 2 + 1
    return rounded(seats - half), rounded(seats + half)


def _quotients(parties: DataFrame) -> DataFrame:
    """A row for each seat between the two bounds, with its quotient."""
    some = parties.where("high > low")
    seats = some.select("*", F.explode(F.sequence("low", F.col("high") - 1)).alias("k"))
    return seats.withColumn("quotient", F.col("votes") / (2 * F.col("k") + 1))


def apportion(parties: DataFrame, seats: int) -> DataFrame:
    """``parties`` (party, votes) with their ``seats`` of a total; ties go to the smaller party."""
    at = parties.agg(F.sum("votes").alias("votes"), F.count_if(F.col("votes") > 0).alias("n")).first()
    low, high = _bounds(
        F.col("votes"), F.lit(float(at["votes"] or 0)), F.lit(float(seats)), F.lit(float(at["n"]))
    )
    bounded = settled(parties.withColumns({"low": low, "high": high}), "parties")
    left = seats - (bounded.agg(F.sum("low")).first()[0] or 0)
    ranked = _ranked(_quotients(bounded), [F.col("quotient").desc(), F.col("party").asc()], "place")
    won = ranked.where(F.col("place") < left).groupBy("party").agg(F.count("*").alias("won"))
    return bounded.join(won, "party", "left").select(
        *parties.columns, (F.col("low") + F.coalesce("won", F.lit(0))).alias("seats")
    )


def apportion_within(parties: DataFrame) -> DataFrame:
    """``parties`` (grp, party, votes, quota) with their ``seats`` of their group's ``quota``.

    A group's candidates are ranked in one task: about two small rows for each of its shards.
    """
    group = parties.groupBy("grp").agg(F.sum("votes").alias("all_votes"), F.count_if(F.col("votes") > 0).alias("n"))
    low, high = _bounds(F.col("votes"), F.col("all_votes"), F.col("quota").cast("double"), F.col("n"))
    bounded = settled(parties.join(group, "grp").withColumns({"low": low, "high": high}), "parties")
    left = bounded.groupBy("grp").agg((F.max("quota") - F.sum("low")).alias("left"))
    order = Window.partitionBy("grp").orderBy(F.col("quotient").desc(), F.col("party").asc())
    ranked = _quotients(bounded).withColumn("place", F.row_number().over(order)).join(left, "grp")
    won = ranked.where(F.col("place") <= F.col("left")).groupBy("grp", "party").agg(F.count("*").alias("won"))
    return bounded.join(won, ["grp", "party"], "left").select(
        *parties.columns, (F.col("low") + F.coalesce("won", F.lit(0))).alias("seats")
    )


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    block_words: int | None = None,
) -> DataFrame:
    """(source, doc_id, size, source_size, target, repeats, extra) for each row of ``docs``.

    The mix takes a document's text ``repeats`` times whole and its first ``extra`` words once more.
    A source's taken words differ from its target by a block, and by a part of a block for each of
    its shards where it is taken ``most`` times; no document is taken more than ``most`` times.

    Null texts have size 0 and are taken 0 times, as are texts without words; a null source is a
    source of its own, the last one; null ids are ids like others; repeated rows are documents of
    their own, which differ in nothing but what is taken of them. Ties of quotients go to the earlier
    source or shard, ties of the seeded order to the smaller id and size. Very long texts count by
    their words alone. An empty table, or one without words, gives targets of 0. Further columns are
    ignored. Reruns agree: nothing depends on how rows are dealt to tasks.
    """
    sized = settled(sizes(docs), "sizes")
    aims = settled(targets(sized, weights, most), "targets")
    at = aims.agg(
        F.sum("target").alias("words"), F.sum("rows").alias("rows"), F.min(F.expr("if(target > 0, target, null)")).alias("least")
    ).first()
    block = block_words or max(1, min(BLOCK_WORDS, int((at["least"] or 0) // BLOCKS)))
    rows = at["rows"] or 1

    given = apportion(
        aims.select(F.col("sid").alias("party"), F.col("target").alias("votes")), round((at["words"] or 0) / block)
    )
    dealt = F.ceil(F.col("rows") * (SHARDS / rows)).cast("long")
    plan = aims.join(given.select(F.col("party").alias("sid"), "seats"), "sid").withColumns(
        {
            "shards": F.greatest(F.lit(1), F.least(dealt, F.floor(F.col("rows") / SHARD_ROWS).cast("long"))),
            "quota": F.least("seats", F.floor(F.col("source_size") * most / block).cast("long")),
        }
    )
    plan = settled(plan.select("sid", "source", "source_size", "target", "shards", "quota"), "plan")

    named = plan.withColumnRenamed("source", "_source")
    turn = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    placed = sized.join(named, sized.source.eqNullSafe(F.col("_source"))).withColumns(
        {"turn": turn, "shard": F.pmod(turn, F.col("shards"))}
    )
    placed = settled(placed.drop("_source", "shards"), "placed")
    shards = placed.groupBy(F.col("sid").alias("grp"), F.col("shard").alias("party")).agg(
        F.sum(F.col("size") * F.col("copies")).alias("votes"), F.max("quota").alias("quota")
    )
    quotas = apportion_within(shards).select(
        F.col("grp").alias("sid"),
        F.col("party").alias("shard"),
        F.col("votes").alias("stream"),
        F.least(F.col("seats") * block, F.col("votes") * most).alias("words"),
    )
    order = Window.partitionBy("sid", "shard").orderBy("turn", F.col("doc_id").asc_nulls_last(), "size")
    end = F.sum(F.col("size") * F.col("copies")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    lined = placed.withColumn("first", end - F.col("size") * F.col("copies")).join(quotas, ["sid", "shard"])
    lined = lined.select(
        "source",
        "doc_id",
        "size",
        "source_size",
        "target",
        "copies",
        "first",
        F.expr("if(stream > 0, words div stream, 0)").alias("repeats"),
        F.expr("if(stream > 0, words % stream, 0)").alias("rest"),
    )
    lined = settled(lined, "lined")
    # equal rows are written out again; a great many of them by many tasks
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))).alias("from")
    few = lined.where(F.col("copies") <= COPIES).withColumn("from", F.lit(0).cast("long"))
    many = lined.where(F.col("copies") > COPIES).select("*", step).repartition("doc_id", "size", "from")
    both = few.unionByName(many)
    last = F.least(F.col("copies"), F.col("from") + COPIES) - 1
    each = both.select("*", F.explode(F.sequence("from", last)).alias("copy"))
    open_words = F.col("rest") - F.col("first") - F.col("copy") * F.col("size")
    return each.select(
        "source",
        "doc_id",
        "size",
        "source_size",
        "target",
        F.col("repeats").cast("long").alias("repeats"),
        F.greatest(F.lit(0), F.least(F.col("size"), open_words)).cast("long").alias("extra"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    taken = F.col("repeats") * F.col("size") + F.col("extra")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "repeats", "extra")
