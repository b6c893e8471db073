"""Words counted with their neighbors where the contexts of a word meet, not pair by pair before the shuffle.

Over all words most pairs are rare: partial counts of them are nearly as many as the pairs, and each is a row. Here a
token travels once, with its neighbors as one text, to the task of its word, and the pairs are made and counted there.

The ``HOT`` most frequent words are no such homes. Their pairs repeat, so that partial counts stay few, and their
contexts would all go to one task. Whatever the texts, any other word has at most one token in ``HOT`` + 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.text import line_array, token_array
from wordloom.operators.bands import masked
from wordloom.operators.lists import Listed, let, literal_list, short_list
from wordloom.operators.words import token_counts, top_words

#: How many of the most frequent words are counted in partial counts.
HOT = 500
#: The same for stripes, whose partial counts repeat less.
HOT_STRIPES = 20
#: Positions of a block of tokens, whose contexts are cut together.
BLOCK = 64
#: Ends a word in a context. Every tokenizer splits at it.
END = "\n"
#: Precedes a hot word in a context, and sorts it before the others.
MARK = " "


def hot_words(texts: DataFrame, stopwords=None, tokenizer: str = "alnum", text: str = "text", k: int = HOT) -> Listed:
    """The ``k`` most frequent words without the stopwords given in code, as a list for use inside rows."""
    counts = token_counts(texts, tokenizer, text)
    if stopwords is not None:
        counts = counts.where(~literal_list(stopwords).holds(None, F.col("word")))
    return short_list(top_words(counts, k))


def _spans(texts: DataFrame, scope: str, text: str) -> DataFrame:
    if scope == "line":
        return texts.select(F.explode_outer(line_array(text)).alias("span"))
    if scope == "document":
        return texts.select(F.col(text).alias("span"))
    raise ValueError(f"scope must be 'line' or 'document', not {scope!r}")


def _marked_rows(texts, hot: Listed, drop: Sequence[Listed], tokenizer, scope, text) -> DataFrame:
    """``(t)``: a line's tokens, NULL for those that take no part, ``MARK`` before hot ones."""
    lists = [t.value.alias(f"list{i}") for i, t in enumerate(drop) if t.value is not None]
    rows = _spans(texts, scope, text).select(token_array("span", tokenizer).alias("t"), hot.value.alias("hot"), *lists)
    rows = rows.select(masked(F.col("t"), drop, 0).alias("t"), "hot")

    def marks(listed: Column) -> Column:
        return F.transform("t", lambda w: F.when(hot.holds(listed, w), F.concat(F.lit(MARK), w)).otherwise(w))

    return rows.select(let(F.col("hot"), marks).alias("t"))


def _unmarked(column: str) -> Column:
    return F.when(F.col(column).startswith(MARK), F.expr(f"substring({column}, 2)")).otherwise(F.col(column))


def _homes(window: Column, first: Column, d: int) -> Column:
    """(home, near) of a block's tokens that are not hot; ``near`` holds the neighbors that sort before it.

    An equal neighbor counts at the first of the two.
    """
    last = F.least(first + BLOCK, F.size(window)) - 1
    places = F.filter(F.sequence(first, last), lambda i: ~F.get(window, i).startswith(MARK))

    def row(i: Column) -> Column:
        start = F.greatest(i - d, F.lit(0))

        def near(own: Column) -> Column:
            found = F.filter(
                F.slice(window, start + 1, i + d + 1 - start),
                lambda w, j: (w < own) | ((w == own) & (j + start > i)),
            )
            return F.struct(own.alias("home"), F.array_join(found, END).alias("near"))

        return let(F.get(window, i), near)

    return F.transform(places, row)


def context_counts(
    texts: DataFrame,
    distance: int,
    hot: Listed,
    drop: Sequence[Listed] = (),
    tokenizer: str = "alnum",
    scope: str = "line",
    text: str = "text",
    with_words: bool = False,
) -> DataFrame:
    """``(a, b, cnt)`` as ``band_counts`` gives them, without the pairs of two hot words.

    A pair is counted at the greater of its words, or at the one that is not hot. The only shuffle is that
    of the contexts, by their word.
    """
    d = distance
    rows = _marked_rows(texts, hot, drop, tokenizer, scope, text)
    starts = F.sequence(F.lit(0), F.greatest(F.size("t") - 1, F.lit(0)), F.lit(BLOCK))

    def block(start: Column) -> Column:
        low = F.greatest(start - d, F.lit(0))
        return F.struct(F.slice("t", low + 1, start - low + BLOCK + d).alias("w"), (start - low).alias("first"))

    blocks = rows.select(F.explode_outer(F.transform(starts, block)).alias("z"))
    blocks = blocks.where(F.size("z.w") > 0)
    homes = blocks.select(F.explode_outer(_homes(F.col("z.w"), F.col("z.first"), d)).alias("c")).select("c.*")
    homes = homes.where(F.col("home").isNotNull() if with_words else F.col("near") != "").repartition("home")
    near = F.when(F.col("near") != "", F.split("near", END)).otherwise(F.array().cast("array<string>"))
    if with_words:
        near = F.array_append(near, F.lit(None).cast("string"))
    pairs = homes.select("home", F.explode_outer(near).alias("near"))
    if not with_words:
        pairs = pairs.where(F.col("near").isNotNull())
    counts = pairs.groupBy("home", "near").agg(F.count("*").alias("cnt"))
    counts = counts.select("home", _unmarked("near").alias("near"), "cnt")
    return counts.select(
        F.least("home", "near").alias("a"),
        F.when(F.col("near").isNotNull(), F.greatest("home", "near")).alias("b"),
        "cnt",
    )


def context_windows(
    texts: DataFrame,
    distances: Sequence[int],
    hot: Listed,
    drop: Sequence[Listed] = (),
    tokenizer: str = "nonword",
    scope: str = "line",
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """``(word, neighbor, cnt_d<k> ...)`` with the neighbors on both sides, of the words that are not hot and of the hot ones.

    Every word also has a row with a NULL neighbor. The first table has all rows of a word in one task: its contexts
    were shuffled there. The second shuffles partial counts.
    """
    d = max(distances)
    rows = _marked_rows(texts, hot, drop, tokenizer, scope, text)
    rows = rows.select(F.concat(F.array_repeat(F.lit(None).cast("string"), d), "t").alias("t"))
    n = F.greatest(F.size("t"), F.lit(1))
    shifted = [F.slice("t", k + 1, n).alias(f"t{k}") for k in range(2 * d + 1)]
    own = f"z.t{d}"
    centres = rows.select(F.explode_outer(F.arrays_zip(*shifted)).alias("z")).where(F.col(own) != "")
    # an empty text in front stands for the word alone
    near = [F.lit(""), *(F.coalesce(f"z.t{k}", F.lit("")) for k in range(2 * d + 1) if k != d)]
    # empty texts at the end are none to be read again
    context = F.rtrim(F.concat_ws(END, *near), F.lit(END))
    centres = centres.select(F.col(own).alias("word"), context.alias("near"))

    def counted(homes: DataFrame) -> DataFrame:
        pairs = homes.select("word", F.posexplode_outer(F.split("near", END)).alias("pos", "near"))
        pairs = pairs.where((F.col("pos") == 0) | (F.col("near") != ""))
        ahead = F.when(F.col("pos") > d, F.col("pos") - d).otherwise(d + 1 - F.col("pos"))
        pairs = pairs.select("word", F.when(F.col("pos") > 0, F.col("near")).alias("near"), ahead.alias("offset"))
        counts = [f"cnt_d{k}" for k in distances]
        within = [F.count_if(F.col("offset") <= k).alias(c) for k, c in zip(distances, counts)]
        found = pairs.groupBy("word", "near").agg(*within)
        return found.select("word", _unmarked("near").alias("neighbor"), *counts)

    is_hot = F.col("word").startswith(MARK)
    frequent = counted(centres.where(is_hot)).withColumn("word", _unmarked("word"))
    return counted(centres.where(~is_hot).repartition("word").sortWithinPartitions("word")), frequent
