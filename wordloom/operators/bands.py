"""Wide token windows: the band of co-occurring positions, cut into blocks.

A line's tokens are cut into blocks of positions. Of the ``d`` positions that follow each token of a block
of ``s``, those from the block's end on, up to ``d``, follow all of them: there, the block's words with
their numbers meet the words of the stretch with theirs, and one row stands for many pairs of
positions. What is left is the rim, the rest of the block and the last positions of the windows, ``s - 1``
for each token, where positions are compared. Tokens that a filter rejects become NULL before the blocks
are cut, keep their positions, and cost nothing after that.

So the cost of a window follows the words in it, not ``d`` columns for each token, and a row holds
``s + d`` positions however long its line is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.text import line_array, token_array
from wordloom.operators.lists import Listed, let

#: From this distance on, windows are counted in blocks.
WIDE = 24
#: Blocks that a window spans, and the fewest positions of a block of listed words.
BLOCKS = 4
LISTED = 32


def _numbered(words: Column) -> Column:
    """The distinct words of an array without NULLs, each with its number: (word, cnt, pos = -1).

    Sorted, a word ends where the next one differs; its number is the way from the end before it.
    """

    def runs(ranked: Column) -> Column:
        def last(word: Column, i: Column) -> Column:
            return F.struct(word.alias("word"), (i + 1).alias("end"), F.get(ranked, i + 1).eqNullSafe(word).alias("more"))

        ends = F.filter(F.transform(ranked, last), lambda r: ~r["more"])
        return let(
            ends,
            lambda e: F.transform(
                e,
                lambda r, i: _entry(r["word"], r["end"] - F.coalesce(F.get(e, i - 1)["end"], F.lit(0)), F.lit(-1)),
            ),
        )

    return let(F.array_sort(words), runs)


def _entry(word: Column, count: Column, position: Column) -> Column:
    return F.struct(word.alias("word"), count.cast("long").alias("cnt"), position.cast("int").alias("pos"))


def _present(words: Column) -> Column:
    return F.filter(words, lambda w: w.isNotNull())


def _boxes(window: Column, s: int, d: int, with_words: bool) -> Column:
    """What a block's tokens meet: arrays (l, r) of entries, all with all but for positions out of reach."""
    near = F.filter(
        F.transform(window, lambda w, i: _entry(w, F.lit(1), i)),
        lambda e: e["word"].isNotNull() & ((e["pos"] < s) | (e["pos"] > d)),
    )

    def from_near(rim: Column) -> Column:
        own = F.filter(rim, lambda e: e["pos"] < s)
        return F.struct(own.alias("l"), rim.alias("r"))

    def from_words(own: Column) -> Column:
        seen_by_all = F.slice(window, s + 1, d - s + 1) if s <= d else F.slice(window, 1, 0)
        middle = _numbered(_present(seen_by_all))
        found = [F.struct(own.alias("l"), middle.alias("r"))]
        if with_words:
            alone = F.array(_entry(F.lit(None).cast("string"), F.lit(1), F.lit(-1)))
            found.append(F.struct(own.alias("l"), alone.alias("r")))
        return F.array(*found)

    own = _numbered(_present(F.slice(window, 1, s)))
    return F.concat(F.array(let(near, from_near)), let(own, from_words))


def masked(tokens: Column, tests: Sequence[Listed], kept: int) -> Column:
    """The tokens with NULL for those that take no part; the lists are columns ``list<i>``."""

    def rest(bound: list[Column | None]) -> Column:
        def mask(word: Column) -> Column:
            taken = word != ""
            for i, test in enumerate(tests):
                found = test.holds(bound[i], word)
                taken = taken & (found if i < kept else ~found)
            return F.when(taken, word)

        return F.transform(tokens, mask)

    def bind(bound: list[Column | None]) -> Column:
        i = len(bound)
        if i == len(tests):
            return rest(bound)
        if tests[i].value is None:
            return bind([*bound, None])
        return let(F.col(f"list{i}"), lambda value: bind([*bound, value]))

    return bind([])


def band_counts(
    texts: DataFrame,
    distance: int,
    keep: Sequence[Listed] = (),
    drop: Sequence[Listed] = (),
    tokenizer: str = "alnum",
    scope: str = "line",
    text: str = "text",
    with_words: bool = False,
) -> DataFrame:
    """``(a, b, cnt)`` for unordered pairs of tokens at most ``distance`` apart, ``a <= b``.

    Tokens take part that all of ``keep`` and none of ``drop`` list. With ``with_words`` each of them also
    counts in a row with a NULL ``b``. There is no shuffle but that of the partial counts.
    """
    d = distance
    s = max(LISTED if keep else 1, -(-d // BLOCKS))
    if scope == "line":
        texts = texts.select(F.explode_outer(line_array(text)).alias("span"))
    elif scope == "document":
        texts = texts.select(F.col(text).alias("span"))
    else:
        raise ValueError(f"scope must be 'line' or 'document', not {scope!r}")

    tests = [*keep, *drop]
    lists = [t.value.alias(f"list{i}") for i, t in enumerate(tests) if t.value is not None]
    rows = texts.select(token_array("span", tokenizer).alias("t"), *lists)
    rows = rows.select(masked(F.col("t"), tests, len(keep)).alias("t"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("t") - 1, F.lit(0)), F.lit(s))
    windows = F.transform(starts, lambda b: F.slice(F.col("t"), b + 1, s + d))
    boxes = F.flatten(F.transform(windows, lambda w: let(w, lambda x: _boxes(x, s, d, with_words))))
    pairs = (
        rows.select(F.explode_outer(boxes).alias("box"))
        .select(F.explode_outer("box.l").alias("l"), F.col("box.r").alias("r"))
        .select("l", F.explode_outer("r").alias("r"))
    )
    ahead = F.col("r.pos") - F.col("l.pos")
    within = (ahead > 0) & (ahead <= d)
    pairs = pairs.where(F.col("l.word").isNotNull() & F.col("r.cnt").isNotNull() & ((F.col("l.pos") < 0) | within))
    unordered = pairs.select(
        F.least("l.word", "r.word").alias("a"),
        F.when(F.col("r.word").isNotNull(), F.greatest("l.word", "r.word")).alias("b"),
        (F.col("l.cnt") * F.col("r.cnt")).alias("cnt"),
    )
    return unordered.groupBy("a", "b").agg(F.sum("cnt").alias("cnt"))
