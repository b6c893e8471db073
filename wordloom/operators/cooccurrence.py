"""Word co-occurrence inside a token window, as pairs and as stripes.

Two tokens of a line co-occur when their positions differ by at most the window distance. The
positions are those before any stopword or vocabulary filter. The matrix is symmetric, so only
"a before b" is generated, counted under the unordered pair, and mirrored after the count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.text import line_array, token_array
from wordloom.operators.bands import WIDE, band_counts, masked
from wordloom.operators.bloom import filtered
from wordloom.operators.contexts import HOT_STRIPES, context_counts, context_windows, hot_words
from wordloom.operators.lists import are_in_code, in_row, literal_list
from wordloom.operators.words import drop_words, keep_words
from wordloom.sources.wordlists import are_few, as_words


def _check_distance(distance: int) -> None:
    if not isinstance(distance, int) or distance < 1:
        raise ValueError(f"the window distance must be an integer of at least 1, not {distance!r}")


def _are_small(vocabulary, stopwords, small: bool | None) -> bool:
    if small is not None:
        return small
    return all(are_few(words) for words in (vocabulary, stopwords) if words is not None)


def _filter(rows: DataFrame, column: str, vocabulary, stopwords) -> DataFrame:
    if vocabulary is not None:
        rows = keep_words(rows, vocabulary, column)
    if stopwords is not None:
        rows = drop_words(rows, stopwords, column)
    return rows


def window_pairs(
    texts: DataFrame,
    distance: int,
    vocabulary=None,
    stopwords=None,
    tokenizer: str = "alnum",
    scope: str = "line",
    text: str = "text",
    with_words: bool = False,
) -> DataFrame:
    """``(word, neighbor, offset)``: each token with each of the ``distance`` tokens after it.

    ``scope`` is ``"line"`` (a window ends with its line) or ``"document"`` (with its row).
    With ``with_words`` every token that passes the filters also gives one row with a NULL
    neighbor and offset 0.

    The token array, zipped with itself shifted by 1 .. distance, yields every window in one
    generator, so no shuffle or sort comes before the count, and a row carries ``distance``
    tokens however long its line is. The first filter runs before the neighbors are expanded.
    A few stopwords given in code, without a vocabulary, become NULL inside the row before that.
    """
    _check_distance(distance)
    if scope == "line":
        texts = texts.select(F.explode_outer(line_array(text)).alias("span"))
    elif scope == "document":
        texts = texts.select(F.col(text).alias("span"))
    else:
        raise ValueError(f"scope must be 'line' or 'document', not {scope!r}")

    n = F.greatest(F.size("t"), F.lit(1))
    shifted = [F.slice("t", k + 1, n).alias(f"t{k}") for k in range(distance + 1)]
    rows = texts.select(token_array("span", tokenizer).alias("t"))
    if vocabulary is None and are_in_code(stopwords):
        rows = rows.select(masked(F.col("t"), [literal_list(stopwords)], 0).alias("t"))
        stopwords = None
    centres = (
        rows.select(F.explode_outer(F.arrays_zip(*shifted)).alias("z"))
        .select(F.col("z.t0").alias("word"), *(f"z.t{k}" for k in range(1, distance + 1)))
        .where(F.col("word") != "")
    )
    centres = _filter(centres, "word", vocabulary, stopwords)

    after = [F.col(f"t{k}") for k in range(1, distance + 1)]
    if with_words:
        # One more neighbor in front, NULL at offset 0, stands for the word on its own. An anti
        # join lets NULL pass, a semi join would not.
        if vocabulary is not None:
            raise ValueError("with_words goes with stopwords only")
        window = F.posexplode_outer(F.array(F.lit(None).cast("string"), *after))
        pairs = centres.select("word", window.alias("offset", "neighbor"))
        pairs = pairs.where((F.col("offset") == 0) | (F.col("neighbor") != ""))
    else:
        window = F.posexplode_outer(F.array(*after))
        pairs = centres.select("word", window.alias("step", "neighbor"))
        pairs = pairs.where(F.col("neighbor") != "")
        pairs = pairs.select("word", "neighbor", (F.col("step") + 1).alias("offset"))
    return _filter(pairs, "neighbor", vocabulary, stopwords)


def _unordered(pairs: DataFrame, *more) -> DataFrame:
    return pairs.select(
        F.least("word", "neighbor").alias("a"),
        F.when(F.col("neighbor").isNotNull(), F.greatest("word", "neighbor")).alias("b"),
        *more,
    )


def _mirrored(counts: DataFrame, columns: list[str]) -> DataFrame:
    """``(a, b)`` rows as ``(word, neighbor)`` in both directions.

    A word beside itself is met from both ends, so (w, w) counts twice. A row without ``b``
    (a word on its own) stays one row.
    """

    def row(word: str, neighbor: str, times: int):
        numbers = (F.col(c) * times for c in columns)
        return F.struct(
            F.col(word).alias("word"),
            F.col(neighbor).alias("neighbor"),
            *(number.alias(c) for number, c in zip(numbers, columns)),
        )

    rows = (
        F.when(F.col("b").isNull(), F.array(row("a", "b", 1)))
        .when(F.col("a") == F.col("b"), F.array(row("a", "b", 2)))
        .otherwise(F.array(row("a", "b", 1), row("b", "a", 1)))
    )
    return counts.select(F.explode_outer(rows).alias("r")).select("r.*")


def _count(pairs: DataFrame) -> DataFrame:
    """``(a, b, cnt)``. Counts are partial in each task first, so a hot pair is a row per task."""
    return _unordered(pairs).groupBy("a", "b").agg(F.count("*").alias("cnt"))


def _counted_pairs(texts, distance, vocabulary, stopwords, small_lists, count, **window):
    """Unordered pairs of listed words, counted by ``count``, with the lists at the right place.

    Small lists filter the tokens before they are paired. Other lists join the counts: one row
    per distinct pair is shuffled to them, not one per occurrence.
    """
    if _are_small(vocabulary, stopwords, small_lists):
        return count(window_pairs(texts, distance, vocabulary, stopwords, **window))
    counts = count(window_pairs(texts, distance, **window))
    counts = _filter(counts, "a", vocabulary, stopwords)
    return _filter(counts, "b", vocabulary, stopwords)


def _pair_counts(texts, distance, vocabulary, stopwords, small_lists, **window):
    """``(a, b, cnt)`` of unordered pairs, by the plan that the distance and the lists ask for.

    Short windows are expanded, wide ones of listed words counted in blocks, and wide ones of all words where the
    contexts of a word meet. A vocabulary that is not known to be small becomes a Bloom filter on the tokens before
    they are paired; the pairs that are left are joined to it.
    """
    _check_distance(distance)
    small = _are_small(vocabulary, stopwords, small_lists)
    if vocabulary is not None and not small:
        words = filtered(as_words(texts.sparkSession, vocabulary))
        counts = _filter(band_counts(texts, distance, [words], **window), "a", vocabulary, stopwords)
        return _filter(counts, "b", vocabulary, stopwords)
    if distance < WIDE:
        return _counted_pairs(texts, distance, vocabulary, stopwords, small_lists, _count, **window)
    if small and vocabulary is not None:
        kept, gone = ([] if w is None else [in_row(texts.sparkSession, w)] for w in (vocabulary, stopwords))
        return band_counts(texts, distance, kept, gone, **window)
    if small:
        return _all_pair_counts(texts, distance, stopwords, **window)
    counts = _filter(_all_pair_counts(texts, distance, **window), "a", None, stopwords)
    return _filter(counts, "b", None, stopwords)


def _all_pair_counts(texts, distance, stopwords=None, tokenizer="alnum", text="text", **window) -> DataFrame:
    """``(a, b, cnt)`` over all words but a few stopwords: hot words among themselves, then all other pairs."""
    window = {**window, "tokenizer": tokenizer, "text": text}
    gone = [] if stopwords is None else [in_row(texts.sparkSession, stopwords)]
    hot = hot_words(texts, stopwords if are_in_code(stopwords) else None, tokenizer, text)
    frequent = band_counts(texts, distance, [hot], gone, **window)
    return frequent.unionByName(context_counts(texts, distance, hot, gone, **window))


def cooccurrence_pairs(
    texts: DataFrame,
    distance: int,
    vocabulary=None,
    stopwords=None,
    tokenizer: str = "alnum",
    scope: str = "line",
    text: str = "text",
    small_lists: bool | None = None,
) -> DataFrame:
    """``(word, neighbor, cnt)`` for both directions of every co-occurring pair.

    With a vocabulary both words must be in it; with stopwords neither may be one. A list given
    in code is known to be small or not; one given as a DataFrame counts as large unless
    ``small_lists`` says otherwise (a top-k list is small). No join is forced to broadcast.
    From ``bands.WIDE`` positions on, the cost of a window follows the words that the lists leave in it.
    """
    counts = _pair_counts(
        texts,
        distance,
        vocabulary,
        stopwords,
        small_lists,
        tokenizer=tokenizer,
        scope=scope,
        text=text,
    )
    return _mirrored(counts, ["cnt"])


def _sweep(texts, distances, vocabulary, stopwords, small_lists, **window) -> DataFrame:
    distances = sorted(set(distances))
    for distance in distances:
        _check_distance(distance)
    columns = [f"cnt_d{d}" for d in distances]
    if distances[-1] >= WIDE or vocabulary is not None and not _are_small(vocabulary, stopwords, small_lists):
        # each distance by the plan that it asks for, side by side
        found = [
            _pair_counts(texts, d, vocabulary, stopwords, small_lists, **window).select(
                "a", "b", *[(F.col("cnt") if c == own else F.lit(0).cast("long")).alias(c) for c in columns]
            )
            for d, own in zip(distances, columns)
        ]
        counts = reduce(DataFrame.unionByName, found).groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in columns])
        return _mirrored(counts, columns)
    within = [F.count_if(F.col("offset") <= d).alias(c) for d, c in zip(distances, columns)]
    counts = _counted_pairs(
        texts,
        distances[-1],
        vocabulary,
        stopwords,
        small_lists,
        lambda pairs: _unordered(pairs, "offset").groupBy("a", "b").agg(*within),
        **window,
    )
    return _mirrored(counts, columns)


def cooccurrence_sweep(
    texts: DataFrame,
    distances=(1, 2, 3, 4),
    vocabulary=None,
    stopwords=None,
    tokenizer: str = "alnum",
    scope: str = "line",
    text: str = "text",
    small_lists: bool | None = None,
) -> DataFrame:
    """``(word, neighbor, cnt_d<k> ...)`` for several distances.

    Short windows over small lists take one pass over the text, others one for each distance.
    """
    return _sweep(
        texts, distances, vocabulary, stopwords, small_lists, tokenizer=tokenizer, scope=scope, text=text
    )


def stripes(pairs: DataFrame, parts: int = 1) -> DataFrame:
    """``(word, part, entries)``: per word the array of (neighbor, counts ...), neighbors ascending.

    Every word's neighbors are spread over ``parts`` parts by a hash of the neighbor, whatever
    the size of the data. One part is right over a vocabulary, whose size bounds the stripes;
    over all words take the number of distinct words / 100,000, so that a part stays a bounded
    row. A row with a NULL neighbor stands for the word itself and gives it a part 0, empty if no
    neighbor falls there; a part without entries is otherwise absent.
    """
    if not isinstance(parts, int) or parts < 1:
        raise ValueError(f"parts must be an integer of at least 1, not {parts!r}")
    counts = [c for c in pairs.columns if c not in ("word", "neighbor")]
    return _gathered(pairs.select("word", _part(parts).alias("part"), "neighbor", *counts))


def _part(parts: int):
    bucket = F.conv(F.substring(F.md5(F.col("neighbor").cast("binary")), 1, 8), 16, 10).cast("bigint")
    part = F.coalesce(F.pmod(bucket, F.lit(parts)), F.lit(0)) if parts > 1 else F.lit(0)
    return part.cast("int")


def _gathered(placed: DataFrame) -> DataFrame:
    counts = [c for c in placed.columns if c not in ("word", "part", "neighbor")]
    entry = F.when(F.col("neighbor").isNotNull(), F.struct("neighbor", *counts)).alias("entry")
    placed = placed.select("word", "part", entry)
    return placed.groupBy("word", "part").agg(F.sort_array(F.collect_list("entry")).alias("entries"))


def vocabulary_stripes(
    texts: DataFrame,
    distance: int,
    vocabulary,
    stopwords=None,
    scope: str = "line",
    text: str = "text",
    parts: int = 1,
    small_lists: bool | None = None,
) -> DataFrame:
    """Stripes over a vocabulary without its stopwords; a word with no neighbor has no row."""
    pairs = cooccurrence_pairs(texts, distance, vocabulary, stopwords, "alnum", scope, text, small_lists)
    return stripes(pairs, parts)


def vocabulary_stripes_sweep(
    texts: DataFrame,
    distances,
    vocabulary,
    stopwords=None,
    scope: str = "line",
    text: str = "text",
    parts: int = 1,
    small_lists: bool | None = None,
) -> DataFrame:
    """Stripes for several distances from one pass: entries (neighbor, cnt_d<k> ...).

    A neighbor that only a larger distance reaches has count 0 at the smaller ones.
    """
    return stripes(cooccurrence_sweep(texts, distances, vocabulary, stopwords, "alnum", scope, text, small_lists), parts)


def all_word_stripes(
    texts: DataFrame,
    distance: int,
    stopwords=None,
    *,
    parts: int,
    scope: str = "line",
    text: str = "text",
    small_lists: bool | None = None,
) -> DataFrame:
    """Stripes of every word that is no stopword; a word with no neighbor has an empty one."""
    counts = _pair_counts(
        texts,
        distance,
        None,
        stopwords,
        small_lists,
        tokenizer="nonword",
        scope=scope,
        text=text,
        with_words=True,
    )
    return stripes(_mirrored(counts, ["cnt"]), parts)


def all_word_stripes_sweep(
    texts: DataFrame,
    distances,
    stopwords=None,
    *,
    parts: int,
    scope: str = "line",
    text: str = "text",
    small_lists: bool | None = None,
) -> DataFrame:
    """Stripes of every word for several distances, as in ``vocabulary_stripes_sweep``."""
    distances = sorted(set(distances))
    for distance in distances:
        _check_distance(distance)
    if distances[-1] < WIDE and (stopwords is None or are_in_code(stopwords)):
        gone = [] if stopwords is None else [literal_list(stopwords)]
        hot = hot_words(texts, stopwords, "nonword", text, HOT_STRIPES)
        found = context_windows(texts, distances, hot, gone, "nonword", scope, text)
        return reduce(DataFrame.unionByName, (stripes(pairs, parts) for pairs in found))
    pairs = _sweep(
        texts, distances, None, stopwords, small_lists, tokenizer="nonword", scope=scope, text=text, with_words=True
    )
    return stripes(pairs, parts)


def stripe_at(entries, count: str):
    """A sweep's entries at one distance, as (neighbor, cnt); those it does not reach are left out."""
    reached = F.filter(entries, lambda e: e[count] > 0)
    return F.transform(reached, lambda e: F.struct(e["neighbor"].alias("neighbor"), e[count].alias("cnt")))


def isolated_words(stripes: DataFrame) -> DataFrame:
    """``(word)``: those whose parts are all empty."""
    return stripes.groupBy("word").agg(F.max(F.size("entries")).alias("n")).where("n = 0").select("word")


def stripe_maps(stripes: DataFrame) -> DataFrame:
    """``(word, part, stripe)`` with the entries of a part as a map from neighbor to count."""
    return stripes.select("word", "part", F.map_from_entries("entries").alias("stripe"))


def stripes_to_pairs(stripes: DataFrame) -> DataFrame:
    """``(word, neighbor, counts ...)`` from stripes; empty stripes give no row."""
    rows = stripes.select("word", F.explode_outer("entries").alias("e"))
    return rows.where(F.col("e").isNotNull()).select("word", "e.*")


def merge_stripes(*stripe_sets: DataFrame, parts: int) -> DataFrame:
    """Element-wise sum of several sets of stripes, empty stripes included.

    The sets may have different numbers of parts. Every word has a part 0 in the result.
    Entries are dealt to the parts of the result at once, and there summed and gathered: one shuffle.
    """
    if not isinstance(parts, int) or parts < 1:
        raise ValueError(f"parts must be an integer of at least 1, not {parts!r}")

    def rows(s: DataFrame) -> DataFrame:
        marked = F.when(F.col("part") == 0, F.array_append("entries", F.lit(None))).otherwise(F.col("entries"))
        return s.select("word", F.explode_outer(marked).alias("e")).select("word", "e.*")

    pairs = reduce(DataFrame.unionByName, (rows(s) for s in stripe_sets))
    placed = pairs.select("word", _part(parts).alias("part"), "neighbor", "cnt").repartition("word", "part")
    return _gathered(placed.groupBy("word", "part", "neighbor").agg(F.sum("cnt").alias("cnt")))
