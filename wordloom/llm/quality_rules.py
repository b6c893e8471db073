"""Quality rules by robust multivariate outliers (operator 3), in DataFrame functions only.

Each document gives a vector of six transformed statistics. For every language and source the
minimum covariance determinant gives a robust centre and covariance: from two starts, concentration
steps take the mean and covariance of the ``SHARE`` of documents nearest to the last estimate, and
the start with the smaller determinant wins. A document is rejected if its squared Mahalanobis
distance exceeds the ``CUTOFF`` quantile of the chi-squared distribution, or by the fixed rules
(under 50 words, or over half of them in repeated three-word windows).

Sources of fewer than ``OWN_GROUP`` documents share one estimate per language; a group of fewer than
``POOLED_GROUP`` rejects nothing beyond the fixed rules. ``FLOORS`` keep constant statistics, such
as the share of symbols in clean prose, from making every other value an outlier.

Estimates are rows of a table that is joined to the documents' vectors. Quantiles and moments are
aggregates with partial results in each task, so a source with a third of all rows costs no more
per task than others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.expressions import let
from wordloom.llm.shared import settled

#: The characters that separate words, and those counted as symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MIN_WORDS, REPEAT_PERCENT = 50, 50

#: Statistics of the vector, each with the least standard deviation that it is given.
FLOORS = {
    "log_words": 0.7,
    "log_word_length": 0.12,
    "symbols": 0.06,
    "duplicate_lines": 0.15,
    "repeats": 0.12,
    "capitals": 0.06,
}
NAMES = tuple(FLOORS)
SHARE = 0.75
STEPS = 5
#: Groups up to which their estimates (under 500 bytes each) are broadcast to the vectors.
BROADCAST_GROUPS = 50_000
OWN_GROUP, POOLED_GROUP = 200, 60
#: Probability that a document of a normal population lies beyond the cutoff.
BEYOND = 1e-6


def _chi_squared_tail(x: float, freedom: int) -> float:
    """P(X > x) for an even number of degrees of freedom."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))


def _chi_squared_quantile(tail: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_squared_tail(middle, freedom) > tail else (low, middle)
    return low


CUTOFF = _chi_squared_quantile(BEYOND, len(NAMES))
#: Makes the covariance of the nearest ``SHARE`` of a normal population that of the whole.
CONSISTENCY = SHARE / (
    1 - _chi_squared_tail(_chi_squared_quantile(1 - SHARE, len(NAMES)), len(NAMES) + 2)
)


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """How many words lie in a three-word window that stands in the text twice or more.

    Windows are sorted by hash with their place in the low bits of the same number; neighbours of
    equal hash are compared word by word.
    """

    def count(w: Column) -> Column:
        windows = F.size(w) - 2
        bits = F.length(F.bin(F.size(w).cast("long")))
        slots = F.call_function("shiftleft", F.lit(1).cast("long"), bits)

        def place(key: Column) -> Column:
            return F.pmod(key, slots).cast("int")

        def same(a: Column, b: Column) -> Column:
            p, q = place(a), place(b)
            words_equal = [F.get(w, p + i) == F.get(w, q + i) for i in range(3)]
            return (a - place(a) == b - place(b)) & words_equal[0] & words_equal[1] & words_equal[2]

        keys = F.transform(
            F.slice(w, 1, windows),
            lambda x, i: F.call_function(
                "shiftleft",
                F.call_function("shiftright", F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)), bits),
                bits,
            )
            + i,
        )

        def positions(k: Column) -> Column:
            behind = F.slice(k, 2, F.size(k))
            twins = F.zip_with(
                F.slice(k, 1, F.size(k) - 1), behind, lambda a, b: F.when(same(a, b), F.array(place(a), place(b)))
            )
            found = F.filter(twins, lambda t: t.isNotNull())
            return F.array_sort(F.array_distinct(F.flatten(found)))

        def covered(p: Column) -> Column:
            gaps = F.zip_with(
                F.slice(p, 1, F.size(p) - 1),
                F.slice(p, 2, F.size(p)),
                lambda a, b: F.least(b - a, F.lit(3)),
            )
            total = F.aggregate(gaps, F.lit(3).cast("long"), lambda s, g: s + g)
            return F.when(F.size(p) == 0, F.lit(0).cast("long")).otherwise(total)

        found = let(let(F.sort_array(keys), positions), covered)
        return F.when(windows < 2, F.lit(0).cast("long")).otherwise(found)

    return let(words, count)


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    and the vector of ``NAMES``) for each row; null text has no words, and its vector is null."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        text.alias("text"),
    )
    counted = base.select(
        "doc_id",
        "lang",
        "source",
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(F.translate("text", LETTERS, ""))).alias("capitals"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again"))).alias("lines"),
        let(words_of(F.col("text")), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("again"))).alias("words"),
    )
    n = F.col("words.n")
    some = n > 0
    return counted.select(
        "doc_id",
        "lang",
        "source",
        n.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("lines.again").cast("long").alias("n_dup_lines"),
        F.col("words.again").alias("n_repeat_words"),
        ((n < MIN_WORDS) | (100 * F.col("words.again") > REPEAT_PERCENT * n)).alias("base_failed"),
        F.when(some, F.log(n.cast("double"))).alias("log_words"),
        F.when(some, F.log(F.col("word_chars") / n)).alias("log_word_length"),
        F.when(some, F.log1p(F.col("n_symbols") / n)).alias("symbols"),
        F.when(some, F.col("lines.again") / F.col("lines.n")).alias("duplicate_lines"),
        F.when(some, F.col("words.again") / n).alias("repeats"),
        F.when(some, F.col("capitals") / F.col("word_chars")).alias("capitals"),
    )


def _whitened(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Centre ``m_*``, inverse Cholesky factor ``w_i_j`` and half the log determinant ``spread``."""
    p = len(NAMES)
    table = moments
    for k in range(p):  # columns of the factor
        rest = [f"l_{i}_{k}" for i in range(k, p)]
        inner = [
            sum((F.col(f"l_{i}_{m}") * F.col(f"l_{k}_{m}") for m in range(k)), F.lit(0.0)) for i in range(k, p)
        ]
        pivot = F.sqrt(F.col(f"c_{k}_{k}") - inner[0])
        table = table.select("*", pivot.alias(rest[0]))
        table = table.select(
            "*",
            *[
                ((F.col(f"c_{k}_{i}") - x) / F.col(rest[0])).alias(name)
                for i, x, name in zip(range(k + 1, p), inner[1:], rest[1:], strict=True)
            ],
        )
    for k in range(p):  # rows of its inverse
        one = F.lit(1.0) / F.col(f"l_{k}_{k}")
        row = [
            (-one * sum((F.col(f"l_{k}_{m}") * F.col(f"w_{m}_{j}") for m in range(j, k)), F.lit(0.0))).alias(f"w_{k}_{j}")
            for j in range(k)
        ]
        table = table.select("*", *row, one.alias(f"w_{k}_{k}"))
    spread = sum((F.log(F.col(f"l_{k}_{k}")) for k in range(p)), F.lit(0.0))
    return table.select(
        *keys,
        "size",
        spread.alias("spread"),
        *[F.col(f"m_{k}") for k in range(p)],
        *[F.col(f"w_{k}_{j}") for k in range(p) for j in range(k + 1)],
    )


def _distance() -> Column:
    """Squared Mahalanobis distance of a row's vector under the estimate beside it."""
    total = F.lit(0.0)
    for k in range(len(NAMES)):
        y = sum(
            (F.col(f"w_{k}_{j}") * (F.col(NAMES[j]) - F.col(f"m_{j}")) for j in range(k + 1)), F.lit(0.0)
        )
        total = total + y * y
    return total


def _moments(rows: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Mean and floored covariance of the vectors of each group."""
    p = len(NAMES)
    means = [F.avg(x).alias(f"m_{i}") for i, x in enumerate(NAMES)]
    pairs = [
        (
            factor * F.covar_pop(NAMES[i], NAMES[j]) + (FLOORS[NAMES[i]] ** 2 if i == j else 0.0)
        ).alias(f"c_{i}_{j}")
        for i in range(p)
        for j in range(i, p)
    ]
    return rows.groupBy(*keys).agg(F.count("*").alias("size"), *means, *pairs)


def _beside(rows: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(rows) if small else rows


def estimates(vectors: DataFrame, small: bool = False) -> DataFrame:
    """The minimum covariance determinant estimate of each group of ``vectors``.

    ``vectors`` has ``group_lang``, ``group_source`` (both null-safe keys without nulls) and ``NAMES``.
    ``small`` states that the groups were counted to be at most ``BROADCAST_GROUPS``; otherwise
    the vectors are shuffled to their estimates.
    """
    p = len(NAMES)
    keys = ["group_lang", "group_source"]
    group = [*keys, "start"]
    classical = _whitened(_moments(vectors, keys, 1.0), keys).withColumn("start", F.lit(0))
    # robust by coordinate: medians, and half the range of the middle half
    quarters = vectors.groupBy(*keys).agg(
        F.count("*").alias("size"),
        *[F.percentile_approx(x, [0.25, 0.5, 0.75], 2000).alias(f"q_{i}") for i, x in enumerate(NAMES)],
    )
    middle = quarters.select(
        *keys,
        "size",
        *[F.col(f"q_{i}")[1].alias(f"m_{i}") for i in range(p)],
        *[
            (
                ((F.col(f"q_{i}")[2] - F.col(f"q_{i}")[0]) / 1.349) ** 2 + FLOORS[NAMES[i]] ** 2
                if i == j
                else F.lit(0.0)
            ).alias(f"c_{i}_{j}")
            for i in range(p)
            for j in range(i, p)
        ],
    )
    coordinate = _whitened(middle, keys).withColumn("start", F.lit(1))
    current = settled(classical.unionByName(coordinate), "estimates")
    for _ in range(STEPS):
        near = vectors.join(_beside(current, small), keys).withColumn("d2", _distance())
        limits = near.groupBy(*group).agg(F.percentile_approx("d2", SHARE, 2000).alias("limit"))
        nearest = near.select(*group, *NAMES, "d2").join(_beside(settled(limits, "limits"), small), group).where("d2 <= limit")
        current = settled(_whitened(_moments(nearest, group, CONSISTENCY), group), "estimates")
    best = current.groupBy(*keys).agg(F.min(F.struct("spread", "start"))["start"].alias("start"))
    return settled(current.join(best, group).drop("start"), "estimates")


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept).

    Null languages and sources form groups of their own. A document without words has no vector and
    fails the fixed rules. ``distance`` is null where a group is too small to judge. Repeated rows
    and null ids are judged like others; an empty table gives no rows; further columns are ignored. Of
    documents at one distance none is preferred; of two equal estimates the first start counts. Work on a very
    long text grows with its length.
    """
    rows = settled(statistics(docs), "statistics")
    lang, source = F.to_json(F.array("lang")), F.to_json(F.array("source"))
    sizes = rows.where("n_words > 0").groupBy(lang.alias("group_lang"), source.alias("own_source")).agg(F.count("*").alias("rows"))
    sizes = sizes.select(
        "group_lang",
        "own_source",
        F.when(F.col("rows") >= OWN_GROUP, F.col("own_source")).otherwise("").alias("group_source"),
    )
    groups = settled(sizes, "groups")
    small = groups.count() <= BROADCAST_GROUPS
    placed = rows.select("*", lang.alias("group_lang"), source.alias("own_source")).join(
        _beside(groups, small), ["group_lang", "own_source"], "left"
    )
    found = estimates(placed.where("n_words > 0").select("group_lang", "group_source", *NAMES), small)
    large = found.where(F.col("size") >= POOLED_GROUP * SHARE)
    judged = placed.join(_beside(large, small), ["group_lang", "group_source"], "left")
    distance = F.when(F.col("size").isNotNull(), _distance())
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        distance.alias("distance"),
        (~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= CUTOFF)).alias("kept"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
