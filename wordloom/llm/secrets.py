"""Secret scans by a trigram inverted index (operator 1), in DataFrame functions only.

A Boolean trigram query is derived from each rule's pattern. The index holds, for every trigram that
some query asks for, the documents whose lower-cased text has it, as rows. A rule's postings are
intersected per alternative by counting; the documents of any alternative are its candidates, and
only there does the pattern run. Rules without mandatory trigrams, such as runs of hexadecimal
digits, are run on every document.

Matches are leftmost and do not overlap within a kind; a match whose value is too short is
dropped, and the text behind it is searched on. Positions count code points.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.expressions import let
from wordloom.llm.shared import settled
from wordloom.llm.trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    """``least`` is the smallest length of ``group``, the value inside a match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base rules in the order of their kinds. In the second and third a run is as
#: long as it can be, so that its least length may stand in the pattern.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)

#: Published shapes of further credentials.
MORE = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("bearer", r"(?i:bearer)\x20+([A-Za-z0-9._~+/-]+)", 1, 20),
    Rule("url_login", r"(?:https?|ftp|mysql|postgres|mongodb|redis|amqp)://[A-Za-z0-9._~-]+:([A-Za-z0-9._~!-]+)@", 1, 6),
)

RULES = BASE + MORE
#: What takes a secret's place.
MASK = "[secret]"

#: Numbers of a block whose sums are taken together, and levels of such blocks.
STEP, LEVELS = 64, 3
#: Characters of a text that are cut at once where it is masked.
CUT = 1024
#: Candidates are broadcast up to so many bytes and joined by shuffle beyond.
BROADCAST_BYTES = 32 << 20

SPAN = "struct<start: bigint, rank: int, kind: string, end: bigint>"


def _prefixes(values: Column, fold: Callable[[Column, Column], Column], levels: int = LEVELS) -> Column:
    """For each number of an array, the fold of 0 and the numbers before it.

    Blocks are folded first, then the folds of the blocks before each block; a value costs half a block.
    """

    def folded(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), fold)

    def direct(every: Column) -> Column:
        return F.transform(every, lambda _, i: folded(F.slice(every, 1, i)))

    def in_blocks(every: Column) -> Column:
        last = F.floor((F.size(every) - 1) / STEP).cast("int")
        starts = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))
        blocks = F.transform(starts, lambda b: F.slice(every, b * STEP + 1, STEP))

        def spread(parts: Column) -> Column:
            before = _prefixes(F.transform(parts, folded), fold, levels - 1)
            return let(
                before,
                lambda x: F.flatten(
                    F.transform(
                        parts,
                        lambda part, i: F.transform(part, lambda _, j: fold(F.get(x, i), folded(F.slice(part, 1, j)))),
                    )
                ),
            )

        return let(blocks, spread)

    return let(values, in_blocks if levels else direct)


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's matches in ``text``. What ``split`` leaves between them gives their places."""
    parts = F.struct(
        F.split(text, rule.pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("found"),
    )

    def place(p: Column) -> Column:
        sizes = F.transform(
            p["found"], lambda m, i: (F.length(m) + F.length(F.get(p["between"], i))).cast("long")
        )

        def span(before: Column) -> Column:
            def one(match: Column, i: Column) -> Column:
                start = F.get(before, i) + F.length(F.get(p["between"], i))
                return F.struct(
                    start.cast("long").alias("start"),
                    F.lit(rank).alias("rank"),
                    F.lit(rule.kind).alias("kind"),
                    (start + F.length(match)).cast("long").alias("end"),
                )

            every = F.transform(p["found"], one)
            if not rule.least:
                return every
            return F.filter(
                every,
                lambda _, i: F.length(F.regexp_extract(F.get(p["found"], i), rule.pattern, rule.group)) >= rule.least,
            )

        return let(_prefixes(sizes, _sum), span)

    return F.when(text.rlike(rule.pattern), let(parts, place))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, kinds): documents that satisfy a rule's trigram query, from the inverted index."""
    wanted = [
        (rule.kind, branch, trigram, len(alternative))
        for rule in rules
        for branch, alternative in enumerate(trigram_query(rule.pattern) or [])
        for trigram in sorted(alternative)
    ]
    spark = docs.sparkSession
    queries = spark.createDataFrame(wanted, "kind string, branch int, trigram string, need long")
    every = F.array(*[F.lit(t) for t in sorted({t for *_, t, _ in wanted})])
    own = let(F.lower("text"), lambda low: F.filter(every, lambda t: F.contains(low, t)))
    index = docs.where("doc_id is not null and text is not null").select(
        F.explode(own).alias("trigram"), F.col("doc_id").cast("long").alias("doc_id")
    )
    return (
        index.join(F.broadcast(queries), "trigram")  # one row per trigram of a rule
        .groupBy("doc_id", "kind", "branch", "need")
        .agg(F.count("*").alias("met"))
        .where("met >= need")
        .groupBy("doc_id")
        .agg(F.collect_set("kind").alias("kinds"))  # at most one entry per rule
    )


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(row, spans): each row of ``docs`` as a struct with its secrets.

    ``spans`` holds (start, rank, kind, end) in order of start, then rank (the rules' order); matches of several
    rules at one place are all listed. Null and empty texts have none. Rows of one id share their candidate
    rules and are each verified on their own text; rows without id are scanned by every rule. All columns are
    kept inside ``row``, so that no name can clash. An empty table gives no rows. Work on a very long text grows
    with its length and, slowly, with its matches. Few candidates are broadcast to the texts; only if they
    are many are the texts shuffled.
    """
    found = settled(candidates(docs, rules), "candidates").select(F.col("doc_id").alias("_found_id"), F.col("kinds").alias("_kinds"))
    size = found.agg(F.sum(F.length(F.to_json(F.struct("*")))).alias("n")).first().n or 0
    if size <= BROADCAST_BYTES:
        found = F.broadcast(found)
    packed = docs.select(F.struct("*").alias("_row"))
    joined = packed.join(found, F.col("_row.doc_id").cast("long") == F.col("_found_id"), "left")
    text = F.col("_row.text").cast("string")
    parts = []
    for rank, rule in enumerate(rules):
        spans = _spans(text, rule, rank)
        if trigram_query(rule.pattern) is not None:
            likely = F.array_contains("_kinds", rule.kind) | F.col("_row.doc_id").isNull()
            spans = F.when(likely, spans)
        parts.append(F.coalesce(spans, F.from_json(F.lit("[]"), f"array<{SPAN}>")))
    return joined.select(F.col("_row").alias("row"), F.array_sort(F.concat(*parts)).alias("spans"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with ``MASK`` for each span, one for spans that overlap. Positions are found in blocks of it."""

    def piece(blocks: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / CUT).cast("int"), F.floor((end - 1) / CUT).cast("int")
        cut = F.transform(
            F.slice(blocks, first + 1, last - first + 1),
            lambda block, i: F.substring(
                block,
                (F.greatest(start - (first + i) * CUT, F.lit(0)) + 1).cast("int"),
                (F.least(end - (first + i) * CUT, F.lit(CUT)) - F.greatest(start - (first + i) * CUT, F.lit(0))).cast("int"),
            ),
        )
        return F.when(start < end, F.array_join(cut, "")).otherwise("")

    def masked(p: Column) -> Column:
        def pieces(reach: Column) -> Column:
            each = F.transform(
                p["spans"],
                lambda s, i: F.when(
                    s["start"] >= F.get(reach, i),
                    F.concat(piece(p["blocks"], F.get(reach, i), s["start"]), F.lit(MASK)),
                ).otherwise(""),
            )
            tail = F.greatest(F.get(reach, F.size(reach) - 1), F.get(p["spans"], F.size(p["spans"]) - 1)["end"])
            return F.concat(F.array_join(each, ""), piece(p["blocks"], tail, p["size"]))

        ends = F.transform(p["spans"], lambda s: s["end"])
        return let(_prefixes(ends, lambda a, b: F.greatest(a, b)), pieces)

    parts = F.struct(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0)).alias("blocks"),
        spans.alias("spans"),
        F.length(text).cast("long").alias("size"),
    )
    return let(parts, masked)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with each secret replaced by ``MASK``; overlapping ones share a mask.

    ``n_chars``, if there is such a column, follows the new text.
    """
    found = find_secrets(docs, rules)
    text = F.col("row.text").cast("string")
    new = F.when(F.size("spans") > 0, _masked(text, F.col("spans"))).otherwise(text)
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(new.alias("text"))
        elif name == "n_chars":
            kept = F.col("row.n_chars")
            columns.append(F.when(F.size("spans") > 0, F.length(new)).otherwise(kept).cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col("row").getField(name).alias(name))
    return found.select(*columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = len(BASE)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return find_secrets(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        *[count(rule.kind) for rule in BASE],
        F.sha2(spans_text(F.filter("spans", lambda s: s["rank"] < base)).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def _oracle() -> str:
    """DuckDB: the same spans by running every pattern on every text, without an index."""

    def spans(rank: int, rule: Rule) -> str:
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        good = "true"
        if rule.least:
            good = f"length(regexp_extract(found[i], {pattern}, {rule.group})) >= {rule.least}"
        return f"""
        SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, found, between,
               list_filter(range(1, len(found) + 1), lambda i: {good}) AS good
        FROM (SELECT doc_id, regexp_extract_all(t, {pattern}, 0) AS found,
                     string_split_regex(t, {pattern}) AS between FROM d)"""

    every = " UNION ALL ".join(spans(rank, rule) for rank, rule in enumerate(RULES))
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    parts AS ({every}),
    single AS (
        SELECT doc_id, rank, kind, found, between, unnest(good) AS i FROM parts
    ),
    placed AS (
        SELECT doc_id, rank, kind, length(found[i]) AS size,
               list_sum(list_transform(between[1:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start
        FROM single
    ),
    named AS (
        SELECT doc_id, rank, kind, start,
               kind || ':' || CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(start + size AS BIGINT) AS VARCHAR) AS span
        FROM placed
    ),
    grouped AS (
        SELECT doc_id,
               count(*) FILTER (kind = 'assign') AS n_assign,
               count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex,
               coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}), '') AS base,
               string_agg(span, ',' ORDER BY start, rank) AS spans
        FROM named GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
           coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
           coalesce(spans, '') AS spans
    FROM d LEFT JOIN grouped USING (doc_id)
    """


ORACLE = _oracle()
