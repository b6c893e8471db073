"""URL filters: rules by host and path, else naive Bayes over segmented host names (operator 5).

Rules are joined to the distinct hosts by host suffix; the longest rule that fits decides. Urls that
some rule decides are the examples from which a multinomial naive Bayes model learns which tokens
go with which verdict; it judges the others. Tokens are the words of the host and of the path.

Host labels are concatenated words (``blogthere``). Every substring of a distinct label that occurs
as a word in the pages' titles gets that word's log probability, an unknown substring a penalty that
grows with its length, and a Viterbi pass takes the most probable split of the label.

All of it runs on distinct hosts, labels and path skeletons; only the last join has a row per page.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.shared import settled

#: The rules as (host, start of the path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Longest word that a label is split into.
LONGEST = 24
#: Bytes up to which the hosts' rules are broadcast to the urls.
BROADCAST_BYTES = 32 << 20
#: Added to each token count.
SMOOTHING = 1.0


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (host, path, ...) with ``rule`` and ``rule_verdict`` of the longest rule that fits.

    ``rules`` has (host, path, verdict). Of rules of one length the one that allows counts. Each
    distinct host carries the rules of its suffixes, which are as many as the rules for them.
    """
    hosts = urls.select("host").distinct()
    labels = F.split("host", r"\.", -1)
    suffixes = hosts.select(
        "host",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
        ).alias("suffix"),
    )
    own = rules.select(
        F.col("host").alias("suffix"),
        F.struct(
            F.length(F.concat("host", "path")).alias("size"),
            (F.col("verdict") == "allow").alias("allows"),
            F.col("path").alias("start"),
            F.concat("host", "path").alias("rule"),
            F.col("verdict").alias("verdict"),
        ).alias("rule"),
    )
    found = suffixes.join(own, "suffix").groupBy("host").agg(F.collect_list("rule").alias("_rules"))
    found = settled(found, "host-rules")
    size = found.agg(F.sum(F.length(F.to_json(F.struct("*")))).alias("n")).first().n or 0
    if size <= BROADCAST_BYTES:
        found = F.broadcast(found)
    joined = urls.join(found, "host", "left")
    fits = F.filter("_rules", lambda r: F.startswith(F.col("path"), r["start"]))
    best = F.array_max(fits)
    return joined.select(*urls.columns, best["rule"].alias("rule"), best["verdict"].alias("rule_verdict"))


def word_counts(titles: DataFrame) -> DataFrame:
    """(word, n) of the runs of letters in ``title``, lower-cased, of two letters or more."""
    words = F.explode(F.split(F.lower("title"), r"[^\p{L}]+", -1))
    return titles.select(words.alias("word")).where(F.length("word") > 1).groupBy("word").agg(F.count("*").alias("n"))


def viterbi(label: str, known: dict[tuple[int, int], float], total: float) -> list[str]:
    """The most probable split of a label; of equally probable ones, that with the longest last word."""
    best, since = [0.0], [0]
    for end in range(1, len(label) + 1):
        top, at = -math.inf, 0
        for start in range(max(0, end - LONGEST), end):
            score = known.get((start, end))
            if score is None:
                score = math.log(1 / total) - (end - start) * math.log(10)
            if best[start] + score > top:
                top, at = best[start] + score, start
        best.append(top)
        since.append(at)
    words, end = [], len(label)
    while end:
        words.append(label[since[end] : end])
        end = since[end]
    return words[::-1]


def segment(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words) of distinct, not empty labels."""
    total = float((counts.agg(F.sum("n").alias("n")).first().n or 0) + 1)
    places = labels.select("label", F.explode(F.sequence(F.lit(0), F.length("label") - 1)).alias("start"))
    pieces = places.select(
        "label",
        "start",
        F.explode(
            F.sequence(F.col("start") + 1, F.least(F.col("start") + LONGEST, F.length("label")))
        ).alias("end"),
    ).withColumn("word", F.expr("substring(label, start + 1, end - start)"))
    known = (
        pieces.join(counts, "word")
        .groupBy("label")  # a label has at most LONGEST substrings for each of its characters
        .agg(F.collect_list(F.struct("start", "end", F.log(F.col("n") / total).alias("score"))).alias("known"))
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for label, found in zip(batch.column("label").to_pylist(), batch.column("known").to_pylist(), strict=True):
                edges = {(x["start"], x["end"]): x["score"] for x in found or []}
                words.append(viterbi(label, edges, total))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(words, pa.list_(pa.string()))], names=["label", "words"]
            )

    return labels.join(known, "label", "left").select("label", "known").mapInArrow(split, "label string, words array<string>")


def tokens(keys: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, skeleton, token, times) of distinct (host, skeleton)."""
    parts = keys.select("host").distinct().select("host", F.explode(F.split("host", r"[^\p{L}\p{N}]+", -1)).alias("label"))
    parts = parts.where("label <> ''")
    words = segment(parts.select("label").distinct(), counts)
    by_host = parts.join(words, "label").select("host", F.explode("words").alias("word")).groupBy("host", "word").agg(F.count("*").alias("times"))
    host_tokens = keys.join(by_host, "host").select("host", "skeleton", F.concat(F.lit("h:"), "word").alias("token"), "times")
    path_words = keys.select("host", "skeleton", F.explode(F.split("skeleton", r"[^\p{L}\p{N}#]+", -1)).alias("word"))
    path_tokens = (
        path_words.where("word <> ''")
        .select("host", "skeleton", F.concat(F.lit("p:"), F.lower("word")).alias("token"))
        .groupBy("host", "skeleton", "token")
        .agg(F.count("*").alias("times"))
    )
    return host_tokens.unionByName(path_tokens)


def filter_urls(pages: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for each row of (page_id, url, html).

    ``score`` is the log odds of block against allow and null where a rule decides; equal odds
    allow. A null url, or one without ``://``, has an empty host and path and no tokens: the share
    of blocked examples decides. Without any rule all urls are allowed. A null html has no title.
    Further columns are ignored, repeated rows are judged alike, an empty table gives no rows. Work on a very
    long url or page grows with its length; of equally probable splits the one with the longest last word counts.
    """
    spark = pages.sparkSession
    if rules is None:
        rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    urls = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
    ).withColumn("skeleton", F.regexp_replace("path", "[0-9]+", "#"))
    ruled = matched_rules(urls, rules)
    titles = pages.select(F.regexp_extract("html", r"(?i)<title[^>]*>([^<]*)", 1).alias("title"))
    keys = (
        ruled.groupBy("host", "skeleton")
        .agg(
            F.sum((F.col("rule_verdict") == "allow").cast("long")).alias("allow"),
            F.sum((F.col("rule_verdict") == "block").cast("long")).alias("block"),
            F.sum(F.col("rule_verdict").isNull().cast("long")).alias("open"),
        )
        .select("host", "skeleton", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("allow", "block", "open")])
    )
    keys = settled(keys, "url-keys")
    words = settled(word_counts(titles), "title-words")  # the html is read once
    found = tokens(keys.select("host", "skeleton"), words)
    placed = settled(found.join(keys, ["host", "skeleton"]), "url-tokens")
    model = placed.groupBy("token").agg(
        F.sum(F.col("times") * F.col("allow")).alias("allow"), F.sum(F.col("times") * F.col("block")).alias("block")
    ).where("allow + block > 0")
    total = model.agg(
        F.sum("allow").alias("allow"), F.sum("block").alias("block"), F.count("*").alias("tokens")
    ).first()
    judged_urls = keys.agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).first()
    allowed, blocked = judged_urls.allow or 0, judged_urls.block or 0
    size = total.tokens * SMOOTHING
    prior = math.log((blocked + 1) / (allowed + 1))
    odds = F.log((F.col("block") + SMOOTHING) / ((total.block or 0) + size + 1)) - F.log(
        (F.col("allow") + SMOOTHING) / ((total.allow or 0) + size + 1)
    )
    weights = model.select("token", odds.alias("weight"))
    scored = (
        placed.where("open > 0")
        .select("host", "skeleton", "token", "times")
        .join(weights, "token")
        .groupBy("host", "skeleton")
        .agg(F.sum(F.col("times") * F.col("weight")).alias("sum"))
    )
    scored = settled(scored, "url-scores")  # so that the join may split a hot host
    judged = ruled.join(scored, ["host", "skeleton"], "left")
    score = F.when(F.col("rule").isNull(), F.coalesce("sum", F.lit(0.0)) + F.lit(prior))
    if allowed + blocked == 0:
        score = F.when(F.col("rule").isNull(), F.lit(0.0))
    return judged.select("page_id", "host", "path", "rule", "rule_verdict", score.alias("score")).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
        "score",
    )


def query(spark, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
