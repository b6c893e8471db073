"""Apportionment against seats played out one by one, and the mix against its contract."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from wordloom.llm import mixing

FOLDER = "/root/testdata/sf0.001"


def played_out(votes, seats):
    """Seats of each party, the next one always to the highest quotient; ties to the smaller party."""
    won = Counter()
    for _ in range(seats if any(votes.values()) else 0):
        won[min(votes, key=lambda p: (-Fraction(votes[p], 2 * won[p] + 1), p))] += 1
    return {p: won[p] for p in votes}


def targets(sizes):
    """The contract's targets of (source, size) rows."""
    by_source = defaultdict(int)
    for source, size in sizes:
        by_source[source] += size
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    full, left, target = set(), sum(by_source.values()), {}
    while True:
        rest = left - sum(3 * by_source[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        target = {s: 3.0 * by_source[s] if s in full else rest * weight[s] / total for s in names}
        above = {s for s in names if s not in full and target[s] > 3 * by_source[s]}
        if not above:
            return by_source, target
        full |= above


@pytest.mark.parametrize("seed", range(4))
def test_apportion(spark, seed):
    rng = random.Random(seed)
    votes = {i: rng.choice([0, 1, 3, 7, rng.randrange(1, 2000)]) for i in range(rng.choice([1, 5, 40]))}
    seats = rng.choice([0, 1, 17, 500])
    table = spark.createDataFrame([(p, float(v)) for p, v in votes.items()], "party long, votes double")
    got = {r.party: r.seats for r in mixing.apportion(table, seats).collect()}
    assert got == played_out(votes, seats)


def test_apportion_within(spark):
    rng = random.Random(8)
    groups = {g: ({p: rng.randrange(60) for p in range(rng.randrange(1, 30))}, rng.randrange(200)) for g in range(6)}
    table = spark.createDataFrame(
        [(g, p, v, quota) for g, (votes, quota) in groups.items() for p, v in votes.items()],
        "grp long, party long, votes long, quota long",
    )
    got = {(r.grp, r.party): r.seats for r in mixing.apportion_within(table).collect()}
    expected = {
        (g, p): n for g, (votes, quota) in groups.items() for p, n in played_out(votes, quota).items()
    }
    assert got == expected


def check(rows, sizes, block):
    by_source, target = targets(sizes)
    taken, shards = Counter(), Counter()
    for r in rows:
        taken[r.source] += r.repeats * r.size + r.extra
        shards[r.source] += 1
        assert r.source_size == by_source[r.source]
        assert r.target == pytest.approx(target[r.source], rel=1e-9)
        assert 0 <= r.extra <= r.size and r.repeats * r.size + r.extra <= 3 * r.size
    for source, words in target.items():
        assert abs(taken[source] - words) <= block * (1 + shards[source] / mixing.SHARD_ROWS)
    assert sorted((r.source or "", r.size) for r in rows) == sorted((s or "", n) for s, n in sizes)


def test_documents(spark):
    rng = random.Random(5)
    rows = []
    for i in range(2000):
        source = rng.choice(["hot", "hot", "hot", "b", "", None, "é", "Z"])
        text = rng.choice([None, "", " \n", "w " * rng.randrange(1, 90), "same text of five words"])
        rows.append((rng.choice([i, 7, None]), text, source))
    rows += [(-1, "tiny source", "tiny"), (5, "  not a break", "Z")] + [(9, "a b c", "hot")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").select(
        "*", F.lit(1).alias("size"), F.lit(2).alias("target"), F.lit(3).alias("shard")
    )
    sizes = [(s, len((t or "").encode().split())) for _, t, s in rows]
    got = mixing.mix(docs).collect()
    check(got, sizes, 1)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    other = mixing.mix(docs, seed=14).collect()
    assert sorted(map(repr, got)) != sorted(map(repr, other))
    assert mixing.mix(docs.limit(0)).collect() == []


def test_a_document_is_not_taken_again_before_its_shard(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "ab"[i % 5 == 0]) for i in range(1000)], "doc_id long, text string, source string")
    got = mixing.mix(docs, block_words=10).collect()
    for source in "ab":
        assert len({r.repeats for r in got if r.source == source}) == 1
        assert sum(0 < r.extra < r.size for r in got if r.source == source) == 0


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    got = sorted((r.doc_id, r.size, r.source_size, r.target, r.repeats, r.extra) for r in mixing.mix(docs).collect())
    assert got == [(1, 0, 0, 0.0, 0, 0), (2, 0, 0, 0.0, 0, 0)]


def test_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 8)
    docs = spark.createDataFrame([(1, "a b c", "s")] * 50 + [(2, "d", "t")] * 3, "doc_id long, text string, source string")
    got = mixing.mix(docs, block_words=1).collect()
    check(got, [("s", 3)] * 50 + [("t", 1)] * 3, 1)


def test_query(spark):
    got = mixing.query(spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    _, target = targets([(d.source, len((d.text or "").encode().split())) for d in docs])
    source = {d.doc_id: d.source for d in docs}
    taken = Counter()
    for r in got:
        taken[source[r.doc_id]] += r.taken
        assert r.target == pytest.approx(target[source[r.doc_id]]) and r.taken <= 3 * r["size"]
    assert len(got) == len(docs)
    for s, words in target.items():
        assert taken[s] == pytest.approx(words, rel=2e-3)
