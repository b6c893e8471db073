"""Runs of repeated passages against brute force."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from wordloom.llm import periodic_runs
from wordloom.llm.periodic_runs import runs_of

FOLDER = "/root/testdata/sf0.001"


def brute(words):
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            end = j + q
            smaller = any(all(words[k] == words[k + d] for k in range(i, end - d)) for d in range(1, q))
            if end - i >= max(24, 3 * q) and not smaller:
                found.append((i, end - i, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def digest(text, doc_id):
    """The row of the contract, word for word."""
    words = [w.decode() for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    sha = [
        hashlib.sha256(x.encode()).hexdigest()
        for x in ("".join(f"{s},{ln},{q}\n" for s, ln, q in runs), " ".join(collapse(words, runs)))
    ]
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha)


def rows(df):
    columns = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_random_words_against_brute_force():
    rng = random.Random(1)
    found = 0
    for _ in range(800):
        n, letters = rng.randrange(140), rng.choice([1, 2, 2, 3, 5, 50])
        words = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randrange(3)):
            if n > 30:
                a, q = rng.randrange(n), rng.randrange(1, 15)
                for i in range(a + q, min(n, a + rng.randrange(20, 80))):
                    words[i] = words[i - q]
        for _ in range(rng.randrange(3)):
            if n:
                words[rng.randrange(n)] = 99
        expected = brute(words)
        found += len(expected)
        assert runs_of(words) == expected
    assert found > 200


@pytest.mark.parametrize(
    "words, runs",
    [
        (["a"] * 23, []),
        (["a"] * 24, [(0, 24, 1)]),
        (["a", "b", "c", "d", "e", "f", "g", "h"] * 3, [(0, 24, 8)]),
        ([str(i) for i in range(9)] * 3, [(0, 27, 9)]),
        ([str(i) for i in range(9)] * 3 + ["0"], [(0, 28, 9)]),
        (([str(i) for i in range(9)] * 3)[:-1], []),
        (["a"] * 30 + ["b"] + ["a"] * 30, [(0, 30, 1), (31, 30, 1)]),
        ((["a"] * 30 + ["b"]) * 3, [(0, 30, 1), (0, 93, 31), (31, 30, 1), (62, 30, 1)]),
    ],
)
def test_borders(words, runs):
    assert runs_of(words) == runs == brute(words)


def test_words_of_self_similar_order():
    a, b = ["a"], ["a", "b"]
    while len(b) < 600:
        a, b = b, b + a
    assert runs_of(b) == brute(b)


def test_very_long_texts():
    passage = [f"w{i}" for i in range(20_000)]
    assert runs_of(["x"] + passage * 5 + ["y"]) == [(1, 100_000, 20_000)]
    assert runs_of(["a"] * 200_000) == [(0, 200_000, 1)]


def test_rows(spark):
    """Nulls, no words, repeated rows, null ids, clashing columns, odd white space, ties, an empty table."""
    tie = "p q r " * 9 + "x " + "s t u " * 9  # two runs of nine periods; the first counts
    texts = [None, "", " \n\t ", tie, tie, "a b " * 40, "z\x1cz " * 30, "é\x0bf\x0c" * 12, "one two"]
    table = [(i, t) for i, t in enumerate(texts)] + [(3, tie), (None, "k " * 25)]
    docs = spark.createDataFrame(table, "doc_id long, text string").select(
        "*", F.lit(1).alias("runs"), F.lit("c").alias("collapsed"), F.lit(0).alias("words")
    )
    got = {}
    for r in periodic_runs.periodic_runs(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        words = [w.decode("utf-8") for w in (text or "").encode().split()]
        runs = brute(words)
        for r in got[i]:
            assert (r.n_words, [tuple(x) for x in r.runs]) == (len(words), runs)
            assert r.collapsed == " ".join(collapse(words, runs))
    assert len(got[3]) == 2 and tuple(got[3][0].best) == (0, 27, 3)
    assert got[None][0].collapsed == "k"
    assert periodic_runs.periodic_runs(docs.limit(0)).collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    short = [d for d in docs if len(d.text or "") < 6000]
    expected = sorted((digest(d.text, d.doc_id) for d in short), key=repr)
    ids = {d.doc_id for d in short}
    got = [r for r in rows(periodic_runs.query(spark, FOLDER)) if r[0] in ids]
    assert got == expected
    assert sum(r[1] > 0 for r in got) > 5
