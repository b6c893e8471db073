import random
import re
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wordloom import operators as op

LINE = "New York city, York city."
VOCABULARY = ["york", "city"]


def counts(df):
    return {(r.word, r.neighbor): r.cnt for r in df.collect()}


def stripe_dict(df):
    return {r.word: {e.neighbor: e.cnt for e in r.entries} for r in df.collect()}


@pytest.mark.parametrize(
    "d, apart, same",
    [(1, 3, None), (2, 3, 2), (3, 4, 2)],
)
def test_fixture(texts, d, apart, same):
    expected = {("york", "city"): apart, ("city", "york"): apart}
    if same:
        expected |= {("york", "york"): same, ("city", "city"): same}
    assert counts(op.cooccurrence_pairs(texts(LINE), d, VOCABULARY)) == expected


def test_fixture_stripes(texts):
    stripes = op.vocabulary_stripes(texts(LINE), 2, VOCABULARY)
    assert stripe_dict(stripes) == {
        "city": {"city": 2, "york": 3},
        "york": {"city": 3, "york": 2},
    }


def test_distance_counts_filtered_tokens(texts):
    docs = texts("york x x city")
    assert counts(op.cooccurrence_pairs(docs, 2, VOCABULARY)) == {}
    expected = {("york", "city"): 1, ("city", "york"): 1}
    assert counts(op.cooccurrence_pairs(docs, 3, VOCABULARY)) == expected
    assert counts(op.cooccurrence_pairs(docs, 3, None, ["x"])) == expected


@pytest.mark.parametrize("end", ["\n", "\r", "\r\n"])
def test_scope(texts, end):
    docs = texts(f"york{end}city")
    assert counts(op.cooccurrence_pairs(docs, 5, VOCABULARY)) == {}
    both = {("york", "city"): 1, ("city", "york"): 1}
    assert counts(op.cooccurrence_pairs(docs, 1, VOCABULARY, scope="document")) == both


def test_empty_stripes(texts):
    docs = texts("hello", "a b", None, "stop")
    stripes = op.all_word_stripes(docs, 1, ["stop"], parts=1)
    assert stripe_dict(stripes) == {"hello": {}, "a": {"b": 1}, "b": {"a": 1}}
    assert stripe_dict(op.vocabulary_stripes(docs, 1, ["hello", "a", "b"])) == {
        "a": {"b": 1},
        "b": {"a": 1},
    }


def test_vocabulary_without_stopwords(texts):
    docs = texts("york the city")
    stripes = op.vocabulary_stripes(docs, 2, ["york", "the", "city"], ["the"])
    assert stripe_dict(stripes) == {"york": {"city": 1}, "city": {"york": 1}}


def test_arguments(texts):
    docs = texts("a b")
    for bad in (0, -1, 1.5, "2"):
        with pytest.raises(ValueError, match="distance"):
            op.cooccurrence_pairs(docs, bad)
    with pytest.raises(ValueError, match="parts"):
        op.all_word_stripes(docs, 1, parts=0)
    with pytest.raises(ValueError, match="scope"):
        op.cooccurrence_pairs(docs, 1, scope="page")


# --- against brute force ------------------------------------------------------------------

SPLIT = {"alnum": r"[^a-z0-9]+", "nonword": r"[^a-zA-Z0-9_]+"}


def brute_force(docs, d, tokenizer, vocabulary=None, stopwords=()):
    found, seen = Counter(), set()
    for text in docs:
        for line in re.split(r"\r\n|\r|\n", text):
            words = re.split(SPLIT[tokenizer], line.lower())
            kept = [
                (i, w)
                for i, w in enumerate(words)
                if w and w not in stopwords and (vocabulary is None or w in vocabulary)
            ]
            seen.update(w for _, w in kept)
            for i, w in kept:
                for j, n in kept:
                    if i != j and abs(i - j) <= d:
                        found[w, n] += 1
    return dict(found), seen


def corpus(seed, skewed):
    """Random lines; in the skewed corpus one word holds about half of all tokens."""
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "x_1", "Delta", "7", "the", "of"]
    weights = [len(words) if skewed and w == "the" else 1 for w in words]

    def line():
        chosen = rng.choices(words, weights, k=rng.randrange(12))
        return "".join(w + rng.choice([" ", ", ", "--", "  "]) for w in chosen)

    return ["\n".join(line() for _ in range(rng.randrange(4))) for _ in range(60)]


@pytest.mark.parametrize("skewed", [False, True])
@pytest.mark.parametrize("d", [1, 2, 3, 4, 20])
def test_pairs_and_stripes_against_brute_force(texts, d, skewed):
    docs = corpus(d, skewed)
    table = texts(*docs)
    vocabulary = ["alpha", "beta", "the", "7"]
    expected, _ = brute_force(docs, d, "alnum", vocabulary)
    pairs = op.cooccurrence_pairs(table, d, vocabulary)
    assert counts(pairs) == expected
    assert all(expected[n, w] == c for (w, n), c in expected.items())

    expected, seen = brute_force(docs, d, "nonword", None, ["of"])
    stripes = op.all_word_stripes(table, d, ["of"], parts=1)
    assert counts(op.stripes_to_pairs(stripes)) == expected
    assert set(stripe_dict(stripes)) == seen


def test_the_size_of_the_lists_changes_no_result(spark, texts, monkeypatch):
    docs = corpus(4, True)
    table = texts(*docs)
    vocabulary, stopwords = ["alpha", "beta", "the", "of", "7"], ["of"]
    kept = set(vocabulary) - set(stopwords)
    expected, _ = brute_force(docs, 3, "alnum", kept)
    listed = spark.createDataFrame([(w,) for w in vocabulary], "word string")
    for small in (True, False, None):
        for words in (vocabulary, listed):
            pairs = op.cooccurrence_pairs(table, 3, words, stopwords, small_lists=small)
            assert counts(pairs) == expected
        sweep = op.cooccurrence_sweep(table, [3], listed, stopwords, small_lists=small)
        assert {(r.word, r.neighbor): r.cnt_d3 for r in sweep.collect()} == expected
    small, large = (
        stripe_dict(op.all_word_stripes(table, 2, ["of", "the"], parts=1, small_lists=x)) for x in (True, False)
    )
    assert small == large


def test_sweep_columns_equal_single_runs(texts):
    table = texts(*corpus(5, False))
    sweep = op.cooccurrence_sweep(table, [4, 1, 2]).collect()
    for d in (1, 2, 4):
        got = {(r.word, r.neighbor): r[f"cnt_d{d}"] for r in sweep if r[f"cnt_d{d}"]}
        assert got == counts(op.cooccurrence_pairs(table, d))


def test_three_forms_of_the_window_agree(texts, spark):
    """The zipped arrays give what a band self-join gives, and what ``lead`` gives."""
    table = texts(*corpus(8, True))
    d = 3
    lines = table.select(
        "doc_id", F.posexplode(F.split("text", "\r\n|\r|\n")).alias("line_no", "line")
    )
    tokens = lines.select(
        "doc_id",
        "line_no",
        F.posexplode(F.split(F.lower("line"), "[^a-z0-9]+")).alias("pos", "word"),
    )
    left, right = tokens.alias("l"), tokens.alias("r")
    gap = F.col("l.pos") - F.col("r.pos")
    band = (
        left.join(right, ["doc_id", "line_no"])
        .where((F.abs(gap) <= d) & (gap != 0))
        .where((F.col("l.word") != "") & (F.col("r.word") != ""))
        .groupBy(F.col("l.word").alias("word"), F.col("r.word").alias("neighbor"))
        .agg(F.count("*").alias("cnt"))
    )
    order = Window.partitionBy("doc_id", "line_no").orderBy("pos")
    leads = F.array(*(F.lead("word", k).over(order) for k in range(1, d + 1)))
    ahead = tokens.select("word", leads.alias("leads"))
    ahead = ahead.select("word", F.explode("leads").alias("n"))
    ahead = ahead.where((F.col("word") != "") & (F.col("n") != ""))
    lead = (
        ahead.unionAll(ahead.select(F.col("n"), F.col("word")))
        .groupBy("word", F.col("n").alias("neighbor"))
        .agg(F.count("*").alias("cnt"))
    )
    expected = counts(op.cooccurrence_pairs(table, d))
    assert counts(band) == expected
    assert counts(lead) == expected


# --- stripes ------------------------------------------------------------------------------


def test_parts_hold_all_of_a_stripe(spark, texts):
    # "hub" has 200 neighbors, more than a third of all pairs; the others have few.
    table = texts(*[f"hub w{i}" for i in range(200)], "lone", "p q", "hub")
    whole = op.all_word_stripes(table, 1, parts=1)
    split = op.all_word_stripes(table, 1, parts=20)
    assert counts(op.stripes_to_pairs(split)) == counts(op.stripes_to_pairs(whole))
    parts = split.collect()
    hub = [r for r in parts if r.word == "hub"]
    assert {r.part for r in hub} == set(range(20))
    assert max(len(r.entries) for r in hub) < 30
    assert {r.word for r in parts} == {r.word for r in parts if r.part == 0}
    assert all(r.entries or r.part == 0 for r in parts)
    assert [r.word for r in op.isolated_words(split).collect()] == ["lone"]
    for r in parts:
        names = [e.neighbor for e in r.entries]
        assert names == sorted(names)
    assert all(r.part == 0 for r in whole.collect())


@pytest.mark.parametrize("parts", [1, 3])
def test_stripe_sweeps_equal_single_runs(texts, parts):
    table = texts(*corpus(6, True))

    def dicts(df):
        return {(r.word, r.part): {e.neighbor: e.cnt for e in r.entries} for r in df.collect()}

    def at(sweep, d):
        entries = op.stripe_at(F.col("entries"), f"cnt_d{d}").alias("entries")
        return dicts(sweep.select("word", "part", entries))

    everything = op.all_word_stripes_sweep(table, (1, 2, 4), ["of"], parts=parts)
    vocabulary = op.vocabulary_stripes_sweep(table, (1, 2, 4), ["alpha", "the", "7"], parts=parts)
    for d in (1, 2, 4):
        single = dicts(op.all_word_stripes(table, d, ["of"], parts=parts))
        swept = at(everything, d)
        assert {k: v for k, v in swept.items() if v or k[1] == 0} == single
        single = dicts(op.vocabulary_stripes(table, d, ["alpha", "the", "7"], parts=parts))
        assert {k: v for k, v in at(vocabulary, d).items() if v} == single


def test_stripe_maps_and_merge(texts):
    first = op.all_word_stripes(texts("a b", "a c", "x"), 1, parts=1)
    second = op.all_word_stripes(texts("b a", "y"), 1, parts=2)
    maps = {r.word: r.stripe for r in op.stripe_maps(first).collect()}
    assert maps == {"a": {"b": 1, "c": 1}, "b": {"a": 1}, "c": {"a": 1}, "x": {}}
    assert stripe_dict(op.merge_stripes(first, second, parts=1)) == {
        "a": {"b": 2, "c": 1},
        "b": {"a": 2},
        "c": {"a": 1},
        "x": {},
        "y": {},
    }
