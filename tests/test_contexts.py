"""Words counted where their contexts meet, against brute force and the plans of pairs."""

import io
import random
from collections import Counter
from contextlib import redirect_stdout

import pytest

from wordloom import operators as op
from wordloom.operators import bands, cooccurrence


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.fixture
def lines():
    """One word in three is the same; others are rare, stand again, or stand alone."""
    rng = random.Random(7)

    def word():
        return rng.choice(["hot", f"w{rng.randrange(6)}", f"rare{rng.randrange(400)}"])

    return [" ".join(word() for _ in range(n)) for n in (0, 1, 2, 30, 63, 64, 65, 129, 400)] + ["alone", "hot"]


@pytest.fixture
def docs(texts, lines):
    return texts(*lines, None, "", lines[-3])


def brute(lines, d, drop=()):
    found = Counter()
    for line in lines:
        words = line.split()
        for i, a in enumerate(words):
            for b in words[i + 1 : i + d + 1]:
                if a not in drop and b not in drop:
                    found[min(a, b), max(a, b)] += 1
    return dict(found)


@pytest.mark.parametrize("hot", [0, 1, 4, 10_000])
@pytest.mark.parametrize("d", [1, 40, 70, 500])
def test_wide_windows_of_all_words(docs, lines, hot, d):
    from wordloom.operators.contexts import context_counts, hot_words

    words = hot_words(docs, k=hot)
    both = bands.band_counts(docs, d, [words]).unionByName(context_counts(docs, d, words)).collect()
    assert {(r.a, r.b): r.cnt for r in both} == brute([*lines, lines[-3]], d) and len(both) == len({r[:2] for r in both})


def test_wide_windows_ship_contexts_instead_of_pairs(docs, lines):
    text = plan(op.cooccurrence_pairs(docs, 40))
    assert "Exchange hashpartitioning(home" in text and "Join" not in text
    stopped = op.cooccurrence_pairs(docs, 40, None, ["hot", "w1"]).collect()
    expected = brute([*lines, lines[-3]], 40, ("hot", "w1"))
    assert {(r.word, r.neighbor): r.cnt for r in stopped if r.word < r.neighbor} == {p: n for p, n in expected.items() if p[0] < p[1]}
    assert {r.word: r.cnt for r in stopped if r.word == r.neighbor} == {a: 2 * n for (a, b), n in expected.items() if a == b}


def test_wide_windows_of_nothing(spark, texts):
    assert op.cooccurrence_pairs(texts(None, "", "one"), 40).count() == 0
    assert op.cooccurrence_pairs(spark.createDataFrame([], "text string"), 40).count() == 0
    alone = op.all_word_stripes(texts("one", None, "the"), 40, ["the"], parts=2).collect()
    assert [(r.word, r.part, r.entries) for r in alone] == [("one", 0, [])]


@pytest.mark.parametrize("hot", [0, 1, 5, 10_000])
def test_sweeps_over_all_words_agree_with_each_distance(monkeypatch, docs, hot):
    monkeypatch.setattr(cooccurrence, "HOT_STRIPES", hot)
    for stop in (None, ["w1", "rare7"]):
        swept = op.all_word_stripes_sweep(docs, (4, 1, 3), stop, parts=3).collect()
        assert len(swept) == len({(r.word, r.part) for r in swept})
        assert {r.word for r in swept if r.part == 0} == {r.word for r in swept} >= {"alone", "hot"}
        for d in (1, 3, 4):
            one = op.all_word_stripes(docs, d, stop, parts=3).collect()
            expected = {(r.word, r.part): [tuple(e) for e in r.entries] for r in one if r.entries}
            got = {(r.word, r.part): [(e.neighbor, e[f"cnt_d{d}"]) for e in r.entries if e[f"cnt_d{d}"]] for r in swept}
            assert {k: v for k, v in got.items() if v} == expected


def test_sweeps_over_all_words_shuffle_no_pairs_of_other_words(spark, docs, texts):
    text = plan(op.all_word_stripes_sweep(docs, (1, 2), ["w1"], parts=2))
    assert "hashpartitioning(a" not in text and "Exchange hashpartitioning(word" in text and "Join" not in text
    # all that stands before the list of frequent words is the other words' part of the plan: one shuffle, of contexts
    assert text.split("Subquery")[0].count("Exchange") == 1
    assert op.all_word_stripes_sweep(texts(None, "", "of"), (1, 2), ["of"], parts=2).count() == 0
    with pytest.raises(ValueError):
        op.all_word_stripes_sweep(docs, (0, 2), parts=2)
