import pytest

from wordloom import operators as op
from wordloom.functions import SEPARATORS


def words(df, tokenizer):
    return [r.word for r in op.tokens(df, tokenizer).collect()]


@pytest.mark.parametrize(
    "tokenizer, text, expected",
    [
        (
            "trim_punct",
            "(word), u.s. http://x.org/ café don't --",
            ["word", "u.s", "http://x.org", "caf", "don't"],
        ),
        ("trim_punct", "  --Hello, World!!\n(again)\t...", ["hello", "world", "again"]),
        ("trim_punct", "--", []),
        ("trim_punct", "!!!a!!!b!!!", ["a!!!b"]),
        ("trim_punct", "é", []),
        ("alnum", "New York city, York city.", ["new", "york", "city", "york", "city"]),
        ("nonword", "rock_n-roll café", ["rock_n", "roll", "caf"]),
        ("apostrophe", "it's rock_n-roll ' x", ["it's", "rock_n", "roll", "'", "x"]),
        ("alpha", "2010 b2b rock_n", ["b", "b", "rock", "n"]),
    ],
)
def test_fixture(texts, tokenizer, text, expected):
    assert words(texts(text), tokenizer) == expected


@pytest.mark.parametrize("tokenizer", SEPARATORS)
def test_no_text_has_no_tokens(texts, tokenizer):
    assert words(texts(None, "", " \n "), tokenizer) == []


@pytest.mark.parametrize("tokenizer", SEPARATORS)
def test_junk_without_separators_takes_linear_time(texts, tokenizer):
    junk = "!" * 200_000 + "a" + "?" * 200_000
    assert words(texts(junk, "x" * 200_000), tokenizer) == ["a", "x" * 200_000]


def test_unknown_tokenizer(texts):
    with pytest.raises(ValueError, match="unknown tokenizer"):
        op.tokens(texts("a"), "other")


def test_word_count_and_stopwords(texts, rows):
    docs = texts("The cat, the dog.", None, "A cat")
    assert rows(op.word_count(docs)) == [("a", 1), ("cat", 2), ("dog", 1), ("the", 2)]
    assert rows(op.word_count(docs, ["the", "a"])) == [("cat", 2), ("dog", 1)]
    assert rows(op.word_count(docs, [])) == rows(op.word_count(docs))


def test_stopwords_as_a_dataframe(spark, texts, rows):
    stop = spark.createDataFrame([("the",), ("a",)], "word string")
    assert rows(op.word_count(texts("The cat, a dog"), stop)) == [("cat", 1), ("dog", 1)]


def test_top_words_cuts_ties_by_word(texts):
    counts = op.word_count(texts("b b a a c"))
    assert [tuple(r) for r in op.top_words(counts, 1).collect()] == [("a", 2)]
    assert [tuple(r) for r in op.top_words(counts, 3).collect()] == [("a", 2), ("b", 2), ("c", 1)]


def test_keep_and_drop_words(texts, rows):
    tokens = op.tokens(texts("x y z x"), "alnum", keep=["doc_id"])
    assert rows(op.keep_words(tokens, ["x", "q"])) == [("d1", "x"), ("d1", "x")]
    assert rows(op.drop_words(tokens, ["x", "q"])) == [("d1", "y"), ("d1", "z")]
