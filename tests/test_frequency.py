import pytest
from pyspark.sql import functions as F

from wordloom import operators as op
from wordloom.operators import frequency


@pytest.mark.parametrize("unique", [True, False])
def test_document_frequency_fixture(texts, rows, unique):
    docs = texts("Houses house", "house days")
    df = op.document_frequency(docs, one_row_per_document=unique)
    assert rows(df) == [("dai", 1), ("hous", 2)]


def test_a_document_in_several_rows_counts_once(spark, rows):
    lines = spark.createDataFrame(
        [("d", "house"), ("d", "houses"), ("d", "house"), ("e", "x")], "doc_id string, text string"
    )
    assert rows(op.document_frequency(lines)) == [("hous", 1), ("x", 1)]


def test_stopwords_go_before_stemming(texts, rows):
    # "thi" comes from a word that is no stopword; the stem itself is not filtered again.
    docs = texts("this thi house", "this")
    assert rows(op.document_frequency(docs, ["this"])) == [("hous", 1), ("thi", 1)]
    assert rows(op.document_frequency(docs, ["thi"])) == [("hous", 1), ("thi", 2)]


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("stemmed", [True, False])
def test_stopwords_in_any_form(spark, texts, rows, monkeypatch, unique, stemmed):
    docs = texts("Houses house the x", None, "house days the")
    stop = spark.createDataFrame([("the",), ("x",)], "word string")
    options = dict(one_row_per_document=unique, stemmed=stemmed)
    expected = rows(op.document_frequency(docs, ["the", "x"], **options))
    assert expected == rows(op.document_frequency(docs, ["the", "x"] + [f"w{i}" for i in range(50)], **options))
    assert rows(op.document_frequency(docs, stop, **options)) == expected
    monkeypatch.setattr(frequency, "LITERAL_WORDS", 1)
    assert rows(op.document_frequency(docs, ["the", "x"], **options)) == expected


def test_document_terms(texts, rows):
    docs = texts("b a b", "")
    assert rows(op.document_terms(docs, one_row_per_document=True)) == [("d1", "a"), ("d1", "b")]


def test_top_terms_cuts_ties_by_greater_term(spark):
    table = spark.createDataFrame([("a", 2), ("b", 2), ("c", 1)], "term string, df bigint")
    assert [tuple(r) for r in op.top_terms(table, 1).collect()] == [("b", 2)]


def test_scores_fixture(spark, texts, rows):
    docs = texts("house Houses", "days", "zzz 1999")
    table = spark.createDataFrame([("hous", 2), ("dai", 1)], "term string, df bigint")
    assert rows(op.tf_idf(docs, table)) == [("d1", "hous", 17.034786), ("d2", "dai", 9.21044)]


def test_terms_without_document_frequency(spark, texts, rows):
    docs = texts("house tree")
    table = spark.createDataFrame([("hous", 2)], "term string, df bigint")
    assert rows(op.tf_idf(docs, table)) == [("d1", "hous", 8.517393)]
    assert rows(op.tf_idf(docs, table, keep_unknown_terms=True)) == [
        ("d1", "hous", 8.517393),
        ("d1", "tree", 9.21044),
    ]


@pytest.mark.parametrize(
    "term, df, tf, expected",
    [("http", 7418, 13, 11.096731), ("apo", 9518, 11, 7.899676), ("www", 6780, 5, 4.531053)],
)
def test_published_scores(spark, term, df, tf, expected):
    table = spark.createDataFrame([(tf, df)], "tf bigint, df bigint")
    score = frequency.score(F.col("tf"), F.col("df"), 10_000)
    assert table.select(F.round(score, 6).alias("s")).first().s == expected


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("unknown", [True, False])
def test_the_size_of_the_table_changes_no_result(spark, texts, rows, small, unknown):
    docs = texts("house tree day", "days days", "x")
    table = spark.createDataFrame([("hous", 2), ("dai", 1), ("none", 4)], "term string, df bigint")
    options = dict(keep_unknown_terms=unknown)
    assert rows(op.tf_idf(docs, table, small_table=small, **options)) == rows(
        op.tf_idf(docs, table, **options)
    )
    assert rows(op.term_frequency(docs, table, small_table=small)) == [
        ("d1", "dai", 1),
        ("d1", "hous", 1),
        ("d2", "dai", 2),
    ]


def test_number_of_documents_is_a_parameter(spark, texts, rows):
    table = spark.createDataFrame([("a", 1)], "term string, df bigint")
    assert rows(op.tf_idf(texts("a"), table, n_documents=1)) == [("d1", "a", 0.693147)]


def test_term_frequency_adds_up_lines_of_a_document(spark, rows):
    lines = spark.createDataFrame(
        [("d", "day days"), ("d", "Day 5"), ("e", "q")], "doc_id string, text string"
    )
    assert rows(op.term_frequency(lines)) == [("d", "dai", 3), ("e", "q", 1)]


def test_counters(spark, texts, rows):
    docs = texts("house days", "house", "7")
    table = op.document_frequency(docs)
    scores = op.tf_idf(docs, table)
    assert rows(op.corpus_counters(docs, table, scores)) == [
        ("documents", 3),
        ("score_rows", 3),
        ("term_document_pairs", 4),
        ("terms", 3),
    ]


def test_stopwords_with_quotes(texts, rows):
    docs = texts("don't stay a\\b")
    expected = [("a", 1), ("b", 1), ("stai", 1)]
    assert rows(op.document_frequency(docs, ["don't", "x'y\\"])) == expected


def test_a_small_table_stems_each_distinct_word_once(spark, texts, rows):
    docs = texts("House houses day", "house housing", None, "", "days")
    table = spark.createDataFrame([("hous", 2), ("hous", 2), ("dai", 1), ("", 1), (None, 1)], "term string, df bigint")
    for count in (op.tf_idf, op.term_frequency):
        small = count(docs, table, small_table=True, stem_once=True)
        plan = small._jdf.queryExecution().optimizedPlan().toString()
        # An explode of tokens, without stems, is all that lies below the distinct words.
        assert "transform(" in plan[: plan.index("Aggregate [word#")]
        assert "transform(" not in plan[plan.index("Aggregate [word#") :]
    assert rows(op.term_frequency(docs, table, small_table=True, stem_once=True)) == [("d1", "dai", 1), ("d1", "hous", 2), ("d2", "hous", 2), ("d5", "dai", 1)]
    # A term that the table has twice counts twice, as ever.
    assert rows(op.tf_idf(docs, table.where("term = 'hous'"), small_table=True, stem_once=True)) == [("d1", "hous", 34.069573), ("d2", "hous", 34.069573)]
