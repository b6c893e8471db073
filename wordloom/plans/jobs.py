"""Whole jobs from a folder of text files to a folder of tab-separated text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom import operators as op
from wordloom import plans, sinks, sources
from wordloom.operators.frequency import DEFAULT_DOCUMENTS
from wordloom.plans.counters import Counters


def top_words(spark: SparkSession, corpus, out: str, stopwords, k: int = 50) -> None:
    """``word<TAB>count`` of the ``k`` most frequent words, most frequent first."""
    counts = op.word_count(
        sources.read_lines(spark, corpus), sources.read_stopwords(spark, stopwords), text="line"
    )
    sinks.write_tsv(op.top_words(counts, k), out)


def _are_few(*lists: DataFrame) -> bool:
    """Whether word lists are short enough to be tested inside rows; they are counted."""
    return all(plans.is_few(words.count()) for words in lists)


def pairs(
    spark: SparkSession, corpus, out: str, vocabulary, distance: int, ordered: bool = False
) -> None:
    """``(word,neighbor)<TAB>count`` over a vocabulary."""
    words = sources.read_checked_vocabulary(spark, vocabulary)
    found = op.cooccurrence_pairs(
        sources.read_lines(spark, corpus), distance, words, text="line", small_lists=_are_few(words)
    )
    sinks.write_pairs(found, out, ordered=ordered)


def frequent_pairs(
    spark: SparkSession,
    corpus,
    out: str,
    stopwords,
    distance: int,
    k: int = 50,
    ordered: bool = False,
) -> None:
    """``(word,neighbor)<TAB>count`` among the ``k`` most frequent words that are no stopwords."""
    lines = sources.read_lines(spark, corpus).withColumnRenamed("line", "text")
    stop = sources.read_stopwords(spark, stopwords)
    sinks.write_pairs(plans.frequent_word_pairs(lines, distance, k, stop), out, ordered=ordered)


def stripes(
    spark: SparkSession,
    corpus,
    out: str,
    vocabulary,
    stopwords,
    distance: int,
    ordered: bool = False,
) -> None:
    """``word<TAB>{neighbor=count, ...}`` over a vocabulary without its stopwords."""
    words, stop = sources.read_checked_vocabulary(spark, vocabulary), sources.read_stopwords(spark, stopwords)
    found = op.vocabulary_stripes(
        sources.read_lines(spark, corpus), distance, words, stop, text="line", small_lists=_are_few(words, stop)
    )
    sinks.write_stripes(found, out, ordered=ordered)


def all_word_stripes(
    spark: SparkSession,
    corpus,
    out: str,
    stopwords,
    distance: int,
    *,
    parts: int,
    ordered: bool = False,
) -> None:
    """``word<TAB>{neighbor=count, ...}`` of every word that is no stopword.

    With more than one part, ``word<TAB>part<TAB>{neighbor=count, ...}``. Take the number of distinct words /
    100,000: in a single part, the stripe of a frequent word grows with the vocabulary.
    """
    found = op.all_word_stripes(
        sources.read_lines(spark, corpus),
        distance,
        sources.read_stopwords(spark, stopwords),
        parts=parts,
        text="line",
    )
    sinks.write_stripes(found, out, ordered=ordered, parts=parts)


def document_frequency(
    spark: SparkSession,
    corpus,
    out: str,
    stopwords,
    max_line_bytes: int | None = None,
    ordered: bool = False,
) -> dict[str, int]:
    """``term<TAB>documents`` of every stemmed term.

    Returns the numbers of documents, of (term, document) pairs and of terms, counted on the way.
    """
    stop = sources.read_stopwords(spark, stopwords)
    counters = Counters()
    whole, lines = sources.read_documents(spark, corpus, max_line_bytes)
    whole = counters.watch(whole, "documents")
    terms = op.document_terms(whole, stop, one_row_per_document=True, small_stopwords=_are_few(stop))
    terms = terms.unionByName(op.document_terms(lines, stop, text="line"))
    table = counters.watch(terms, "term_document_pairs").groupBy("term").agg(F.count("*").alias("df"))
    table = counters.watch(table.orderBy("term") if ordered else table, "terms")
    sinks.write_tsv(table, out)
    return _with_others(counters, spark, corpus)


def _with_others(counters: Counters, spark: SparkSession, corpus) -> dict[str, int]:
    """The counters, with the documents that are read line by line; only the files' listing is read."""
    found = counters.values()
    found["documents"] += sources.split_documents(sources.list_documents(spark, corpus)).count()
    return found


def top_terms(spark: SparkSession, df_table, out: str, k: int = 100) -> None:
    """The ``k`` lines of highest document frequency, highest first."""
    sinks.write_tsv(op.top_terms(sources.read_checked_df_table(spark, df_table), k), out)


def tf_idf(
    spark: SparkSession,
    corpus,
    out: str,
    df_table,
    n_documents: int = DEFAULT_DOCUMENTS,
    max_line_bytes: int | None = None,
    ordered: bool = False,
) -> dict[str, int]:
    """``document<TAB>term<TAB>score`` for the terms of a document-frequency table.

    Returns the numbers of documents and of score rows, counted on the way.
    """
    counters = Counters()
    whole, lines = sources.read_documents(spark, corpus, max_line_bytes, clean_ids=True)
    docs = counters.watch(whole, "documents").unionByName(lines.withColumnRenamed("line", "text"))
    scores = op.tf_idf(docs, sources.read_checked_df_table(spark, df_table), n_documents)
    scores = counters.watch(scores.orderBy("doc_id", "term") if ordered else scores, "score_rows")
    sinks.write_scores(scores, out)
    return _with_others(counters, spark, corpus)


def frequent_term_scores(
    spark: SparkSession,
    corpus,
    out: str,
    stopwords,
    k: int = 100,
    n_documents: int = DEFAULT_DOCUMENTS,
    max_line_bytes: int | None = None,
    ordered: bool = False,
) -> None:
    """``document<TAB>term<TAB>score`` for the ``k`` terms of highest document frequency."""
    lines = sources.read_document_lines(spark, corpus, max_line_bytes, clean_ids=True)
    scores = plans.frequent_term_scores(
        lines.withColumnRenamed("line", "text"),
        k,
        sources.read_stopwords(spark, stopwords),
        n_documents,
    )
    sinks.write_scores(scores, out, ordered=ordered)
