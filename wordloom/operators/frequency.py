"""Document frequency, term frequency and TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.porter import stem, stem_array
from wordloom.functions.text import token_array
from wordloom.operators.lists import let, short_list
from wordloom.operators.words import drop_words, tokens
from wordloom.sources.wordlists import LITERAL_WORDS

# Fixed value: the corpus size in the score formula when none is given.
DEFAULT_DOCUMENTS = 10_000


def _quoted(word: str) -> str:
    """A word as a SQL string."""
    return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _document_terms(docs, stopwords, tokenizer, stemmed, doc_id, text, small_stopwords=False) -> DataFrame:
    """``(doc_id, term)`` and whether a row of ``docs`` gives each of its terms once."""
    words = token_array(text, tokenizer)
    if small_stopwords and isinstance(stopwords, DataFrame):
        gone = short_list(stopwords)
        rows = docs.select(F.col(doc_id).alias("doc_id"), F.array_distinct(words).alias("words"), gone.value.alias("gone"))
        kept = let(F.col("gone"), lambda g: F.filter("words", lambda w: (w != "") & ~gone.holds(g, w)))
        terms = F.array_distinct(stem_array(kept)) if stemmed else kept
        rows = rows.select("doc_id", F.explode_outer(terms).alias("term"))
        return rows.where(F.col("term").isNotNull()), True
    in_row = stopwords is None or not isinstance(stopwords, DataFrame) and len(stopwords) <= LITERAL_WORDS
    if in_row:
        # In the row: drop the stopwords by a set that is built once, and repeats, stem, and drop
        # the repeats the stems make. One SQL text takes thousands of words faster than columns do.
        gone = ", ".join(_quoted(w) for w in ["", *(stopwords or ())])
        rows = docs.select(F.col(doc_id).alias("doc_id"), words.alias("words"))
        terms = F.array_distinct(F.expr(f"filter(words, t -> t NOT IN ({gone}))"))
        if stemmed:
            terms = F.array_distinct(stem_array(terms))
        rows = rows.select("doc_id", F.explode_outer(terms).alias("term"))
        return rows.where(F.col("term").isNotNull()), True
    # A table of stopwords is joined to the distinct tokens of each row.
    terms = F.array_distinct(words)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.explode_outer(terms).alias("term"))
    rows = drop_words(rows.where(F.col("term") != ""), stopwords, "term")
    return (rows.withColumn("term", stem(F.col("term"))), False) if stemmed else (rows, True)


def document_terms(
    docs: DataFrame,
    stopwords=None,
    tokenizer: str = "apostrophe",
    stemmed: bool = True,
    one_row_per_document: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
    small_stopwords: bool = False,
) -> DataFrame:
    """``(doc_id, term)``, each term once per document.

    ``one_row_per_document`` states that no document id repeats. Then the rows of ``docs`` are
    the documents, repeats are dropped inside the row and nothing is shuffled. Stopwords given
    as a DataFrame are joined before stemming, and stems are made distinct by a shuffle, unless
    ``small_stopwords`` says that the list is short: then it is one value that rows are tested against.
    """
    terms, distinct = _document_terms(docs, stopwords, tokenizer, stemmed, doc_id, text, small_stopwords)
    return terms if one_row_per_document and distinct else terms.dropDuplicates(["doc_id", "term"])


def document_frequency(
    docs: DataFrame,
    stopwords=None,
    tokenizer: str = "apostrophe",
    stemmed: bool = True,
    one_row_per_document: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(term, df)``: in how many documents a term occurs.

    The stopword filter applies to the token, before stemming; a stem that equals a stopword
    stays. For a table of one row per document the only shuffle is that of the partial counts.
    """
    terms = document_terms(
        docs, stopwords, tokenizer, stemmed, one_row_per_document, doc_id, text
    )
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def top_terms(df_table: DataFrame, k: int = 100) -> DataFrame:
    """The ``k`` terms of highest document frequency; ties go to the greater term."""
    return df_table.orderBy(F.desc("df"), F.desc("term")).limit(k)


def stems(texts: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``(word, stem)`` for every distinct token: each is stemmed once."""
    words = texts.select(F.explode_outer(token_array(text, tokenizer)).alias("word"))
    words = words.where(F.col("word") != "").distinct()
    return words.select("word", stem(F.col("word")).alias("stem"))


def _terms(docs: DataFrame, tokenizer: str, doc_id: str, text: str) -> DataFrame:
    stemmed = stem_array(token_array(text, tokenizer))
    terms = docs.select(F.col(doc_id).alias("doc_id"), F.explode_outer(stemmed).alias("term"))
    return terms.where(F.col("term") != "")


def _listed_terms(docs: DataFrame, table: DataFrame, tokenizer: str, doc_id: str, text: str) -> DataFrame:
    """``(doc_id, term, ...)``: each token whose stem is a term of a small table, with the table's columns.

    Each distinct word is stemmed once, and the words of listed terms are joined to the tokens. They are about as few as
    the terms, however large the corpus: each rule takes one of a fixed list of suffixes. Spark cannot know that and
    would shuffle every token, hence the broadcast. The stem comes out of an array, or a filter on it
    would be moved below the ``distinct`` and stem every token.
    """
    words = tokens(docs, tokenizer, text).distinct()
    stemmed = words.select("word", F.explode(F.array(stem(F.col("word")))).alias("term"))
    listed = F.broadcast(stemmed.join(table, "term"))
    kept = tokens(docs, tokenizer, text, keep=(F.col(doc_id).alias("doc_id"),))
    return kept.join(listed, "word").drop("word")


def term_frequency(
    docs: DataFrame,
    df_table: DataFrame | None = None,
    tokenizer: str = "alpha",
    doc_id: str = "doc_id",
    text: str = "text",
    small_table: bool = False,
    stem_once: bool = False,
) -> DataFrame:
    """``(doc_id, term, tf)`` over stemmed tokens, limited to the terms of ``df_table`` if given.

    With ``small_table`` (a top-k list, say) the table filters the tokens before they are counted;
    otherwise it joins the counts. With ``stem_once`` as well, one more pass over the texts stems each
    distinct word once, and only words of the table's terms are counted.
    """
    if df_table is not None and small_table and stem_once:
        terms = _listed_terms(docs, df_table.select("term").distinct(), tokenizer, doc_id, text)
    else:
        terms = _terms(docs, tokenizer, doc_id, text)
        if df_table is not None and small_table:
            terms = terms.join(df_table, "term", "left_semi")
    counts = terms.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))
    if df_table is not None and not small_table:
        counts = counts.join(df_table, "term", "left_semi")
    return counts.select("doc_id", "term", "tf")


def score(tf, df, n_documents):
    """``tf * ln(n / df + 1)``."""
    return tf * F.log(F.lit(float(n_documents)) / df + F.lit(1.0))


def tf_idf(
    docs: DataFrame,
    df_table: DataFrame,
    n_documents: int = DEFAULT_DOCUMENTS,
    keep_unknown_terms: bool = False,
    tokenizer: str = "alpha",
    doc_id: str = "doc_id",
    text: str = "text",
    small_table: bool = False,
    stem_once: bool = False,
) -> DataFrame:
    """``(doc_id, term, score)``, the score rounded to six decimals.

    Terms outside ``df_table`` are left out, or with ``keep_unknown_terms`` scored as if one
    document held them. A document with no term left has no row. With ``small_table`` the table is
    joined to the tokens and its ``df`` carried through the count, with ``stem_once`` by the words of its terms, which
    one more pass finds by stemming each distinct word once; otherwise the only join is that of
    the counts with the table, which adaptive execution can split at a term of most documents.
    """
    table = df_table.select("term", "df")
    if small_table and not keep_unknown_terms:
        if stem_once:
            terms = _listed_terms(docs, table, tokenizer, doc_id, text)
        else:
            terms = _terms(docs, tokenizer, doc_id, text).join(table, "term")
        counts = terms.groupBy("doc_id", "term", "df").agg(F.count("*").alias("tf"))
    else:
        terms = _terms(docs, tokenizer, doc_id, text)
        counts = terms.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))
        counts = counts.join(table, "term", "left" if keep_unknown_terms else "inner")
    df = F.coalesce("df", F.lit(1)) if keep_unknown_terms else F.col("df")
    return counts.select(
        "doc_id", "term", F.round(score(F.col("tf"), df, n_documents), 6).alias("score")
    )


def corpus_counters(docs: DataFrame, df_table: DataFrame, scores: DataFrame) -> DataFrame:
    """``(counter, value)``: documents, distinct terms, (term, document) pairs, score rows."""

    def one(frame: DataFrame, name: str, value) -> DataFrame:
        return frame.agg(value.cast("bigint").alias("value")).select(
            F.lit(name).alias("counter"), "value"
        )

    table = df_table.agg(F.count("*").alias("terms"), F.sum("df").alias("pairs")).select(
        F.explode(
            F.array(
                F.struct(F.lit("terms").alias("counter"), F.col("terms").alias("value")),
                F.struct(
                    F.lit("term_document_pairs").alias("counter"),
                    F.coalesce("pairs", F.lit(0)).alias("value"),
                ),
            )
        ).alias("c")
    ).select("c.*")
    return (
        one(docs, "documents", F.count("*"))
        .unionByName(table)
        .unionByName(one(scores, "score_rows", F.count("*")))
    )
