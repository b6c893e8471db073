"""The registered queries. Each reads whole tables of a data folder and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom import operators as op
from wordloom import plans, sinks, sources
from wordloom.functions import clean_document_id, pair_text, stripe_text
from wordloom.operators.lists import short_list
from wordloom.plans.counters import Counters
from wordloom.sinks.scratch import scratch_path
from wordloom.sources import SHORT_STOPWORDS

# Size limit of a line, in bytes with its terminator, in the query on over-long lines.
LONG_LINE = 200
# Parts of a stripe over all words, in the queries on them.
PARTS = 4
MANY_PARTS = 16
# Stopwords that are taken from a table.
TABLE_STOPWORDS = 200
# Distances of wide windows, over listed words and over all.
WIDE_DISTANCE = 200
WIDE_DISTANCE_ALL = 40
# Most occurrences of a word in the conversations that makes it a rare one, and the windows of rare words.
RARE = 3
RARE_DISTANCE = 4
# Buckets of a stored matrix, and files of a clustered table.
BUCKETS = 8
CLUSTERED_FILES = 16


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """One row per document, as the table's key ``doc_id`` says."""
    return sources.read_table(spark, f"{sf}/documents.parquet", "doc_id", "text")


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations: a document of several rows."""
    return sources.read_table(spark, f"{sf}/conversations.parquet", "conv_id", "text")


def top_words(spark, sf):
    return plans.frequent_words(documents(spark, sf), 50, SHORT_STOPWORDS)


def word_count(spark, sf):
    return op.word_count(documents(spark, sf), SHORT_STOPWORDS)


def token_query(tokenizer: str):
    return lambda spark, sf: op.token_counts(documents(spark, sf), tokenizer)


def stopword_filter(spark, sf):
    kept = op.drop_words(op.tokens(documents(spark, sf), "nonword"), SHORT_STOPWORDS)
    return kept.groupBy("word").agg(F.count("*").alias("cnt"))


def vocab_filter(spark, sf):
    docs = documents(spark, sf)
    vocabulary = plans.frequent_words(docs, 50, SHORT_STOPWORDS)
    kept = op.keep_words(op.tokens(docs, "alnum", keep=["doc_id"]), vocabulary)
    return kept.groupBy("doc_id").agg(
        F.count("*").alias("cnt"), F.count_distinct("word").alias("words")
    )


def lines(spark, sf):
    rows = sources.document_lines(documents(spark, sf))
    return rows.groupBy("doc_id").agg(
        F.count("*").alias("lines"), F.sum(F.octet_length("line")).alias("bytes")
    )


def long_line_skip(spark, sf):
    rows = sources.drop_long_lines(sources.document_lines(documents(spark, sf)), LONG_LINE)
    return rows.groupBy("doc_id").agg(
        F.count("*").alias("lines"), F.sum(F.octet_length("line")).alias("bytes")
    )


def document_id_cleanup(spark, sf):
    docs = sources.read_table(spark, f"{sf}/documents.parquet", "doc_id", "source")
    name = F.concat("source", F.lit(".txt-"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return docs.select("doc_id", clean_document_id(name).alias("name"))


def pairs_query(distance: int, **options):
    return lambda spark, sf: plans.frequent_word_pairs(
        documents(spark, sf), distance, 50, SHORT_STOPWORDS, **options
    )


def cooc_pairs_sweep(spark, sf):
    docs = documents(spark, sf)
    vocabulary = plans.frequent_words(docs, 50, SHORT_STOPWORDS)
    return op.cooccurrence_sweep(docs, (1, 2, 3, 4), vocabulary, small_lists=True)


def cooc_stripes(spark, sf):
    docs = documents(spark, sf)
    vocabulary = plans.frequent_words(docs, 50)
    stripes = op.vocabulary_stripes(docs, 2, vocabulary, SHORT_STOPWORDS, small_lists=True)
    return stripes.select("word", stripe_text("entries").alias("stripe"))


def cooc_stripes_sweep(spark, sf):
    docs = documents(spark, sf)
    vocabulary = plans.frequent_words(docs, 50)
    stripes = op.vocabulary_stripes_sweep(
        docs, (1, 2, 3, 4), vocabulary, SHORT_STOPWORDS, small_lists=True
    )
    return stripes.select("word", *_texts_by_distance())


def _texts_by_distance():
    texts = (stripe_text(op.stripe_at(F.col("entries"), f"cnt_d{d}")) for d in (1, 2, 3, 4))
    return [text.alias(f"stripe_d{d}") for d, text in enumerate(texts, 1)]


def all_stripes_query(parts: int):
    def query(spark, sf):
        stripes = op.all_word_stripes(documents(spark, sf), 1, SHORT_STOPWORDS, parts=parts)
        return stripes.select("word", "part", stripe_text("entries").alias("stripe"))

    return query


def cooc_stripes_all_sweep(spark, sf):
    stripes = op.all_word_stripes_sweep(
        documents(spark, sf), (1, 2, 3, 4), SHORT_STOPWORDS, parts=PARTS
    )
    return stripes.select("word", "part", *_texts_by_distance())


def empty_stripes(spark, sf):
    return op.isolated_words(op.all_word_stripes(documents(spark, sf), 1, SHORT_STOPWORDS, parts=PARTS))


def stripes_to_pairs(spark, sf):
    return op.stripes_to_pairs(op.all_word_stripes(documents(spark, sf), 2, SHORT_STOPWORDS, parts=PARTS))


def stripes_merge(spark, sf):
    first = op.all_word_stripes(documents(spark, sf), 1, SHORT_STOPWORDS, parts=PARTS)
    second = op.all_word_stripes(turns(spark, sf), 1, SHORT_STOPWORDS, parts=1)
    merged = op.merge_stripes(first, second, parts=PARTS)
    return merged.select("word", "part", stripe_text("entries").alias("stripe"))


def counts_text(spark, sf):
    return sinks.count_lines(word_count(spark, sf))


def stripes_text(spark, sf):
    stripes = op.all_word_stripes(documents(spark, sf), 1, SHORT_STOPWORDS, parts=PARTS)
    return sinks.stripe_lines(stripes, PARTS)


def scores_text(spark, sf):
    return sinks.score_lines(tfidf(spark, sf))


def doc_freq_stopword_table(spark, sf):
    """Document frequency without the most frequent words of the conversations."""
    stopwords = plans.frequent_words(turns(spark, sf), TABLE_STOPWORDS).select("word")
    return op.document_frequency(documents(spark, sf), stopwords, one_row_per_document=True)


def pairs_text(spark, sf):
    pairs = plans.frequent_word_pairs(documents(spark, sf), 1, 50, SHORT_STOPWORDS)
    return pairs.select(pair_text("word", "neighbor").alias("pair"), "cnt")


def doc_freq(spark, sf):
    return op.document_frequency(documents(spark, sf), SHORT_STOPWORDS, one_row_per_document=True)


def doc_freq_raw(spark, sf):
    return op.document_frequency(
        documents(spark, sf), SHORT_STOPWORDS, stemmed=False, one_row_per_document=True
    )


def doc_freq_conversations(spark, sf):
    return op.document_frequency(turns(spark, sf), SHORT_STOPWORDS, doc_id="conv_id")


def doc_freq_top100(spark, sf):
    return op.top_terms(doc_freq(spark, sf), 100)


def porter_stem(spark, sf):
    return op.stems(documents(spark, sf), "apostrophe")


def term_freq(spark, sf):
    return op.term_frequency(documents(spark, sf), doc_freq_top100(spark, sf), small_table=True, stem_once=True)


def tfidf(spark, sf):
    return plans.frequent_term_scores(
        documents(spark, sf), 100, SHORT_STOPWORDS, one_row_per_document=True
    )


def tfidf_unknown_terms(spark, sf):
    return op.tf_idf(
        documents(spark, sf),
        doc_freq_top100(spark, sf),
        keep_unknown_terms=True,
        small_table=True,
    )


def corpus_counters(spark, sf):
    return op.corpus_counters(documents(spark, sf), doc_freq(spark, sf), tfidf(spark, sf))


def df_table_parse(spark, sf):
    """Tables as tab-separated lines: good ones, ones of three fields, ones with no integer."""
    read = sources.read_table
    parts = read(spark, f"{sf}/part.parquet", "p_partkey", "p_name", "p_size")
    suppliers = read(spark, f"{sf}/supplier.parquet", "s_name", "s_nationkey", "s_acctbal")
    customers = read(spark, f"{sf}/customer.parquet", "c_name", "c_mktsegment")
    nations = read(spark, f"{sf}/nation.parquet", "n_name")
    tab = F.lit("\t")
    named = F.concat(F.lit("  "), "p_name", F.lit(" "), F.col("p_partkey").cast("string"))
    lines = (
        parts.select(F.concat(named, tab, F.lit(" "), "p_size", tab).alias("line"))
        .unionByName(
            suppliers.select(F.concat_ws("\t", "s_name", "s_nationkey", "s_acctbal").alias("line"))
        )
        .unionByName(customers.select(F.concat_ws("\t", "c_name", "c_mktsegment").alias("line")))
        .unionByName(nations.select(F.col("n_name").alias("line")))
    )
    return sources.parse_df_table(lines)


def wordlist_parse(spark, sf):
    rows = sources.document_lines(documents(spark, sf))
    return sources.parse_vocabulary(rows)


def stopword_parse(spark, sf):
    rows = sources.document_lines(documents(spark, sf))
    return sources.parse_stopwords(rows.select(F.concat(F.lit("\t "), "line", F.lit(" \t")).alias("line")))


def cooc_pairs_blocks(spark, sf):
    """Unordered pairs of the frequent words, by the plan for wide windows at a short distance."""
    docs = documents(spark, sf)
    vocabulary = plans.frequent_words(docs, 50, SHORT_STOPWORDS)
    return op.band_counts(docs, 2, [short_list(vocabulary)])


def cooc_words_wide(spark, sf):
    """Of each word, its distinct neighbors and its pairs with them, over the whole matrix of all words."""
    pairs = op.cooccurrence_pairs(documents(spark, sf), WIDE_DISTANCE_ALL)
    return pairs.groupBy("word").agg(F.count("*").alias("neighbors"), F.sum("cnt").alias("cnt"))


def rare_words(spark, sf):
    return op.token_counts(turns(spark, sf), "alnum").where(F.col("cnt") <= RARE).select("word")


def cooc_pairs_rare(spark, sf):
    """Pairs over a vocabulary of unknown size: a filter on the tokens, then the exact join."""
    return op.cooccurrence_pairs(documents(spark, sf), RARE_DISTANCE, rare_words(spark, sf))


def stopword_filter_large(spark, sf):
    kept = op.drop_words_by_filter(op.tokens(documents(spark, sf), "alnum"), rare_words(spark, sf))
    return kept.groupBy("word").agg(F.count("*").alias("cnt"))


def vocab_filter_large(spark, sf):
    rows = op.tokens(documents(spark, sf), "alnum", keep=["doc_id"])
    kept = op.keep_words_by_filter(rows, rare_words(spark, sf))
    return kept.groupBy("doc_id").agg(F.count("*").alias("cnt"), F.count_distinct("word").alias("words"))


def doc_freq_dictionary(spark, sf):
    return op.document_frequency_by_dictionary(documents(spark, sf), SHORT_STOPWORDS)


def doc_freq_listed_in_row(spark, sf):
    """Document frequency without the most frequent words of the conversations, tested inside the row."""
    stopwords = plans.frequent_words(turns(spark, sf), TABLE_STOPWORDS).select("word")
    terms = op.document_terms(documents(spark, sf), stopwords, one_row_per_document=True, small_stopwords=True)
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def term_freq_dictionary(spark, sf):
    return op.term_frequency_by_dictionary(documents(spark, sf), doc_freq_top100(spark, sf))


def stripes_merge_stored(spark, sf):
    """The conversations' stripes merged into the stored ones of the documents."""
    path = scratch_path(spark, "matrix")
    table = "matrix_" + path[-32:]
    first = op.all_word_stripes(documents(spark, sf), 1, SHORT_STOPWORDS, parts=PARTS)
    op.save_stripes(first, table, BUCKETS, path)
    second = op.all_word_stripes(turns(spark, sf), 1, SHORT_STOPWORDS, parts=PARTS)
    merged = op.merge_into_stored(spark.table(table), second)
    return merged.select("word", "part", stripe_text("entries").alias("stripe"))


def clustered_lookup(spark, sf):
    """Counts of some words, looked up in a table of all words laid out by word."""
    path = scratch_path(spark, "words")
    sinks.write_clustered(op.token_counts(documents(spark, sf), "nonword"), path, "word", CLUSTERED_FILES)
    return sinks.lookup(spark, path, "word", SHORT_STOPWORDS)


def counters_observed(spark, sf):
    """Counters of the runs that write document frequencies and scores, by observed metrics."""
    counters = Counters()
    docs = counters.watch(documents(spark, sf), "documents")
    terms = op.document_terms(docs, SHORT_STOPWORDS, one_row_per_document=True)
    table = counters.watch(terms, "term_document_pairs").groupBy("term").agg(F.count("*").alias("df"))
    path = scratch_path(spark, "df")
    counters.watch(table, "terms").write.parquet(path)
    top = op.top_terms(spark.read.parquet(path), 100)
    scores = op.tf_idf(documents(spark, sf), top, small_table=True, stem_once=True)
    counters.watch(scores, "score_rows").write.parquet(scratch_path(spark, "scores"))
    return spark.createDataFrame(sorted(counters.values().items()), "counter string, value bigint")


def _as_files(spark, sf) -> str:
    """The documents as text files, one each."""
    path = scratch_path(spark, "corpus")
    sinks.write_documents(documents(spark, sf), path)
    return path


def file_lines(spark, sf):
    """How many files have how many lines."""
    rows = sources.read_document_lines(spark, _as_files(spark, sf))
    files = rows.groupBy("doc_id").agg(F.count("*").alias("lines"))
    return files.groupBy("lines").agg(F.count("*").alias("files"))


def doc_freq_files(spark, sf):
    """Document frequency of files: in the row where a file is one, by lines beyond."""
    whole, rest = sources.read_documents(spark, _as_files(spark, sf))
    terms = op.document_terms(whole, SHORT_STOPWORDS, one_row_per_document=True)
    terms = terms.unionByName(op.document_terms(rest, SHORT_STOPWORDS, text="line"))
    return terms.groupBy("term").agg(F.count("*").alias("df"))


# Queries that write a table or files before they read them.
WRITING = ("stripes_merge_stored", "clustered_lookup", "counters_observed", "file_lines", "doc_freq_files")

QUERIES = {
    "cooc_pairs_blocks": cooc_pairs_blocks,
    "cooc_pairs_wide": pairs_query(WIDE_DISTANCE),
    "cooc_words_wide": cooc_words_wide,
    "cooc_pairs_rare": cooc_pairs_rare,
    "stopword_filter_large": stopword_filter_large,
    "vocab_filter_large": vocab_filter_large,
    "doc_freq_dictionary": doc_freq_dictionary,
    "doc_freq_listed_in_row": doc_freq_listed_in_row,
    "term_freq_dictionary": term_freq_dictionary,
    "stripes_merge_stored": stripes_merge_stored,
    "clustered_lookup": clustered_lookup,
    "counters_observed": counters_observed,
    "file_lines": file_lines,
    "doc_freq_files": doc_freq_files,
    "top_words": top_words,
    "word_count": word_count,
    "tokens_trim_punct": token_query("trim_punct"),
    "tokens_alnum": token_query("alnum"),
    "tokens_nonword": token_query("nonword"),
    "tokens_apostrophe": token_query("apostrophe"),
    "tokens_alpha": token_query("alpha"),
    "stopword_filter": stopword_filter,
    "vocab_filter": vocab_filter,
    "lines": lines,
    "long_line_skip": long_line_skip,
    "document_id_cleanup": document_id_cleanup,
    "cooc_pairs": pairs_query(2),
    "cooc_pairs_document": pairs_query(2, scope="document"),
    "cooc_pairs_sweep": cooc_pairs_sweep,
    "cooc_stripes": cooc_stripes,
    "cooc_stripes_sweep": cooc_stripes_sweep,
    "cooc_stripes_all": all_stripes_query(PARTS),
    "cooc_stripes_all_sweep": cooc_stripes_all_sweep,
    "cooc_stripes_split": all_stripes_query(MANY_PARTS),
    "empty_stripes": empty_stripes,
    "stripes_to_pairs": stripes_to_pairs,
    "stripes_merge": stripes_merge,
    "pairs_text": pairs_text,
    "doc_freq": doc_freq,
    "doc_freq_raw": doc_freq_raw,
    "doc_freq_conversations": doc_freq_conversations,
    "doc_freq_stopword_table": doc_freq_stopword_table,
    "doc_freq_top100": doc_freq_top100,
    "porter_stem": porter_stem,
    "term_freq": term_freq,
    "tfidf": tfidf,
    "tfidf_unknown_terms": tfidf_unknown_terms,
    "corpus_counters": corpus_counters,
    "df_table_parse": df_table_parse,
    "wordlist_parse": wordlist_parse,
    "stopword_parse": stopword_parse,
    "counts_text": counts_text,
    "stripes_text": stripes_text,
    "scores_text": scores_text,
}
