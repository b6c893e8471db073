"""DataFrame operators; they build plans, start no job and return DataFrames (``save_stripes`` writes a table)."""

from wordloom.operators.bands import band_counts
from wordloom.operators.bloom import bloom_filter, drop_words_by_filter, keep_words_by_filter
from wordloom.operators.cooccurrence import (
    all_word_stripes,
    all_word_stripes_sweep,
    cooccurrence_pairs,
    cooccurrence_sweep,
    isolated_words,
    merge_stripes,
    stripe_at,
    stripe_maps,
    stripes,
    stripes_to_pairs,
    vocabulary_stripes,
    vocabulary_stripes_sweep,
    window_pairs,
)
from wordloom.operators.dictionary import (
    document_frequency_by_dictionary,
    document_terms_by_dictionary,
    stem_dictionary,
    term_frequency_by_dictionary,
)
from wordloom.operators.frequency import (
    corpus_counters,
    document_frequency,
    document_terms,
    stems,
    term_frequency,
    tf_idf,
    top_terms,
)
from wordloom.operators.matrix import merge_into_stored, save_stripes
from wordloom.operators.words import (
    drop_words,
    keep_words,
    token_counts,
    tokens,
    top_words,
    word_count,
)

__all__ = [
    "all_word_stripes",
    "all_word_stripes_sweep",
    "band_counts",
    "bloom_filter",
    "cooccurrence_pairs",
    "cooccurrence_sweep",
    "corpus_counters",
    "document_frequency",
    "document_frequency_by_dictionary",
    "document_terms",
    "document_terms_by_dictionary",
    "drop_words",
    "drop_words_by_filter",
    "isolated_words",
    "keep_words",
    "keep_words_by_filter",
    "merge_into_stored",
    "merge_stripes",
    "save_stripes",
    "stem_dictionary",
    "stems",
    "stripe_at",
    "stripe_maps",
    "stripes",
    "stripes_to_pairs",
    "term_frequency",
    "term_frequency_by_dictionary",
    "tf_idf",
    "token_counts",
    "tokens",
    "top_terms",
    "top_words",
    "vocabulary_stripes",
    "vocabulary_stripes_sweep",
    "window_pairs",
    "word_count",
]
