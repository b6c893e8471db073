"""Readers for text corpora, word lists and document-frequency tables."""

from wordloom.sources.dftable import parse_df_table, read_checked_df_table, read_df_table
from wordloom.sources.files import list_documents, read_documents, split_documents
from wordloom.sources.lines import (
    document_lines,
    drop_long_lines,
    read_document_lines,
    read_lines,
    read_table,
)
from wordloom.sources.wordlists import (
    SHORT_STOPWORDS,
    are_few,
    parse_stopwords,
    parse_vocabulary,
    read_checked_vocabulary,
    read_stopwords,
    read_vocabulary,
    require_words,
    word_set,
)

__all__ = [
    "SHORT_STOPWORDS",
    "are_few",
    "document_lines",
    "drop_long_lines",
    "list_documents",
    "parse_df_table",
    "parse_stopwords",
    "parse_vocabulary",
    "read_checked_df_table",
    "read_checked_vocabulary",
    "read_df_table",
    "read_document_lines",
    "read_documents",
    "read_lines",
    "read_stopwords",
    "read_table",
    "read_vocabulary",
    "require_words",
    "split_documents",
    "word_set",
]
