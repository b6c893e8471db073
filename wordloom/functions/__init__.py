"""Column expressions; all of them run in the JVM."""

from wordloom.functions.formats import pair_text, score_text, stripe_text
from wordloom.functions.porter import stem, stem_array
from wordloom.functions.text import (
    SEPARATORS,
    clean_document_id,
    line_array,
    strip_controls,
    token_array,
)

__all__ = [
    "SEPARATORS",
    "clean_document_id",
    "line_array",
    "pair_text",
    "score_text",
    "stem",
    "stem_array",
    "stripe_text",
    "strip_controls",
    "token_array",
]
