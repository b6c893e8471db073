"""Text columns: line splitting, trimming and the five tokenizers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LINE_BREAK = r"\r\n|\r|\n"

# What separates two tokens, per tokenizer, in lower-cased text.
#
# trim_punct  white space, together with the punctuation next to it; punctuation inside a
#             chunk stays, so "(word)," gives word, "u.s." gives u.s, a URL stays whole
# alnum       anything but ASCII letters and digits
# nonword     anything but ASCII letters, digits and underscore
# apostrophe  as nonword, but an apostrophe belongs to the token
# alpha       anything but ASCII letters
SEPARATORS = {
    "trim_punct": (
        r"(?<![^a-z0-9])(?:[^a-z0-9]*\s[^a-z0-9]*|[^a-z0-9]+\z)"
        r"|^[^a-z0-9]+"
    ),
    "alnum": r"[^a-z0-9]+",
    "nonword": r"\W+",
    "apostrophe": r"[^\w']+",
    "alpha": r"[^a-zA-Z]+",
}


def token_array(text: Column | str, tokenizer: str) -> Column:
    """All tokens of a text, in order.

    The first or the last entry is an empty string when the text starts or ends with a
    separator. It shifts no distance between two tokens, so window operators leave it in;
    everything else drops it. A NULL text has a NULL array, which explodes to no rows.

    Every pattern reads each character a bounded number of times (the look-behind in
    ``trim_punct`` starts a match only at the head of a run), so a document that is one long
    run of junk costs no more than prose.
    """
    try:
        separator = SEPARATORS[tokenizer]
    except KeyError:
        known = ", ".join(SEPARATORS)
        raise ValueError(f"unknown tokenizer {tokenizer!r}; known: {known}") from None
    return F.split(F.lower(text), separator)


def line_array(text: Column | str) -> Column:
    """The lines of a text; LF, CR and CRLF each end a line."""
    return F.split(text, LINE_BREAK)


def strip_controls(text: Column | str) -> Column:
    """Trim every leading and trailing character up to the space (tabs and CR too)."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|(?<![\x00-\x20])[\x00-\x20]+\z", "")


def clean_document_id(name: Column | str) -> Column:
    """Delete every ``.txt`` from a file name."""
    return F.replace(F.col(name) if isinstance(name, str) else name, F.lit(".txt"), F.lit(""))
