"""Porter's suffix stripping (Porter 1980) as JVM-side column expressions.

Each rule group is one expression over a token. ``stem_array`` applies the groups one after
the other with ``transform``; the lambda variable names the intermediate result, so a rule
may look at its input many times without the expression tree growing.

Two later amendments by the algorithm's author are included: ``bli`` becomes ``ble`` and
``logi`` becomes ``log``. Tokens of up to two characters stay as they are. Any character but
a, e, i, o, u and (after a consonant) y counts as a consonant, digits and apostrophes too.

While the rules run, a ``y`` that acts as a consonant is written ``Y``, which makes "vowel" and
"consonant" plain character classes, and a token that is too short carries a final ``X``, which
no rule fits. All patterns with a repeated part are anchored at the
start and possessive there, so their cost is linear in the token, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vowels and consonants once consonant y is written Y.
V = "[aeiouy]"
C = "[^aeiouy]"
# Consonants that may end a consonant-vowel-consonant stem.
C_END = "[^aeiouywxY]"
# Consonants that are written once after a removed "ed" or "ing".
C_SINGLE = "[^aeiouylsz]"

HAS_VOWEL = f"{C}*+{V}"
MEASURE_1 = f"{C}*+{V}++{C}"
MEASURE_2 = f"{C}*+{V}++{C}++{V}++{C}"

# Suffix and what replaces it when a vowel-consonant pair stands before it.
DOUBLE_SUFFIXES = {
    "ational": "ate",
    "tional": "tion",
    "enci": "ence",
    "anci": "ance",
    "izer": "ize",
    "bli": "ble",
    "alli": "al",
    "entli": "ent",
    "eli": "e",
    "ousli": "ous",
    "ization": "ize",
    "ation": "ate",
    "ator": "ate",
    "alism": "al",
    "iveness": "ive",
    "fulness": "ful",
    "ousness": "ous",
    "aliti": "al",
    "iviti": "ive",
    "biliti": "ble",
    "logi": "log",
}

SINGLE_SUFFIXES = {
    "icate": "ic",
    "ative": "",
    "alize": "al",
    "iciti": "ic",
    "ical": "ic",
    "ful": "",
    "ness": "",
}

# Suffixes removed when two vowel-consonant pairs stand before them; "ion" only
# after s or t. The longest that fits decides.
LAST_SUFFIXES = [
    "al",
    "ance",
    "ence",
    "er",
    "ic",
    "able",
    "ible",
    "ant",
    "ement",
    "ment",
    "ent",
    "ion",
    "ou",
    "ism",
    "ate",
    "iti",
    "ous",
    "ive",
    "ize",
]


def _mark(w: Column) -> Column:
    after_vowel_or_first = F.regexp_replace(w, "(^|[aeiou])y", "$1Y")
    consonants = F.regexp_replace(after_vowel_or_first, "yy", "yY")
    too_short = F.length(w) <= 2
    return (
        F.when(too_short, F.concat(w, F.lit("X"))).when(w.contains("y"), consonants).otherwise(w)
    )


def _cut(w: Column, n: int) -> Column:
    """``w`` without its last ``n`` characters."""
    return F.substring(w, F.lit(1), F.length(w) - n)


def _plural(w: Column) -> Column:
    return (
        F.when(~w.endswith("s") | w.endswith("ss"), w)
        .when(w.endswith("sses") | w.endswith("ies"), _cut(w, 2))
        .otherwise(_cut(w, 1))
    )


def _past_and_gerund(w: Column) -> Column:
    ending = "(?:ed|ing)$"
    takes_e = w.rlike(f"(?:at|bl|iz){ending}") | w.rlike(f"^{C}+{V}{C_END}{ending}")
    return (
        F.when(~(w.endswith("ed") | w.endswith("ing")), w)
        .when(w.endswith("eed"), F.regexp_replace(w, f"^({MEASURE_1}.*)eed$", "$1ee"))
        .when(~w.rlike(f"^{HAS_VOWEL}.*{ending}"), w)
        .when(takes_e, F.regexp_replace(w, ending, "e"))
        .otherwise(F.regexp_replace(w, f"({C_SINGLE})\\1{ending}|{ending}", "$1"))
    )


def _final_y(w: Column) -> Column:
    replaced = F.regexp_replace(w, f"^({HAS_VOWEL}.*)[yY]$", "$1i")
    return F.when(w.endswith("y") | w.endswith("Y"), replaced).otherwise(w)


def _may_end_in(w: Column, suffixes) -> Column:
    """Cheap test on the last characters; it spares most tokens the regular expressions."""
    n = min(3, *(len(s) for s in suffixes))
    return F.substring(w, -n, n).isin(sorted({s[-n:] for s in suffixes}))


def _replace_suffix(w: Column, table: dict[str, str]) -> Column:
    """Replace the longest suffix of the table that ``w`` ends in, if its stem is long enough."""
    longest_first = sorted(table, key=len, reverse=True)
    branches = F.when(~_may_end_in(w, table), w)
    for suffix in longest_first:
        replaced = F.regexp_replace(w, f"^({MEASURE_1}.*){suffix}$", f"$1{table[suffix]}")
        branches = branches.when(w.endswith(suffix), replaced)
    return branches.otherwise(w)


def _double_suffix(w: Column) -> Column:
    return _replace_suffix(w, DOUBLE_SUFFIXES)


def _single_suffix(w: Column) -> Column:
    return _replace_suffix(w, SINGLE_SUFFIXES)


def _last_suffix(w: Column) -> Column:
    # "ion" needs s or t before it; a shorter suffix counts only where no longer one fits.
    context = {"ion": "(?<=[st])ion", "ment": "(?<!e)ment", "ent": "(?<!m)ent"}
    suffix = "|".join(context.get(s, s) for s in LAST_SUFFIXES)
    removed = F.regexp_replace(w, f"^({MEASURE_2}.*)(?:{suffix})$", "$1")
    return F.when(_may_end_in(w, LAST_SUFFIXES), removed).otherwise(w)


def _final_e(w: Column) -> Column:
    drop = w.rlike(f"^{MEASURE_1}") & ~w.rlike(f"^{C}++{V}{C_END}e$")
    return F.when(w.endswith("e") & drop, _cut(w, 1)).otherwise(w)


def _final_ll(w: Column) -> Column:
    return F.when(w.endswith("ll") & w.rlike(f"^{MEASURE_2}"), _cut(w, 1)).otherwise(w)


def _unmark(w: Column) -> Column:
    return F.when(w.contains("Y") | w.endswith("X"), F.translate(w, "YX", "y")).otherwise(w)


_RULES = [
    _mark,
    _plural,
    _past_and_gerund,
    _final_y,
    _double_suffix,
    _single_suffix,
    _last_suffix,
    _final_e,
    _final_ll,
    _unmark,
]


def stem_array(tokens: Column) -> Column:
    """Stem every entry of an array of lower-case tokens."""
    stems = tokens
    for rule in _RULES:
        stems = F.transform(stems, rule)
    return stems


def stem(token: Column) -> Column:
    """Stem one lower-case token."""
    return F.element_at(stem_array(F.array(token)), 1)
