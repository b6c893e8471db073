"""The registered queries in DuckDB SQL, for the side-by-side check.

They state the results independently: tokens by splitting on white space and trimming, windows
by a join on positions, stems by one common table expression per rule group.
"""

from __future__ import annotations

from wordloom.plans.queries import (
    LONG_LINE,
    MANY_PARTS,
    PARTS,
    RARE,
    RARE_DISTANCE,
    TABLE_STOPWORDS,
    WIDE_DISTANCE,
    WIDE_DISTANCE_ALL,
)
from wordloom.sources import SHORT_STOPWORDS

STOP = "stop(word) AS (VALUES " + ", ".join(f"('{w}')" for w in SHORT_STOPWORDS) + ")"

SEPARATORS = {
    "alnum": "[^a-z0-9]+",
    "nonword": r"\W+",
    "apostrophe": r"[^\w'']+",
    "alpha": "[^a-zA-Z]+",
}


def chunks(table: str = "documents", key: str = "doc_id") -> str:
    """Trimmed white-space chunks: (id, word)."""
    return rf"""
        SELECT id, word FROM (
            SELECT id, regexp_replace(chunk, '^[^a-z0-9]+|[^a-z0-9]+$', '', 'g') AS word
            FROM (SELECT {key} AS id, unnest(string_split_regex(lower(text), '\s+')) AS chunk
                  FROM {table})
        ) WHERE word <> ''"""


def tokens(tokenizer: str, table: str = "documents", key: str = "doc_id") -> str:
    """(id, word)."""
    if tokenizer == "trim_punct":
        return chunks(table, key)
    return f"""
        SELECT id, word FROM (
            SELECT {key} AS id,
                   unnest(string_split_regex(lower(text), '{SEPARATORS[tokenizer]}')) AS word
            FROM {table}
        ) WHERE word <> ''"""


LINES = r"""
        SELECT doc_id, generate_subscripts(parts, 1) AS line_no, unnest(parts) AS line
        FROM (SELECT doc_id, string_split_regex(text, '\r\n|\r|\n') AS parts FROM documents)"""


def positions(tokenizer: str, scope: str = "line", table: str = "documents", key: str = "doc_id") -> str:
    """(id, line_no, pos, word)."""
    whole = f"SELECT {key} AS id, 0 AS line_no, text AS line FROM {table}"
    split = rf"""
            SELECT id, row_number() OVER () AS line_no, line FROM (
                SELECT {key} AS id, unnest(string_split_regex(text, '\r\n|\r|\n')) AS line
                FROM {table})"""
    return f"""
        SELECT id, line_no, generate_subscripts(t, 1) AS pos, unnest(t) AS word
        FROM (SELECT id, line_no, string_split_regex(lower(line), '{SEPARATORS[tokenizer]}') AS t
              FROM ({split if scope == "line" else whole}))"""


WORD_COUNT = f"""
        SELECT word, count(*) AS cnt FROM ({chunks()})
        WHERE word NOT IN (SELECT word FROM stop) GROUP BY word"""

TOP_50 = f"""
        SELECT word, cnt FROM ({WORD_COUNT}) ORDER BY cnt DESC, word LIMIT 50"""

TOP_50_ALL = f"""
        SELECT word FROM (SELECT word, count(*) AS cnt FROM ({chunks()}) GROUP BY word)
        ORDER BY cnt DESC, word LIMIT 50"""


def hits(kept: str, distance: int) -> str:
    """(word, neighbor, s): every hit of a kept token on another, both directions."""
    return f"""
        kept AS ({kept}),
        ahead AS (
            SELECT a.word AS w, b.word AS n, a.s
            FROM (SELECT *, unnest(range(1, {distance + 1})) AS s FROM kept) a
            JOIN kept b ON a.id = b.id AND a.line_no = b.line_no AND b.pos = a.pos + a.s),
        hits AS (
            SELECT w AS word, n AS neighbor, s FROM ahead
            UNION ALL SELECT n, w, s FROM ahead)"""


def vocabulary_hits(distance: int, scope: str = "line") -> str:
    kept = f"SELECT * FROM ({positions('alnum', scope)}) WHERE word IN (SELECT word FROM vocab)"
    return f"WITH {STOP}, vocab AS ({TOP_50}), {hits(kept, distance)}"


def pairs(distance: int, scope: str = "line") -> str:
    return f"""{vocabulary_hits(distance, scope)}
        SELECT word, neighbor, count(*) AS cnt FROM hits GROUP BY word, neighbor"""


def open_kept(table: str = "documents", key: str = "doc_id") -> str:
    return f"""
        SELECT * FROM ({positions('nonword', 'line', table, key)})
        WHERE word <> '' AND word NOT IN (SELECT word FROM stop)"""


def open_hits(distance: int) -> str:
    return f"WITH {STOP}, {hits(open_kept(), distance)}"


STRIPE_TEXT = (
    "'{' || string_agg(neighbor || '=' || cnt, ', ' ORDER BY neighbor) || '}'"
)

COUNTED = "counted AS (SELECT word, neighbor, count(*) AS cnt FROM hits GROUP BY word, neighbor)"

def in_parts(parts: int, words: str, texts: dict[str, str]) -> str:
    """(word, part, ...) of counted, which has the texts' columns; every word has a part 0."""
    columns = ", ".join(f"{text} AS {name}" for name, text in texts.items())
    empty = ", ".join("'{}'" for _ in texts)
    return f"""
        placed AS (
            SELECT *, (('0x' || substr(md5(neighbor), 1, 8))::BIGINT % {parts})::INTEGER AS part
            FROM counted),
        striped AS (SELECT word, part, {columns} FROM placed GROUP BY word, part)
        SELECT word, part, {", ".join(texts)} FROM striped
        UNION ALL
        SELECT word, 0, {empty} FROM ({words})
        WHERE word NOT IN (SELECT word FROM striped WHERE part = 0)"""


def all_stripes(parts: int) -> str:
    words = "SELECT DISTINCT word FROM kept"
    return f"{open_hits(1)}, {COUNTED}, {in_parts(parts, words, {'stripe': STRIPE_TEXT})}"


WITHIN = ", ".join(f"count(*) FILTER (WHERE s <= {d}) AS cnt_d{d}" for d in (1, 2, 3, 4))
COUNTED_SWEEP = f"counted AS (SELECT word, neighbor, {WITHIN} FROM hits GROUP BY word, neighbor)"
TEXTS_BY_DISTANCE = {
    f"stripe_d{d}": f"'{{' || coalesce(string_agg(neighbor || '=' || cnt_d{d}, ', ' ORDER BY neighbor) "
    f"FILTER (cnt_d{d} > 0), '') || '}}'"
    for d in (1, 2, 3, 4)
}


def merged_side(name: str, table: str, key: str) -> str:
    kept = open_kept(table, key)
    return hits(kept, 1).replace("kept", f"kept_{name}").replace("ahead", f"ahead_{name}").replace(
        "hits", f"hits_{name}"
    )


MERGED_STRIPES = f"""WITH {STOP},
        {merged_side("d", "documents", "doc_id")},
        {merged_side("c", "conversations", "conv_id")},
        counted AS (
            SELECT word, neighbor, count(*) AS cnt
            FROM (SELECT * FROM hits_d UNION ALL SELECT * FROM hits_c) GROUP BY word, neighbor),
        {in_parts(PARTS, "SELECT word FROM kept_d UNION SELECT word FROM kept_c", {"stripe": STRIPE_TEXT})}"""


# Porter's rules over (word), in the notation in which a consonant y is written Y.
VC = "[^aeiouy]*[aeiouy]+[^aeiouy]"
VCVC = "[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]+[^aeiouy]"
STEP_2 = (
    "ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e "
    "ousli>ous ization>ize ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous "
    "aliti>al iviti>ive biliti>ble logi>log"
)
STEP_3 = "icate>ic ative> alize>al iciti>ic ical>ic ful> ness>"
STEP_4 = "al|ance|ence|er|ic|able|ible|ant|ement|ment|ent|ou|ism|ate|iti|ous|ive|ize|[st]ion"


def suffix_step(name: str, source: str, rules: str) -> str:
    table = dict(rule.split(">") for rule in rules.split())
    cases = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in table.items())
    return f"""
        {name} AS (
            SELECT word, CASE
                WHEN suffix <> '' AND regexp_matches(stem, '^{VC}')
                THEN stem || CASE suffix {cases} END ELSE w END AS w
            FROM (SELECT word, w, suffix, left(w, length(w) - length(suffix)) AS stem
                  FROM (SELECT word, w, regexp_extract(w, '({"|".join(table)})$', 1) AS suffix
                        FROM {source})))"""


def stems(words: str) -> str:
    """CTEs over a relation of distinct words; the last is stems(word, stem)."""
    return rf"""
        y AS (
            SELECT word, regexp_replace(regexp_replace(word, '(^|[aeiou])y', '\1Y', 'g'),
                                        'yy', 'yY', 'g') AS w
            FROM ({words}) WHERE length(word) > 2),
        s1a AS (
            SELECT word, CASE
                WHEN w LIKE '%sses' OR w LIKE '%ies' THEN left(w, length(w) - 2)
                WHEN w LIKE '%s' AND w NOT LIKE '%ss' THEN left(w, length(w) - 1)
                ELSE w END AS w
            FROM y),
        s1b AS (
            SELECT word, w, CASE
                WHEN w LIKE '%eed' THEN ''
                WHEN regexp_matches(w, '[aeiouy].*ed$') THEN left(w, length(w) - 2)
                WHEN regexp_matches(w, '[aeiouy].*ing$') THEN left(w, length(w) - 3)
                ELSE '' END AS cut
            FROM s1a),
        s1c AS (
            SELECT word, CASE
                WHEN w LIKE '%eed' THEN
                    CASE WHEN regexp_matches(left(w, length(w) - 3), '^{VC}')
                         THEN left(w, length(w) - 1) ELSE w END
                WHEN cut = '' THEN w
                WHEN regexp_matches(cut, '(at|bl|iz)$') THEN cut || 'e'
                WHEN length(cut) > 1 AND right(cut, 1) = substr(cut, length(cut) - 1, 1)
                     AND regexp_matches(cut, '[^aeiouy]$')
                    THEN CASE WHEN right(cut, 1) IN ('l', 's', 'z') THEN cut
                              ELSE left(cut, length(cut) - 1) END
                WHEN regexp_matches(cut, '^[^aeiouy]+[aeiouy][^aeiouywxY]$') THEN cut || 'e'
                ELSE cut END AS w
            FROM s1b),
        s1d AS (
            SELECT word, CASE WHEN regexp_matches(w, '[aeiouy].*[yY]$')
                THEN left(w, length(w) - 1) || 'i' ELSE w END AS w
            FROM s1c),
        {suffix_step("s2", "s1d", STEP_2)},
        {suffix_step("s3", "s2", STEP_3)},
        s4 AS (
            SELECT word, CASE
                WHEN suffix LIKE '_ion' AND regexp_matches(left(w, length(w) - 3), '^{VCVC}')
                    THEN left(w, length(w) - 3)
                WHEN suffix <> '' AND suffix NOT LIKE '_ion'
                     AND regexp_matches(left(w, length(w) - length(suffix)), '^{VCVC}')
                    THEN left(w, length(w) - length(suffix))
                ELSE w END AS w
            FROM (SELECT word, w, regexp_extract(w, '({STEP_4})$', 1) AS suffix FROM s3)),
        s5a AS (
            SELECT word, CASE
                WHEN w LIKE '%e' AND (regexp_matches(w, '^{VCVC}') OR (regexp_matches(w, '^{VC}')
                     AND NOT regexp_matches(w, '[^aeiouy][aeiouy][^aeiouywxY]e$')))
                    THEN left(w, length(w) - 1) ELSE w END AS w
            FROM s4),
        s5b AS (
            SELECT word, CASE WHEN w LIKE '%ll' AND regexp_matches(w, '^{VCVC}')
                THEN left(w, length(w) - 1) ELSE w END AS w
            FROM s5a),
        stems AS (
            SELECT word, replace(w, 'Y', 'y') AS stem FROM s5b
            UNION ALL SELECT word, word FROM ({words}) WHERE length(word) <= 2)"""


TABLE_STOP = f"""stop AS (
            SELECT word FROM (SELECT word, count(*) AS cnt FROM ({chunks("conversations", "conv_id")}) GROUP BY word)
            ORDER BY cnt DESC, word LIMIT {TABLE_STOPWORDS})"""


def document_frequency(table: str = "documents", key: str = "doc_id", stop: str = STOP) -> str:
    """CTEs ending in df(term, df)."""
    found = f"SELECT DISTINCT id, word FROM ({tokens('apostrophe', table, key)}) WHERE word NOT IN (SELECT word FROM stop)"
    return f"""{stop},
        found AS ({found}),
        {stems("SELECT DISTINCT word FROM found")},
        df AS (
            SELECT stem AS term, count(DISTINCT id) AS df FROM found JOIN stems USING (word)
            GROUP BY stem)"""


TOP_100 = "SELECT term, df FROM df ORDER BY df DESC, term DESC LIMIT 100"


def term_frequency() -> str:
    """CTEs ending in top100(term, df) and tf(id, term, tf)."""
    second = stems("SELECT DISTINCT word FROM letters")
    for name in ("y", "s1a", "s1b", "s1c", "s1d", "s2", "s3", "s4", "s5a", "s5b", "stems"):
        second = second.replace(f"{name} AS (", f"{name}_t AS (").replace(
            f"FROM {name}", f"FROM {name}_t"
        )
    return f"""{document_frequency()},
        top100 AS ({TOP_100}),
        letters AS ({tokens("alpha")}),
        {second},
        tf AS (
            SELECT id AS doc_id, stem AS term, count(*) AS tf
            FROM letters JOIN stems_t USING (word) GROUP BY id, stem)"""


SCORES = f"""WITH {term_frequency()},
        scores AS (
            SELECT doc_id, term, round(tf * ln(10000.0 / df + 1.0), 6) AS score
            FROM tf JOIN top100 USING (term))"""

COUNTERS = f"""{SCORES}
        SELECT 'documents' AS counter, count(*) AS value FROM documents
        UNION ALL SELECT 'terms', count(*) FROM df
        UNION ALL SELECT 'term_document_pairs', sum(df)::BIGINT FROM df
        UNION ALL SELECT 'score_rows', count(*) FROM scores"""

LINE_SIZES = """
        SELECT doc_id, count(*) AS lines, sum(octet_length(encode(line)))::BIGINT AS bytes"""

TRIM = r"'^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'"

RARE_WORDS = f"""
        SELECT word FROM ({tokens("alnum", "conversations", "conv_id")}) GROUP BY word HAVING count(*) <= {RARE}"""

ORACLE = {
    "cooc_pairs_blocks": f"""{vocabulary_hits(2)}
        SELECT least(w, n) AS a, greatest(w, n) AS b, count(*) AS cnt FROM ahead GROUP BY 1, 2""",
    "cooc_pairs_wide": pairs(WIDE_DISTANCE),
    "cooc_words_wide": f"""WITH {hits(f"SELECT * FROM ({positions('alnum')}) WHERE word <> ''", WIDE_DISTANCE_ALL)}
        SELECT word, count(DISTINCT neighbor) AS neighbors, count(*) AS cnt FROM hits GROUP BY word""",
    "cooc_pairs_rare": f"""WITH vocab AS ({RARE_WORDS}),
        {hits(f"SELECT * FROM ({positions('alnum')}) WHERE word IN (SELECT word FROM vocab)", RARE_DISTANCE)}
        SELECT word, neighbor, count(*) AS cnt FROM hits GROUP BY word, neighbor""",
    "stopword_filter_large": f"""
        SELECT word, count(*) AS cnt FROM ({tokens("alnum")})
        WHERE word NOT IN ({RARE_WORDS}) GROUP BY word""",
    "vocab_filter_large": f"""
        SELECT id AS doc_id, count(*) AS cnt, count(DISTINCT word) AS words
        FROM ({tokens("alnum")}) WHERE word IN ({RARE_WORDS}) GROUP BY id""",
    "doc_freq_dictionary": f"WITH {document_frequency()} SELECT term, df FROM df",
    "doc_freq_listed_in_row": f"""WITH {document_frequency(stop=TABLE_STOP)}
        SELECT term, df FROM df""",
    "term_freq_dictionary": f"""WITH {term_frequency()}
        SELECT doc_id, term, tf FROM tf WHERE term IN (SELECT term FROM top100)""",
    "stripes_merge_stored": MERGED_STRIPES,
    "counters_observed": COUNTERS,
    "file_lines": f"""
        SELECT lines, count(*) AS files
        FROM (SELECT doc_id, count(*) AS lines FROM ({LINES}) GROUP BY doc_id) GROUP BY lines""",
    "doc_freq_files": f"WITH {document_frequency()} SELECT term, df FROM df",
    "clustered_lookup": f"""WITH {STOP}
        SELECT word, count(*) AS cnt FROM ({tokens("nonword")})
        WHERE word IN (SELECT word FROM stop) GROUP BY word""",
    "top_words": f"WITH {STOP} {TOP_50}",
    "word_count": f"WITH {STOP} {WORD_COUNT}",
    **{
        f"tokens_{t}": f"SELECT word, count(*) AS cnt FROM ({tokens(t)}) GROUP BY word"
        for t in ("trim_punct", "alnum", "nonword", "apostrophe", "alpha")
    },
    "stopword_filter": f"""WITH {STOP}
        SELECT word, count(*) AS cnt FROM ({tokens("nonword")}) t
        WHERE NOT EXISTS (SELECT 1 FROM stop WHERE stop.word = t.word) GROUP BY word""",
    "vocab_filter": f"""WITH {STOP}, vocab AS ({TOP_50})
        SELECT id AS doc_id, count(*) AS cnt, count(DISTINCT word) AS words
        FROM ({tokens("alnum")}) WHERE word IN (SELECT word FROM vocab) GROUP BY id""",
    "lines": f"{LINE_SIZES} FROM ({LINES}) GROUP BY doc_id",
    "long_line_skip": f"""{LINE_SIZES} FROM ({LINES})
        WHERE octet_length(encode(line)) + 1 < {LONG_LINE} GROUP BY doc_id""",
    "document_id_cleanup": "SELECT doc_id, source || '-' || doc_id AS name FROM documents",
    "cooc_pairs": pairs(2),
    "cooc_pairs_document": pairs(2, "document"),
    "cooc_pairs_sweep": f"""{vocabulary_hits(4)}
        SELECT word, neighbor,
               count(*) FILTER (WHERE s <= 1) AS cnt_d1, count(*) FILTER (WHERE s <= 2) AS cnt_d2,
               count(*) FILTER (WHERE s <= 3) AS cnt_d3, count(*) FILTER (WHERE s <= 4) AS cnt_d4
        FROM hits GROUP BY word, neighbor""",
    "cooc_stripes": f"""WITH {STOP},
        vocab AS (SELECT word FROM ({TOP_50_ALL}) WHERE word NOT IN (SELECT word FROM stop)),
        {hits(f"SELECT * FROM ({positions('alnum')}) WHERE word IN (SELECT word FROM vocab)", 2)},
        {COUNTED}
        SELECT word, {STRIPE_TEXT} AS stripe FROM counted GROUP BY word""",
    "cooc_stripes_sweep": f"""WITH {STOP},
        vocab AS (SELECT word FROM ({TOP_50_ALL}) WHERE word NOT IN (SELECT word FROM stop)),
        {hits(f"SELECT * FROM ({positions('alnum')}) WHERE word IN (SELECT word FROM vocab)", 4)},
        {COUNTED_SWEEP}
        SELECT word, {", ".join(f"{text} AS {name}" for name, text in TEXTS_BY_DISTANCE.items())}
        FROM counted GROUP BY word""",
    "cooc_stripes_all": all_stripes(PARTS),
    "cooc_stripes_all_sweep": f"""{open_hits(4)}, {COUNTED_SWEEP},
        {in_parts(PARTS, "SELECT DISTINCT word FROM kept", TEXTS_BY_DISTANCE)}""",
    "cooc_stripes_split": all_stripes(MANY_PARTS),
    "empty_stripes": f"""{open_hits(1)}
        SELECT DISTINCT word FROM kept WHERE word NOT IN (SELECT word FROM hits)""",
    "stripes_to_pairs": f"""{open_hits(2)}
        SELECT word, neighbor, count(*) AS cnt FROM hits GROUP BY word, neighbor""",
    "stripes_merge": MERGED_STRIPES,
    "pairs_text": f"""{vocabulary_hits(1)}
        SELECT '(' || word || ',' || neighbor || ')' AS pair, count(*) AS cnt
        FROM hits GROUP BY word, neighbor""",
    "doc_freq": f"WITH {document_frequency()} SELECT term, df FROM df",
    "doc_freq_raw": f"""WITH {STOP}
        SELECT word AS term, count(DISTINCT id) AS df FROM ({tokens("apostrophe")})
        WHERE word NOT IN (SELECT word FROM stop) GROUP BY word""",
    "doc_freq_conversations": f"""WITH {document_frequency("conversations", "conv_id")}
        SELECT term, df FROM df""",
    "doc_freq_stopword_table": f"""WITH {document_frequency(stop=TABLE_STOP)}
        SELECT term, df FROM df""",
    "doc_freq_top100": f"WITH {document_frequency()} {TOP_100}",
    "porter_stem": f"""WITH {stems(f"SELECT DISTINCT word FROM ({tokens('apostrophe')})")}
        SELECT word, stem FROM stems""",
    "term_freq": f"""WITH {term_frequency()}
        SELECT doc_id, term, tf FROM tf WHERE term IN (SELECT term FROM top100)""",
    "tfidf": f"{SCORES} SELECT doc_id, term, score FROM scores",
    "tfidf_unknown_terms": f"""WITH {term_frequency()}
        SELECT doc_id, term, round(tf * ln(10000.0 / coalesce(df, 1) + 1.0), 6) AS score
        FROM tf LEFT JOIN top100 USING (term)""",
    "corpus_counters": COUNTERS,
    "df_table_parse": """
        SELECT p_name || ' ' || p_partkey AS term, p_size::BIGINT AS df FROM part""",
    "wordlist_parse": rf"""
        SELECT DISTINCT word FROM (
            SELECT lower(string_split_regex(line, '\s+')[1]) AS word FROM ({LINES})
        ) WHERE word <> ''""",
    "stopword_parse": f"""
        SELECT DISTINCT word FROM (
            SELECT lower(regexp_replace(line, {TRIM})) AS word FROM ({LINES})
        ) WHERE word <> ''""",
    "counts_text": f"""WITH {STOP}
        SELECT word || chr(9) || cnt AS value FROM ({WORD_COUNT})""",
    "stripes_text": f"SELECT word || chr(9) || part || chr(9) || stripe AS value FROM ({all_stripes(PARTS)})",
    "scores_text": f"""{SCORES}
        SELECT doc_id || chr(9) || term || chr(9) || format('{{:.6f}}', score) AS value FROM scores""",
}
