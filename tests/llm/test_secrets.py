import hashlib
import random
import re

import duckdb
import pytest

from wordloom.llm import secrets
from wordloom.llm.trigrams import trigram_query

FOLDER = "/root/testdata/sf0.01"


def brute(text):
    found = []
    for rank, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), rank, rule.kind, m.end()))
    return sorted(found)


CASES = [
    'password=hunter22 Token: "abcdef" x',
    "token=abc token = 'abcdefg'",
    "token=token=abcdef secret:secret",
    'é🎉 api_key = "0123456789abcdef01234567"',
    "AKIA" + "A" * 16 + " AKIA123 AKIAAKIA" + "Z" * 20,
    "0123456789abcdef" * 3 + "g" + "a" * 23,
    "ghp_" + "a" * 36 + " xoxb-1234567890-abc AIza" + "b" * 35,
    "-----BEGIN RSA PRIVATE KEY----- eyJ" + "a" * 12 + "." + "b" * 12 + "." + "c" * 12,
    "Authorization: Bearer " + "a" * 20 + " bearer short",
    "postgres://user:secretpw@host/x https://a:b@c",
    "",
    None,
    "plain words only",
    "password=hunter22" * 3,
    " ".join(["x"] * 50_000) + " secret=abcdefgh",
]


def test_spans_against_brute_force(documents):
    rows = secrets.find_secrets(documents(CASES)).collect()
    got = {r.row.doc_id: [tuple(s) for s in r.spans] for r in rows}
    assert got == {i: brute(t) for i, t in enumerate(CASES)}


def test_random_texts_against_brute_force(documents):
    rng = random.Random(5)
    bits = ["password", "Secret", "token", "api_key", "=", ":", " ", '"', "abcdef", "AKIA", "0" * 24, "é", "\n", "ABCDEF0123456789"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(300)]
    rows = secrets.find_secrets(documents(texts)).collect()
    assert all([tuple(s) for s in r.spans] == brute(texts[r.row.doc_id]) for r in rows)


def test_repeated_and_null_ids(documents):
    rows = secrets.find_secrets(documents(["secret=abcdef", "none", "token=abcdef"], [1, 1, None])).collect()
    assert sorted((str(r.row.doc_id), len(r.spans)) for r in rows) == [("1", 0), ("1", 1), ("None", 1)]


def test_redaction(documents):
    out = secrets.redact(documents(["a password=hunter22 b", 'x token = "0123456789abcdef01234567" y', None, "same"]))
    assert [r.text for r in out.orderBy("doc_id").collect()] == ["a [secret] b", 'x [secret]" y', None, "same"]
    assert [r.n_chars for r in out.orderBy("doc_id").collect()] == [12, 13, None, 4]
    assert "spans" in out.columns


def plainly_masked(text):
    out, at = "", 0
    for start, _, _, end in brute(text):
        if start >= at:
            out += text[at:start] + secrets.MASK
        at = max(at, end)
    return out + text[at:]


def test_redaction_against_brute_force(documents, monkeypatch):
    rng = random.Random(7)
    bits = ["password=abcdefgh ", "é🎉", "token:0123456789abcdef01234567", " x ", "AKIA" + "A" * 16, "https://u:secretpw@h ", "\n"]
    texts = [t for t in CASES if t] + ["".join(rng.choice(bits) for _ in range(rng.randrange(200))) for _ in range(40)]
    expected = [plainly_masked(t) for t in texts]
    assert [r.text for r in secrets.redact(documents(texts)).orderBy("doc_id").collect()] == expected
    monkeypatch.setattr(secrets, "CUT", 3)
    monkeypatch.setattr(secrets, "STEP", 2)
    assert [r.text for r in secrets.redact(documents(texts)).orderBy("doc_id").collect()] == expected
    rows = secrets.find_secrets(documents(texts)).collect()
    assert all([tuple(s) for s in r.spans] == brute(texts[r.row.doc_id]) for r in rows)


def test_a_hundred_thousand_matches_in_one_text(documents):
    import time

    text = "secret=abcdef " * 100_000
    docs = documents([text])
    start = time.perf_counter()
    spans = secrets.find_secrets(docs).first().spans
    assert len(spans) == 100_000 and tuple(spans[-1]) == (14 * 99_999, 0, "assign", 14 * 99_999 + 13)
    out = secrets.redact(docs).first().text
    assert out == "[secret] " * 100_000
    assert time.perf_counter() - start < 90


def test_few_candidates_leave_the_texts_where_they_are(documents, monkeypatch):
    docs = documents(["secret=abcdef", "none", None])

    def plan():
        df = secrets.find_secrets(docs)
        return df, df._jdf.queryExecution().executedPlan().toString()

    df, text = plan()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    monkeypatch.setattr(secrets, "BROADCAST_BYTES", 0)
    other, text = plan()
    assert sorted(map(repr, df.collect())) == sorted(map(repr, other.collect()))


def test_empty_table(documents, spark):
    assert secrets.find_secrets(documents(["x"]).limit(0)).collect() == []


@pytest.mark.parametrize(
    "pattern, expected",
    [
        ("abcd", [{"abc", "bcd"}]),
        ("(abc|xyz)[0-9]+", [{"abc"}, {"xyz"}]),
        ("ab?c", None),
        ("[0-9a-f]+", None),
        ("(?:abc)+x", [{"abc"}]),
        ("(?:abc)?[0-9]+", None),
        ("abc.*def", [{"abc", "def"}]),
    ],
)
def test_trigram_queries(pattern, expected):
    query = trigram_query(pattern)
    assert query == expected or sorted(map(sorted, query)) == sorted(map(sorted, expected))


def test_every_match_satisfies_the_query(documents):
    for rule in secrets.RULES:
        query = trigram_query(rule.pattern)
        for text in CASES:
            if query and text and re.search(rule.pattern, text):
                assert any(all(t in text.lower() for t in q) for q in query)


def test_query_against_sql(spark):
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    df = secrets.query(spark, FOLDER)
    relation = database.sql(secrets.ORACLE)
    order = [relation.columns.index(c) for c in df.columns]
    expected = sorted(tuple(r[i] for i in order) for r in relation.fetchall())
    assert sorted(map(tuple, df.collect())) == expected
    empty = hashlib.sha256(b"").hexdigest()
    assert any(r[4] != empty for r in expected)
