"""Alignment of two tokenizers against whole-text encoding, token by token."""

import hashlib
from collections import Counter
from functools import cache

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from wordloom.llm import tokenizer_alignment

FOLDER = "/root/testdata/sf0.001"


@cache
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_alignment.A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_alignment.B_PATH)
    chars = tokenizer_alignment._byte_chars()
    a_bytes = {i: bytes(chars[c] for c in t) for t, i in a.get_vocab().items() if all(c in chars for c in t)}
    b_bytes = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in range(b.get_piece_size())
    ]
    return a, b, a_bytes, b_bytes


def brute(documents):
    a, b, a_bytes, b_bytes = tokenizers()
    rows, counts = [], Counter()
    for doc_id, text in documents:
        x, y, whole = [], [], (" " + (text or "")).encode()
        if text:
            x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            if b"".join(a_bytes[i] for i in x) != whole or b"".join(b_bytes[i] for i in y) != whole:
                x, y = [], []
        i = j = ends_x = ends_y = 0
        links, groups, left, right = [], [], [], []
        if x:
            ends_x, ends_y, left, right = len(a_bytes[x[0]]), len(b_bytes[y[0]]), [x[0]], [y[0]]
        while i < len(x):
            links.append((x[i], y[j]))
            both, more_x = ends_x == ends_y, ends_x < ends_y
            if both:
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                left, right = [], []
            if both or more_x:
                i += 1
                if i < len(x):
                    left.append(x[i])
                    ends_x += len(a_bytes[x[i]])
            if both or not more_x:
                j += 1
                if j < len(y):
                    right.append(y[j])
                    ends_y += len(b_bytes[y[j]])
        counts.update(links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        rows.append((doc_id, len(x), len(y), len(groups), links, sha))
    best = {}
    for (_, right_id), n in counts.items():
        best[right_id] = max(best.get(right_id, 0), n)
    return sorted(
        (
            (d, m, n, g, len(ln), sum(counts[p] == best[p[1]] for p in ln), sum(counts[p] for p in ln), sha)
            for d, m, n, g, ln, sha in rows
        ),
        key=repr,
    )


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ODD = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "  a  b \n c\t\td "),
    (5, "a▁b c"),
    (6, "<|endoftext|> <s> </s><unk>"),
    (7, "日本語 テキスト 😀😀 é é"),
    (8, "it's  we'll don't I'M"),
    (9, "a  b c \x1c d\x85 e 　 f"),
    (10, "ﬁ\x00 x"),
    (11, "word " * 5000),
    (12, "x" * 3000),
    (13, "\n\n \n a"),
    (14, "tail of spaces  \n "),
    (15, "“quoted” \u2003em  x\u00a0 y\u3000 z\u0085 w \x7f v"),
    (16, "sp ace\t\t  tabs \r\n crlf"),
    (8, "it's  we'll don't I'M"),
    (None, "no id"),
]


def test_odd_texts(spark, monkeypatch):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").coalesce(2)
    docs = docs.select("*", F.lit(1).alias("block"), F.lit("x").alias("units"), F.lit(0).alias("pair"))
    expected = brute(ODD)
    assert got(tokenizer_alignment.align(docs)) == expected
    monkeypatch.setattr(tokenizer_alignment, "BLOCK", 60)  # many blocks
    monkeypatch.setattr(tokenizer_alignment, "UNITS", 2)  # and units forgotten between them
    monkeypatch.setattr(tokenizer_alignment, "CALL", 3)
    assert got(tokenizer_alignment.align(docs)) == expected
    assert got(tokenizer_alignment.align(docs.limit(0))) == []
    assert got(tokenizer_alignment.align(docs.where("doc_id < 3"))) == brute(ODD[:2])


def test_query(spark):
    documents = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert got(tokenizer_alignment.query(spark, FOLDER)) == brute(documents)


def test_blocks_are_read_a_few_at_a_time(spark, monkeypatch):
    """Row groups stay small, whatever a block's size: a reader holds one row group's lists at once."""
    monkeypatch.setattr(tokenizer_alignment, "BLOCK", 4 << 10)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").coalesce(1)
    original = tokenizer_alignment._settled.__globals__["fresh_path"]
    paths = []
    monkeypatch.setattr(tokenizer_alignment, "fresh_path", lambda *x: paths.append(original(*x)) or paths[-1])
    tokenizer_alignment.aligned_blocks(docs)
    import glob

    files = glob.glob(paths[0].removeprefix("file:") + "/*.parquet")
    assert sum(pq.ParquetFile(f).metadata.num_rows for f in files) > 50
    assert all(
        pq.ParquetFile(f).metadata.row_group(g).total_byte_size < 32 << 20
        for f in files
        for g in range(pq.ParquetFile(f).metadata.num_row_groups)
    )


def test_links_between_different_bytes_are_counted_with_the_plain_ones(spark):
    """A pair of same bytes may also be linked inside an irregular group; its count holds both."""
    rows = [(i, t) for i, t in enumerate(["aaaa aaa", "aaa", "aaaaaaaaa aa", "a a a", "aaaaa"] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(tokenizer_alignment.align(docs)) == brute(rows)
