"""Tokenization, decontamination, quality rules and the classifier against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wordloom.llm import decontaminate, ordinal_quality, quality_rules, sentencepiece_codec
from wordloom.llm.hashing import U64, text_bytes

FOLDER = "/root/testdata/sf0.001"

# --- SentencePiece --------------------------------------------------------------------------

TEXTS = [
    "Hello world",
    "",
    None,
    " ",
    "   lead and  double   spaces  ",
    "tab\tand\nnewline\r\n",
    "日本語 🎉 é ñ",
    "<s> <unk> <0x0A> </s>",
    "marker▁inside ▁",
    "x" * 3000,
    "a b " * 2000,
    " " * 40 + "z",
]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL_PATH)


def test_ids_equal_the_library(documents, library, spark):
    df = sentencepiece_codec.encode(documents(TEXTS))
    rows = {r.doc_id: r for r in df.collect()}
    for i, text in enumerate(TEXTS):
        assert rows[i].ids == library.encode(text or ""), text
        assert rows[i].n_differences == 0
        assert rows[i].round_trip == ("▁" not in (text or ""))
    back = {r.doc_id: r.text for r in sentencepiece_codec.decode(df).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(TEXTS))
    assert sentencepiece_codec.encode(documents(["x"]).limit(0)).collect() == []


def test_given_table_round_trips(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in sentencepiece_codec.query(spark, FOLDER).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        assert rows[d.doc_id].round_trip and rows[d.doc_id].n_differences == 0
        assert rows[d.doc_id].ids == library.encode(d.text)


def varint(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def message(number, data):
    return varint(number << 3 | 2) + varint(len(data)) + data


def flag(number, value):
    return varint(number << 3) + varint(value)


def unigram_model(squeeze, byte_fallback=True):
    """A small model file: unigram scores, byte pieces, a user-defined piece where spaces collapse."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if byte_fallback:
        pieces += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    words = {"▁": -3.0, "▁he": -4.0, "▁the": -3.5, "the": -4.5, "re": -4.0, "t": -6.0, "h": -6.0, "e": -5.0, "r": -6.0, "▁there": -7.2}
    pieces += [(w, s, 1) for w, s in words.items()]
    data = b""
    for text, score, kind in pieces:
        body = message(1, text.encode()) + varint(2 << 3 | 5) + np.float32(score).tobytes() + flag(3, kind)
        data += message(1, body)
    data += message(2, flag(3, 1) + flag(35, int(byte_fallback)) + flag(40, 0))
    return data + message(3, flag(3, 1) + flag(4, int(squeeze)) + flag(5, 1))


@pytest.mark.parametrize("squeeze", [False, True])
def test_unigram_models_are_rebuilt_from_scores(squeeze):
    codec = sentencepiece_codec.Codec(unigram_model(squeeze), 1)
    assert codec.model.unigram and codec.by_unit == (not squeeze)
    texts = ["there the he", "the  there", "hx e", "", " the ", "rethere"]
    data, offsets = text_bytes(pa.array(texts))
    ids, at, differs = codec.encode(data, offsets)
    assert not differs.any()
    for i, text in enumerate(texts):
        assert list(ids[at[i] : at[i + 1]]) == codec.exact.encode(text)
        assert list(codec.encode_texts([text])[0][0]) == codec.exact.encode(text)


def test_a_broken_model_is_an_error(documents, tmp_path):
    (tmp_path / "m").write_bytes(b"\x0b")
    with pytest.raises(ValueError):
        sentencepiece_codec.encode(documents(["x"]), str(tmp_path / "m"))


# --- decontamination -----------------------------------------------------------------------


def score_of(item, passage):
    """Smith-Waterman by the book."""
    best, row = 0, [0] * (len(passage) + 1)
    for w in item:
        new = [0]
        for j, p in enumerate(passage, 1):
            same = row[j - 1] + (2 if w == p else -1)
            new.append(max(0, same, row[j] - 1, new[j - 1] - 1))
            best = max(best, new[j])
        row = new
    return best


def test_alignment_against_the_recurrence():
    rng = np.random.default_rng(1)
    item = rng.integers(2, 6, (40, 9)).astype(U64)
    passage = rng.integers(2, 6, (40, 25)).astype(U64)
    best, end = decontaminate.align(item, passage)
    behind = np.arange(25)[None, :] >= end[:, None]
    again, start = decontaminate.align(item, np.where(behind, U64(1), passage), backwards=True)
    for i in range(40):
        assert best[i] == score_of(list(item[i]), list(passage[i])) == again[i]
        assert best[i] == score_of(list(item[i]), list(passage[i, start[i] : end[i]]))


def test_edited_copies_and_clean_documents(documents, spark):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(5000)}"
    items = [" ".join(word() for _ in range(40)) for _ in range(6)] + ["too short to tell", None]
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    filler = lambda n: " ".join(word() for _ in range(n))
    edited = items[2].split()
    for k in range(0, 40, 9):
        edited[k] = "changed"
    del edited[20]
    texts = [
        f"{filler(50)} {items[0]} {filler(30)}",
        items[1].upper().replace(" ", ", "),
        f"{filler(5)} {' '.join(edited)} {filler(500)}",
        filler(400),
        "too short to tell",
        None,
        "",
        " ".join(items[3].split()[:30]),
        f"{items[4]} {filler(10)} {items[5]}",
        items[0],
    ]
    rows = decontaminate.leaks(documents(texts), benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(0, 0), (1, 1), (2, 2), (4, 6), (7, 3), (8, 4), (8, 5), (9, 0)]
    by = {(r.doc_id, r.item_id): r for r in rows}
    assert by[0, 0].similarity == 1.0 and (by[0, 0].first_word, by[0, 0].end_word) == (50, 90)
    assert 0.7 < by[2, 2].similarity < 0.95


def words_of(text):
    return [w.strip("".join(c for c in map(chr, range(33, 127)) if not c.isalnum())) or w[-1] for w in text.lower().split()]


def all_pairs(texts, items, similarity=0.5):
    """Every (text, item) whose whole alignment reaches the score; short items verbatim."""
    found = set()
    for i, text in enumerate(texts):
        passage = words_of(text)
        for k, item in enumerate(items):
            own = words_of(item)
            if len(own) >= decontaminate.MIN_WORDS:
                if score_of(own, passage) >= similarity * 2 * len(own):
                    found.add((i, k))
            elif own and len(own) >= decontaminate.WHOLE_WORDS:
                if any(passage[j : j + len(own)] == own for j in range(len(passage))):
                    found.add((i, k))
            elif own and passage == own:
                found.add((i, k))
    return found


@pytest.mark.parametrize("words", [4000, 60])
def test_every_leak_is_found(documents, spark, words):
    """Against the alignment of all texts with all items: edits at regular and random places, of every kind."""
    rng = random.Random(words)
    word = lambda: f"w{min(rng.randrange(words), rng.randrange(words))}"
    items = [" ".join(word() for _ in range(n)) for n in (8, 9, 12, 20, 40, 40, 41, 59, 15, 16)]
    items += ["three short words", "yes", "a b", "yes no maybe so"]
    texts = []
    for own in (t.split() for t in items if len(t.split()) >= 8):
        for step in (2, 3, 4, 5):
            for edit in ("change", "insert", "drop"):
                new = []
                for j, w in enumerate(own):
                    if j % step != step - 1 or edit == "insert":
                        new.append(w)
                    if j % step == step - 1 and edit != "drop":
                        new.append(f"e{rng.randrange(9)}")
                texts.append(" ".join([word() for _ in range(rng.randrange(30))] + new + [word() for _ in range(rng.randrange(30))]))
        for share in (0.1, 0.2, 0.25, 0.3, 0.35):
            for _ in range(4):
                new = []
                for w in own:
                    kind = rng.random()
                    if kind < share / 3:
                        continue
                    new += ["x"] if kind < share * 2 / 3 else ["x", w] if kind < share else [w]
                texts.append(" ".join([word() for _ in range(9)] + new))
    texts += ["they are three short words indeed", "yes", "yes and no", "A, b.", "a b c", "well: yes no maybe so!", "yes no maybe"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = decontaminate.leaks(documents(texts), benchmark).collect()
    expected = all_pairs(texts, items)
    assert {(r.doc_id, r.item_id) for r in rows} == expected and len(rows) == len(expected) > 150
    for r in rows:
        if r.item_id < 10:
            assert r.score == score_of(words_of(items[r.item_id]), words_of(texts[r.doc_id]))


def test_a_hot_passage_keeps_its_seeds_and_blocks_change_nothing(documents, spark, monkeypatch):
    items = [" ".join(f"i{k}w{j}" for j in range(20)) for k in range(5)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"d{i} {items[0]} e{i}" for i in range(60)] + [items[3] + " x", "none of it"]
    expected = sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(documents(texts), benchmark).collect())
    assert expected == [(i, 0) for i in range(60)] + [(60, 3)]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
    found = decontaminate.leaks(documents(texts), benchmark)
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == expected
    assert decontaminate.leaks(documents(texts).limit(0), benchmark).collect() == []
    assert decontaminate.leaks(documents(texts), benchmark.limit(0)).collect() == []


def test_repeated_edited_copies_are_found_whatever_their_count(documents, spark, monkeypatch):
    items = [" ".join(f"i{k}w{j}" for j in range(40)) for k in range(2)]
    items += [items[0].replace("i0w5 ", "other ")]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    edited = [" ".join("new" if j % 4 == 3 else w for j, w in enumerate(t.split())) for t in items[:2]]
    phrase = " ".join(items[1].split()[:4])
    texts = [f"d{i} {edited[0]} e{i}" for i in range(30)] + [items[1]]
    texts += [f"d{i} {edited[1]} e{i}" for i in range(30)] + [f"{phrase} x{i}" for i in range(30)]
    expected = [(i, k) for i in range(30) for k in (0, 2)] + [(i, 1) for i in range(30, 61)]
    for pairs in (None, 7):
        if pairs:
            monkeypatch.setattr(decontaminate, "PAIRS", pairs)
        rows = decontaminate.leaks(documents(texts), benchmark).collect()
        assert sorted((r.doc_id, r.item_id) for r in rows) == expected
        assert {r.similarity for r in rows if r.item_id == 0} == {51 / 80}


# --- quality rules -------------------------------------------------------------------------


def counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        sum(text.count(s) for s in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def test_counts_against_brute_force(documents):
    rng = random.Random(7)
    texts = ["", None, " \n ", "a", "a b", "a b c", "a b c a b c", "a a a a", "x|y\n\nx|y\n x|y\n#", "é\x0bü\x0cz"]
    for _ in range(80):
        size = rng.choice([3, 20, 400])
        texts.append("".join(rng.choice(["a", "b", "cc", "#"]) + rng.choice([" ", "\n", "\t ", " "]) for _ in range(rng.randrange(size))))
    texts.append(" ".join(f"w{i}" for i in range(30_000)) + " w1 w2 w3")
    rows = quality_rules.judge(documents(texts)).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows}
    assert got == {i: counts(t) for i, t in enumerate(texts)}


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_outliers_go_and_clean_documents_stay(documents, monkeypatch):
    rng = random.Random(8)
    clean = [prose(rng, int(rng.lognormvariate(5.5, 0.8)) + 50) for _ in range(150)]
    junk = [" ".join(w + "***" for w in prose(rng, 200).split()) for _ in range(12)]
    junk += [prose(rng, 150).upper() for _ in range(12)]
    rows = quality_rules.judge(documents(clean + junk + [None])).collect()
    kept = {r.doc_id for r in rows if r.kept}
    assert kept == set(range(150))
    monkeypatch.setattr(quality_rules, "BROADCAST_GROUPS", 0)
    assert {r.doc_id for r in quality_rules.judge(documents(clean + junk)).collect() if r.kept} == kept


def test_estimate_is_a_fixed_point_of_concentration(documents, spark):
    """The estimate equals numpy's after the same steps, and one more step hardly moves it."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6)) @ rng.normal(size=(6, 6)) + 5
    x[:60] += 40
    rows = [("l", "s", *map(float, v)) for v in x]
    schema = "group_lang string, group_source string, " + ", ".join(f"{n} double" for n in quality_rules.NAMES)
    found = quality_rules.estimates(spark.createDataFrame(rows, schema)).first()
    mean = np.array([found[f"m_{i}"] for i in range(6)])
    whitener = np.zeros((6, 6))
    for k in range(6):
        for j in range(k + 1):
            whitener[k, j] = found[f"w_{k}_{j}"]
    d2 = (((x - mean) @ whitener.T) ** 2).sum(axis=1)
    near = d2 <= np.sort(d2)[int(np.ceil(0.75 * len(x))) - 1]
    assert not near[:60].any()
    assert np.allclose(x[near].mean(axis=0), mean, atol=0.2)
    floors = np.diag([f**2 for f in quality_rules.FLOORS.values()])
    own = quality_rules.CONSISTENCY * np.cov(x[near].T, bias=True) + floors
    assert np.allclose(whitener @ own @ whitener.T, np.eye(6), atol=0.15)
    assert (d2[:60] > quality_rules.CUTOFF).all() and (d2[60:] <= quality_rules.CUTOFF).mean() > 0.98


def test_small_groups_nulls_and_empty_tables(documents, spark):
    few = documents(["word " * 3, None], [None, None], lang=None, source=None)
    rows = quality_rules.judge(few).collect()
    assert [(r.doc_id, r.distance, r.kept) for r in rows] == [(None, None, False)] * 2
    assert quality_rules.judge(few.limit(0)).collect() == []


# --- ordinal classifier ---------------------------------------------------------------------


def corpus(seed, n):
    rng = random.Random(seed)
    texts, labels = [], []
    for _ in range(n):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "the", "of"]) + rng.choice("abcdef") for _ in range(rng.randrange(30, 120))]
        kind = rng.choice([0, 1, 2, 2])
        if kind == 0:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["scum", "idiot", "moron"])
        text = " ".join(words)
        texts.append(text.upper().replace(" ", "!! ") if kind == 1 else text)
        labels.append((int(kind != 1), int(kind == 0)))
    return texts, labels


def test_held_out_accuracy(documents, spark):
    texts, labels = corpus(1, 600)
    rows = [(i, q, t) for i, (q, t) in enumerate(labels[:400])] + [(None, 1, 0), (3, None, 0), (9999, 1, 0)]
    table = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    model = ordinal_quality.train(documents(texts), table)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in ordinal_quality.grade(documents(texts), model).collect()}
    right = 0
    for i in range(400, 600):
        grade = 0 if labels[i][1] else 1 if not labels[i][0] else 2
        right += got[i].kept == (grade == 2)
        assert 0 <= got[i].p_good <= got[i].expected_grade / 1 <= 2
    assert right >= 190


def test_gradient_points_downhill():
    rng = np.random.default_rng(1)
    rows = 300
    bucket = np.concatenate([rng.choice(50, 5, replace=False) for _ in range(rows)])
    weights = rng.normal(size=50)
    bounds = np.arange(0, 5 * rows + 1, 5)
    score = ordinal_quality._sums(weights[bucket] * 1.0, bounds)
    grade = (score > -1).astype(int) + (score > 1)
    model = ordinal_quality.fit(bucket, np.ones(len(bucket)), bounds, grade)
    found = ordinal_quality._sums(model.weights[bucket], bounds)
    assert ((model.tails(found) > 0.5).sum(axis=1) == grade).mean() > 0.95


def test_the_sample_follows_the_hash_not_the_table(documents, spark, monkeypatch):
    texts, labels = corpus(4, 120)
    table = spark.createDataFrame([(i, q, t) for i, (q, t) in enumerate(labels)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(ordinal_quality, "ENTRIES", 4000)
    there = ordinal_quality.train(documents(texts).coalesce(1), table)
    back = ordinal_quality.train(documents(texts[::-1], range(119, -1, -1)).coalesce(1), table)
    assert (there.weights == back.weights).all() and (there.thresholds == back.thresholds).all()


def test_without_labels_and_texts(documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = ordinal_quality.train(documents(["a b"]), none)
    rows = ordinal_quality.grade(documents(["a b", "", None], [1, 1, None]), model).collect()
    assert len(rows) == 3 and all(r.kept for r in rows)
    assert ordinal_quality.grade(documents(["x"]).limit(0), model).collect() == []
