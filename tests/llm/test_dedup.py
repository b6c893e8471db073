"""Near duplicates and repeated byte strings against brute force."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from wordloom.llm import near_dedup, suffix_dedup
from wordloom.llm.components import components
from wordloom.llm.hashing import Poly, Words, chunks, text_bytes

FOLDER = "/root/testdata/sf0.001"


def sets_of(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def groups(texts):
    sets = [sets_of(t) for t in texts]
    top = list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in enumerate(sets)}


def family(rng, size, words, edits):
    """A text and copies with up to ``edits`` changed words, at graded similarity."""
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10_000)}"
        out.append(" ".join(copy))
    return out


def near(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()}


def test_graded_copies_against_brute_force(documents):
    rng = random.Random(3)
    texts = family(rng, 60, 150, 12) + family(rng, 40, 60, 4) + family(rng, 5, 400, 60)
    texts += ["", None, " \n\t", "a", "A", "a b", "b a", "one two three four five", "ONE two three four five"]
    texts += [texts[0]] * 5
    rng.shuffle(texts)
    assert near(documents(texts)) == groups(texts)


def test_later_rounds_of_centres(documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "CENTRES", 2)
    rng = random.Random(9)
    texts = family(rng, 70, 100, 14)
    assert near(documents(texts)) == groups(texts)


@pytest.mark.parametrize("rows_a_batch", ["3", "10000"])
def test_centres_meet_the_members_of_a_bucket_in_blocks(spark, documents, monkeypatch, rows_a_batch):
    """A line that stands in many unlike texts makes large buckets of as many components."""
    monkeypatch.setattr(near_dedup, "BLOCK_CENTRES", 3)
    monkeypatch.setattr(near_dedup, "BLOCK_PAIRS", 7)
    rng = random.Random(5)
    line = " ".join(f"c{i}" for i in range(30))
    texts = [line + " " + " ".join(f"w{rng.randrange(10_000)}" for _ in range(12)) for _ in range(40)]
    texts += [f"{t} {end}" for t in texts[5:25] for end in ("x", "y z")] + family(rng, 12, 60, 9)
    rng.shuffle(texts)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_a_batch)
    try:
        assert near(documents(texts)) == groups(texts)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("size", [1, 4, 1000])
def test_pairs_that_meet_are_those_of_all_pairs(size):
    rng = np.random.default_rng(4)
    count, lanes = near_dedup.BINS // near_dedup.LANES, near_dedup.LANES
    base = rng.integers(0, 4, (6, near_dedup.BANDS + count))
    rows = []
    for key, part, members in ((1, 0, 30), (1, 1, 30), (2, 0, 1), (3, 0, 9)):
        for i in range(members):
            own = np.where(rng.random(base.shape[1]) < 0.1, rng.integers(0, 4, base.shape[1]), base[i % 6])
            packs, codes = own[: near_dedup.BANDS], own[near_dedup.BANDS :]
            codes = codes * sum(1 << 8 * j for j in range(lanes))
            rank = i if i < 12 else None
            chosen = rank is not None
            rows.append((key, part, chosen and rank // 6 == part, chosen, int(rng.integers(0, 3)), i, i % 20, 300 + i, packs, codes))
    rows.sort(key=lambda r: (r[0], r[1], not r[2]))

    def lane_bytes(codes):
        return codes.astype(np.int64).view(np.uint8)[None, :]

    expected = set()
    for x in rows:
        for y in rows:
            if x[:2] == y[:2] and x[2] and x[6] != y[6] and not (y[3] and y[5] < x[5]):
                same = np.flatnonzero(x[8] == y[8])
                if 100 * min(x[7], y[7]) >= 75 * max(x[7], y[7]) and len(same) and same[0] == y[4]:
                    sizes = (np.array([z[7]]) for z in (x, y))
                    if near_dedup._plausible(lane_bytes(x[9]), lane_bytes(y[9]), *sizes, 75)[0]:
                        expected.add((min(x[5], y[5]), max(x[5], y[5])))

    names = ("key", "part", "centre", "chosen", "band", "rep", "comp", "n", "packs", "codes")
    batches = [
        pa.RecordBatch.from_arrays([pa.array([v.tolist() if isinstance(v, np.ndarray) else v for v in c]) for c in zip(*rows[i : i + size])], names=names)
        for i in range(0, len(rows), size)
    ]
    found = [p for b in near_dedup._meet(75)(iter(batches)) for p in zip(*(c.to_pylist() for c in b.columns))]
    assert set(found) == expected and len(expected) > 10


def test_ids(documents, spark):
    same = " ".join(f"w{i}" for i in range(30))
    other = " ".join(f"v{i}" for i in range(30))
    rows = near_dedup.near_duplicates(documents([same, other, other, same, "z"], [1, 2, 1, None, 5])).collect()
    got = sorted((str(r.doc_id), r.component_id, r.kept) for r in rows)
    # both rows of 1 are one document, so 2 is linked with it
    assert got == [("1", 1, True), ("1", 1, True), ("2", 1, False), ("5", 5, True), ("None", None, True)]
    assert near_dedup.near_duplicates(documents(["x"]).limit(0)).collect() == []


def test_estimate_follows_the_similarity():
    rng = np.random.default_rng(1)
    count = near_dedup.BANDS * near_dedup.ROWS
    factor = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for share in (0.2, 0.5, 0.75, 0.95):
        errors = []
        for _ in range(20):
            n = 400
            both = int(2 * n * share / (1 + share))
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
            b = np.append(a[:both], rng.integers(0, 1 << 63, n - both, dtype=np.uint64))
            x, y = (near_dedup.registers((s[None, :] * factor[:, None]).min(axis=1)).astype(int) for s in (a, b))
            args = [np.array([v]) for v in ((x > y).sum(), (x < y).sum(), (x == y).sum(), n, n)]
            errors.append(near_dedup.estimate(*args)[0] - share)
        assert abs(np.mean(errors)) < 0.05


def test_registers_merge():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 1 << 63, (8, 50), dtype=np.uint64) for _ in range(2))
    union = near_dedup.registers(np.minimum(a.min(axis=1), b.min(axis=1)))
    assert (union == np.maximum(near_dedup.registers(a.min(axis=1)), near_dedup.registers(b.min(axis=1)))).all()


@pytest.mark.parametrize("few", [0, 1000])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr("wordloom.llm.components.FEW_EDGES", few)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (105, 101), (7, 7)]
    df = components(spark.createDataFrame(edges, "a long, b long"))
    got = {r.node: r.comp for r in df.collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 105: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_split_as_the_pattern_does():
    import pyarrow as pa

    texts = ["", "a", " a\tbc\n", None, "É é\x0bx\x00y", "no", "next", "\x0c", "tail "]
    data, offsets = text_bytes(pa.array(texts))
    hashed, start, end, bounds = Words().hash_words(data, offsets)
    got = [data[a:z].tobytes().decode() for a, z in zip(start, end, strict=True)]
    expected = [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]
    assert got == sum(expected, [])
    assert list(np.diff(bounds)) == [len(e) for e in expected]
    assert [c for c in chunks(offsets, 3)][-1][1] == len(texts)


# --- repeated byte strings -----------------------------------------------------------------


def removed(texts, length=100):
    seen, out = set(), {}
    for i, text in enumerate(texts):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in seen:
                gone[k : k + length] = b"\1" * length
            else:
                seen.add(window)
        runs = [(m.start(), m.end()) for m in re.finditer(b"\1+", gone)]
        kept = bytes(x for x, y in zip(data, gone, strict=True) if not y)
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def cut(df, **options):
    rows = suffix_dedup.remove_repeats(df, **options).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, [(s.start, s.end) for s in r.spans], r.kept_sha256) for r in rows}


def repeats(seed):
    rng = random.Random(seed)

    def some(n):
        return "".join(rng.choice("ab é") for _ in range(n))

    passages = [some(rng.randrange(90, 400)) for _ in range(4)]
    texts = ["", None, "a" * 99, "a" * 100, "a" * 350, "ab" * 300, some(5000)]
    for _ in range(60):
        texts.append(some(rng.randrange(120)) + rng.choice(passages) + some(rng.randrange(80)) + rng.choice(passages)[:150])
    return texts + [texts[-1], texts[10], passages[0] * 3]


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_against_brute_force(documents, seed):
    texts = repeats(seed)
    assert cut(documents(texts)) == removed(texts)


def test_small_chunks_change_no_result(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 700)
    monkeypatch.setattr(suffix_dedup, "GATHER", 50)
    monkeypatch.setattr(suffix_dedup, "SORT_ROWS", 64)
    texts = repeats(4)
    assert cut(documents(texts)) == removed(texts)
    assert cut(documents(texts), length=60, seed=20) == removed(texts, 60)


@pytest.mark.parametrize("rows", [1, 40, 1 << 18])
def test_a_hot_group_of_borders(documents, monkeypatch, rows):
    """A passage of all documents with neighbours that differ, repeat or shift: held by distinct windows."""
    monkeypatch.setattr(suffix_dedup, "SORT_ROWS", rows)
    rng = random.Random(12)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(170))
    tails = ["".join(rng.choice("xyz ") for _ in range(60)) for _ in range(6)]
    texts = []
    for i in range(90):
        head = "".join(rng.choice("uvw ") for _ in range(rng.randrange(80)))
        texts.append(head + passage[rng.randrange(3) :] + rng.choice(tails)[rng.randrange(2) :] + str(i % 7))
    assert cut(documents(texts)) == removed(texts)


def test_remaining_bytes_and_ids(documents):
    passage = "x1 " * 60
    texts = ["head " + passage, passage + "tail", passage]
    rows = suffix_dedup.remove_repeats(documents(texts, [1, 2, None]), with_text=True).collect()
    got = {r.doc_id: r.kept_bytes.decode() for r in rows}
    assert got[None] == passage and got[2] == "tail"
    assert suffix_dedup.remove_repeats(documents(["x"]).limit(0)).collect() == []


def test_merge_sort_and_extension():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    poly, length = Poly(1), 20
    start = rng.integers(0, 2900, 600)
    segment = np.sort(rng.integers(0, 7, 600))
    order = suffix_dedup.merge_sort(data, poly, start, segment, length)
    key = lambda i: (segment[i], data[start[i] : start[i] + length].tobytes(), i)
    assert list(order) == sorted(range(600), key=key)
    a, b = start[:300], start[300:]
    got = suffix_dedup.common_extension(poly.prefix(data), poly, a, b, length)
    for x, y, n in zip(a, b, got, strict=True):
        same = data[x : x + length] == data[y : y + length]
        assert n == (length if same.all() else int(np.argmin(same)))


def test_query_on_a_given_table(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    expected = removed([r.text for r in rows])
    got = {r.doc_id: r for r in suffix_dedup.query(spark, FOLDER).collect()}
    for r, e in zip(rows, expected.values(), strict=True):
        own = got[r.doc_id]
        assert (own.n_bytes, own.n_removed, own.n_spans, own.kept_sha256) == (e[0], e[1], len(e[2]), e[3])
