"""Alignment of two tokenizers over a corpus, with an identity map as fast path (operator 12).

A is a byte-level pair-merge tokenizer, B a SentencePiece model. Where a token of A and one of B end at
the same byte, a group ends. Tokens of one group whose bytes overlap are linked, and an id pair's count
is its number of links in the corpus.

Most groups are one token against one of the same bytes. Before anything else, an array is made that
gives for each id of A the id of B with these bytes, so that such groups are counted in a vector as long
as A's vocabulary, one for each task. Only the pairs of all other groups are shuffled, summed over a
block of documents first. A block keeps its texts as numbers of units, a unit being spaces with the
characters up to the next one, at which neither tokenizer joins anything: units are encoded and aligned
once, and the documents' scores are sums over their units. Units are told apart by two independent hashes.

Three sets come back: the vector's counts (as many as A has ids), the highest count of each id of B, and
the counts of the pairs of each block, joined by block.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.hashing import U64, give_back, span_hashes, text_bytes
from wordloom.llm.sentencepiece_codec import BYTE, MARK, Model
from wordloom.llm.shared import fresh_path, settled

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: The largest tokenizer file that is sent to the executors.
FILE_BYTES = 64 << 20
#: Characters of text whose documents form a block.
BLOCK = 1 << 20
#: Aligned units that a task remembers: how many, and bytes of their groups as text.
UNITS, UNIT_BYTES = 250_000, 16 << 20
#: Units, and bytes of units, that are encoded in one call, and bytes of a line of units.
CALL, CALL_BYTES = 16_384, 1 << 20
LINE_BYTES = 2_000

BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups array<string>, unit_n binary, units binary, same_n binary, same binary, pair_n binary, pairs binary, "
    "pair array<long>, n array<long>"
)


def _packed(values: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes each as the largest takes, behind a byte that says how many."""
    top = int(values.max(initial=0))
    size = next(n for n in (1, 2, 4, 8) if top < 1 << 8 * n)
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _byte_chars() -> dict[str, int]:
    """The published byte-level alphabet: printable bytes stand for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _gather(values: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[begin : begin + length]``."""
    length = length.astype(np.int64)
    ends = np.cumsum(length)
    if not len(ends) or not ends[-1]:
        return values[:0].copy()
    return values[np.repeat(begin - (ends - length), length) + np.arange(ends[-1])]


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def _spans(counts: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(counts, dtype=np.int64))


def _closed(data: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Whether a byte (of all, or of those ``at``) ends a character that is surely no white space.

    White space beyond ASCII is U+0085, U+00A0, U+1680, U+2000 to U+205F and U+3000; characters of the last
    range that are none are counted with them.
    """
    at = np.arange(len(data)) if at is None else at
    last = data[at]
    out = (last > 0x20) & (last != 0x7F)
    wide = np.flatnonzero(last >= 0x80)
    one, two = data[np.maximum(at[wide] - 1, 0)], data[np.maximum(at[wide] - 2, 0)]
    blank = (one == 0xC2) & ((last[wide] == 0x85) | (last[wide] == 0xA0))
    blank |= (two == 0xE1) & (one == 0x9A) | (two == 0xE3) & (one == 0x80) | (two == 0xE2) & ((one == 0x80) | (one == 0x81))
    out[wide[blank]] = False
    return out


def _more(values: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Both in one array, of the type of ``values``."""
    return np.append(values, new.astype(values.dtype))


class Spelled:
    """Bytes of each id of a vocabulary."""

    def __init__(self, spelled: list[bytes]):
        self.length = np.array([len(x) for x in spelled], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(spelled) + b"\0", np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return _gather(self.bytes, self.begin[ids], self.length[ids])


class Aligner:
    """Both tokenizers, their identity map, and the units aligned so far, inside a task."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        chars = _byte_chars()
        vocabulary = self.a.get_vocab()
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            spelled[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
        model = Model.parse(b_file)
        pieces = [
            bytes([int(text[3:5], 16)]) if kind == BYTE else text.replace(MARK, " ").encode()
            for text, _, kind in model.pieces
        ]
        self.a_spelled, self.b_spelled = Spelled(spelled), Spelled(pieces)
        longest = max(len(spelled), len(pieces))
        self.digits = Spelled([b"%d " % i for i in range(longest)])  # with room for a sign
        # of pieces with the same bytes the plain one counts; a byte piece of them is an irregular pair
        ids = {p: i for i, p in enumerate(pieces) if model.pieces[i][2] == BYTE}
        ids |= {p: i for i, p in enumerate(pieces) if model.pieces[i][2] != BYTE}
        self.same = np.array([ids.get(x, -1) for x in spelled], np.int64)
        rules = json.loads(a_file)
        steps = rules.get("pre_tokenizer") or {}
        byte_level = steps.get("type") == "ByteLevel" and steps.get("use_regex", True)
        byte_level = byte_level and not steps.get("add_prefix_space") and not rules.get("normalizer")
        self.by_unit = byte_level and model.splits_at_spaces()
        self.space = [i for i, (text, _, _) in enumerate(model.pieces) if text == MARK][:1]
        self.seed = 12
        self.forget()

    def forget(self) -> None:
        self.key, self.number = np.zeros(0, U64), np.zeros(0, np.int64)  # sorted by the first hash
        self.check = np.zeros(0, U64)  # from here on a row for each unit, in order of its number
        self.good = np.zeros(0, bool)
        self.counts = np.zeros((0, 3), np.int32)  # tokens of A and of B, groups
        self.text_n, self.text = np.zeros(0, np.int32), np.zeros(0, np.uint8)
        self.same_n, self.same_ids = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.pair_n, self.pair_ids = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def split(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts with a space before each, and where their units start: (bytes, offsets, starts).

        A unit starts at a space behind a character that is no white space, where neither tokenizer joins
        anything; each of the two sees white space before it decides.
        """
        size = np.diff(offsets)
        some = offsets[:-1][size > 0]
        data = np.insert(data, some, 32)
        offsets = _spans(size + (size > 0))
        first = np.zeros(len(data), bool)
        if self.by_unit:
            first[1:] = (data[1:] == 32) & _closed(data)[:-1]
        first[offsets[:-1][size > 0]] = True
        return data, offsets, np.flatnonzero(first)

    def numbered(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each unit; new ones are encoded and aligned."""
        for seed in range(0, 64, 2):  # another pair of hashes if two units share one
            key, check = (span_hashes(data, start, end, self.seed + seed + i) for i in (0, 1))
            unique, index, inverse = np.unique(key, return_index=True, return_inverse=True)
            place = np.searchsorted(self.key, unique)
            known = place < len(self.key)
            known[known] = self.key[place[known]] == unique[known]
            number = np.zeros(len(unique), np.int64)
            number[known] = self.number[place[known]]
            if np.array_equal(check[index][inverse], check) and np.array_equal(
                self.check[number[known]], check[index][known]
            ):
                break
            self.forget()
        else:
            raise ValueError("no hash tells the units apart")
        self.seed += seed
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            units = [raw[start[i] : end[i]] for i in index[new].tolist()]
            mark = MARK.encode()
            ends = end[index[new]] - 1
            lined = _closed(data, ends) & self.by_unit
            if mark in raw:
                lined &= np.array([mark not in u for u in units], bool)
            number[new[lined]] = len(self.check) + np.arange(lined.sum())
            number[new[~lined]] = len(self.check) + lined.sum() + np.arange((~lined).sum())
            order = np.concatenate([new[lined], new[~lined]])
            self._learn([u for u, x in zip(units, lined.tolist(), strict=True) if x], True)
            self._learn([u for u, x in zip(units, lined.tolist(), strict=True) if not x], False)
            self.check = np.append(self.check, check[index][order])
            at = np.searchsorted(self.key, unique[new])
            self.key, self.number = np.insert(self.key, at, unique[new]), np.insert(self.number, at, number[new])
        return number[inverse]

    def _learn(self, units: list[bytes], together: bool) -> None:
        at = 0
        while at < len(units):
            end, size = at, 0
            while end < len(units) and end - at < CALL and (end == at or size < CALL_BYTES):
                size += len(units[end])
                end += 1
            self._align(units[at:end], together)
            at = end

    def _together(self, raw: np.ndarray, size: np.ndarray):
        """Ids of A and of B with their numbers per unit, units encoded as lines of text; None if bytes differ."""
        ends, found = np.cumsum(size), []
        cuts = ends[np.append(np.diff(ends // LINE_BYTES) > 0, True)].tolist()
        whole = raw.tobytes()
        strings = [whole[a:z].decode() for a, z in zip([0, *cuts[:-1]], cuts, strict=True)]
        fast = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        for spelled, lists in (
            (self.a_spelled, [e.ids for e in fast(strings, add_special_tokens=False)]),
            (self.b_spelled, self.b.encode([x[1:] for x in strings], num_threads=1)),
        ):
            ids = _flat(lists)
            if not np.array_equal(spelled.joined(ids), raw):
                return None
            token_ends = np.cumsum(spelled.length[ids])
            last = np.searchsorted(token_ends, ends)
            if not np.array_equal(token_ends[last], ends):
                return None
            found += [ids, np.diff(last, prepend=-1)]
        return *found, np.ones(len(size), bool)

    def _apart(self, units: list[bytes], raw: np.ndarray, size: np.ndarray):
        """The same unit by unit, and which units both tokenizers spell exactly; the others have no ids."""
        fast = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        texts = [u.decode() for u in units]
        a_lists = [e.ids for e in fast(texts, add_special_tokens=False)]
        # B adds no space to an empty text, which is what is left of a single space
        b_lists = [x or self.space for x in self.b.encode([t[1:] for t in texts], num_threads=1)]
        good, at = np.zeros(len(units), bool), _spans(size).tolist()
        for i, (x, y) in enumerate(zip(a_lists, b_lists, strict=True)):
            whole = raw[at[i] : at[i + 1]]
            good[i] = np.array_equal(self.a_spelled.joined(np.array(x, np.int64)), whole) and np.array_equal(
                self.b_spelled.joined(np.array(y, np.int64)), whole
            )
            if not good[i]:
                a_lists[i], b_lists[i] = [], []
        sizes = [np.array([len(x) for x in lists], np.int64) for lists in (a_lists, b_lists)]
        return _flat(a_lists), sizes[0], _flat(b_lists), sizes[1], good

    def _align(self, units: list[bytes], together: bool) -> None:
        size = np.array([len(u) for u in units], np.int64)
        raw = np.frombuffer(b"".join(units), np.uint8)
        encoded = self._together(raw, size) if together else None
        a, a_n, b, b_n, good = encoded or self._apart(units, raw, size)

        a_end, b_end = np.cumsum(self.a_spelled.length[a]), np.cumsum(self.b_spelled.length[b])
        a_start = a_end - self.a_spelled.length[a]
        last = np.searchsorted(b_end, a_end, "left")
        a_closes = b_end[last] == a_end if len(b_end) else np.zeros(0, bool)
        b_closes = np.isin(b_end, a_end[a_closes])
        a_group, b_group = np.cumsum(a_closes) - a_closes, np.cumsum(b_closes) - b_closes
        n_groups = int(a_closes.sum())
        a_size, b_size = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)

        first = np.searchsorted(b_end, a_start, "right")
        n_links = last - first + 1
        left = np.repeat(np.arange(len(a)), n_links)
        right = np.repeat(first - _spans(n_links)[:-1], n_links) + np.arange(len(left))
        unit = np.repeat(np.arange(len(units)), a_n)
        group = a_group[left]
        plain = (a_size[group] == 1) & (b_size[group] == 1) & (self.same[a[left]] == b[right])
        odd = ~plain

        # both tokenizers' ids in digits, group by group, each with the sign that follows it
        a_place = np.arange(len(a)) + _spans(b_size)[a_group]
        b_place = np.arange(len(b)) + _spans(a_size)[b_group + 1]
        ids, sign = np.zeros(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.uint8)
        ids[a_place], sign[a_place] = a, np.where(a_closes, ord("|"), ord(","))
        ids[b_place], sign[b_place] = b, np.where(b_closes, ord(";"), ord(","))
        digits = self.digits.joined(ids)
        sign_at = np.cumsum(self.digits.length[ids]) - 1
        digits[sign_at] = sign
        per_unit = np.bincount(unit[a_closes], minlength=len(units))
        ends = np.append(0, sign_at + 1)[_spans(a_n + b_n)]
        self.text_n, self.text = _more(self.text_n, np.diff(ends)), np.append(self.text, digits)
        self.good = np.append(self.good, good)
        self.counts = np.concatenate([self.counts, np.stack([a_n, b_n, per_unit], 1).astype(np.int32)])
        self.same_n = _more(self.same_n, np.bincount(unit[left[plain]], minlength=len(units)))
        self.same_ids = _more(self.same_ids, a[left[plain]])
        self.pair_n = _more(self.pair_n, np.bincount(unit[left[odd]], minlength=len(units)))
        self.pair_ids = _more(self.pair_ids, (a[left[odd]] << 32) | b[right[odd]])

    def block(self, number: int, doc_ids: list, texts: list[str], vector: np.ndarray) -> dict:
        """One row for some documents; their one-to-one groups are added to ``vector``."""
        if len(self.key) > UNITS or len(self.text) > UNIT_BYTES:
            self.forget()
            give_back()
        data, offsets, start = self.split(*text_bytes(pa.array(texts, pa.string())))
        found = self.numbered(data, start, np.append(start[1:], len(data)))
        bounds = np.searchsorted(start, offsets)
        bad = _spans(~self.good[found])
        clean = bad[bounds[1:]] == bad[bounds[:-1]]  # texts that both tokenizers spell exactly
        found = found[np.repeat(clean, np.diff(bounds))]
        bounds = _spans(np.diff(bounds) * clean)

        written = _gather(self.text, _spans(self.text_n)[found], self.text_n[found]).tobytes()
        ends = _spans(self.text_n[found])[bounds].tolist()
        hashes = [hashlib.sha256(written[a : z - 1]).hexdigest() if z > a else "" for a, z in zip(ends, ends[1:])]
        units, inside, times = np.unique(found, return_inverse=True, return_counts=True)
        sums = np.zeros((len(inside) + 1, 3), np.int64)
        np.cumsum(self.counts[units][inside], axis=0, out=sums[1:])
        n_a, n_b, n_groups = (sums[bounds[1:]] - sums[bounds[:-1]]).T

        def of_units(n: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return n[units], _gather(ids, _spans(n)[units], n[units])

        same_n, same = of_units(self.same_n, self.same_ids)
        np.add.at(vector, same, np.repeat(times, same_n))
        pair_n, pairs = of_units(self.pair_n, self.pair_ids)
        pair, place = np.unique(pairs, return_inverse=True)
        weight = np.bincount(place, np.repeat(times, pair_n), len(pair)) if len(pair) else np.zeros(0)
        return {
            "block": number,
            "doc_id": doc_ids,
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": n_groups,
            "n_links": n_a + n_b - n_groups,  # a chain of m and n tokens has m + n - 1 links
            "groups": hashes,
            "unit_n": _packed(np.diff(bounds)),
            "units": _packed(inside),
            "same_n": _packed(same_n),
            "same": _packed(same),
            "pair_n": _packed(pair_n),
            "pairs": _packed(place),
            "pair": pair,
            "n": weight.astype(np.int64),
        }


def _schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = []
    for item in BLOCKS.split(", "):
        name, kind = item.split(" ")
        inner = re.fullmatch(r"array<(\w+)>", kind)
        fields.append((name, pa.list_(kinds[inner[1]]) if inner else kinds[kind]))
    return pa.schema(fields)


def _aligner(a_file, b_file):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema()

        def cell(value, kind: pa.DataType) -> pa.Array:
            if value is None or not pa.types.is_list(kind):
                return pa.array([value], kind)
            return pa.ListArray.from_arrays([0, len(value)], pa.array(value, kind.value_type))

        def row(values: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([cell(values.get(f.name), f.type) for f in schema], schema=schema)

        aligner, vector = None, None
        number = TaskContext.get().partitionId() << 32
        doc_ids, texts, chars = [], [], 0
        for batch in batches:
            if aligner is None:
                aligner = Aligner(a_file.value, b_file.value)
                vector = np.zeros(len(aligner.same), np.int64)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py() or ""
                doc_ids.append(doc_id)
                texts.append(text)
                chars += len(text) + 16
                if chars >= BLOCK:
                    yield row(aligner.block(number, doc_ids, texts, vector))
                    number += 1
                    doc_ids, texts, chars = [], [], 0
        if texts:
            yield row(aligner.block(number, doc_ids, texts, vector))
        if aligner is not None:  # the task's vector: one row without a block
            some = np.flatnonzero(vector)
            yield row({"block": None, "pair": (some << 32) | aligner.same[some], "n": vector[some]})
        del aligner, doc_ids, texts
        give_back()

    return run


def _scorer(plain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same_count, same_best = plain.value
        for batch in batches:
            for i in range(batch.num_rows):

                def values(name: str) -> np.ndarray:
                    return _unpacked(batch.column(name)[i].as_py())

                def sums(counts: np.ndarray, items: np.ndarray) -> np.ndarray:
                    total, at = _spans(items), _spans(counts)
                    return total[at[1:]] - total[at[:-1]]

                unit_n, units = values("unit_n"), values("units")
                same_n, same = values("same_n"), values("same")
                pair_n, pairs = values("pair_n"), values("pairs")
                scores = batch.column("scores")[i]
                found = scores.values if scores.is_valid else None
                count = found.field("count").to_numpy() if found is not None else np.zeros(0, np.int64)
                best = found.field("best").to_numpy(zero_copy_only=False).astype(np.int64) if found is not None else count

                def per_document(of_same: np.ndarray, of_pair: np.ndarray) -> np.ndarray:
                    of_unit = sums(same_n, of_same[same]) + sums(pair_n, of_pair[pairs])
                    return sums(unit_n, of_unit[units])

                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(batch.column(c)[i].values)
                        for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")
                    ]
                    + [
                        pa.array(per_document(same_best, best), pa.int64()),
                        pa.array(per_document(same_count, count), pa.int64()),
                        pa.array(batch.column("groups")[i].values),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

    return run


def _shipped(spark, path: str):
    with open(path, "rb") as file:
        data = file.read(FILE_BYTES + 1)
    if len(data) > FILE_BYTES:
        raise ValueError(f"{path} has over {FILE_BYTES} bytes")
    return data, spark.sparkContext.broadcast(data)


def _settled(df: DataFrame, name: str) -> DataFrame:
    """A written table whose rows are megabytes each: few of them form a row group, which is read at once."""
    path = fresh_path(df.sparkSession, name)
    wide = {"parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 1}
    df.write.options(compression="zstd", **wide).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def aligned_blocks(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """Blocks of documents with their units and pairs, and for each task a row of one-to-one counts."""
    spark = docs.sparkSession
    (_, a_file), (_, b_file) = _shipped(spark, a_path), _shipped(spark, b_path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _settled(rows.mapInArrow(_aligner(a_file, b_file), BLOCKS), "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): links of each id pair, and whether its B id has no pair of more links.

    ``pair`` is ``a << 32 | b``. Each block sends a pair once; the tasks' vectors are summed before they join.
    """
    some = blocks.select("block", F.explode(F.arrays_zip("pair", "n")).alias("p")).select("block", "p.*")
    plain = some.where("block is null").groupBy("pair").agg(F.sum("n").alias("n"))
    both = some.where("block is not null").select("pair", "n").unionByName(plain)
    counts = both.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = counts.withColumn("b", F.expr("cast(pair & 4294967295 as int)"))
    top = counts.groupBy("b").agg(F.max("count").alias("top"))  # a row for each id of B at most
    return counts.join(F.broadcast(top), "b").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def align(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row of ``docs``.

    A encodes a space and the text, B the text; both paths are files of the driver, sent as bytes.
    ``n_best`` counts links whose pair has the highest count of its B id in ``docs``, all of equal ones;
    ``count_sum`` adds the counts of all links; ``groups_sha256`` hashes ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and texts that one of the tokenizers does not spell exactly (with the space
    marker in them, for instance), have no tokens: zeros and ''. Their links count nowhere. Strings of
    special tokens are plain text. Repeated rows count each; null ids stay null; further columns are
    ignored; an empty table gives no rows. A very long text is a block of its own.
    """
    blocks = aligned_blocks(docs, a_path, b_path)
    return scored_documents(blocks, a_path)


def scored_documents(blocks: DataFrame, a_path: str = A_PATH) -> DataFrame:
    """The rows of ``align`` from its blocks."""
    spark = blocks.sparkSession
    counts = settled(pair_counts(blocks), "pairs")
    vectors = blocks.where("block is null").select(F.explode("pair").alias("pair")).distinct()
    # as many rows as A has ids, at most
    plain = counts.join(vectors, "pair", "left_semi").collect()
    with open(a_path, "rb") as file:
        rules = json.load(file)
    ids = [*rules["model"]["vocab"].values(), *(t["id"] for t in rules.get("added_tokens", []))]
    same_count, same_best = np.zeros(max(ids) + 1, np.int64), np.zeros(max(ids) + 1, np.int64)
    for r in plain:
        same_count[r["pair"] >> 32], same_best[r["pair"] >> 32] = r["count"], r["best"]
    shipped = spark.sparkContext.broadcast((same_count, same_best))

    own = blocks.where("block is not null")
    pairs = own.select("block", F.posexplode("pair").alias("k", "pair"))
    scores = (
        pairs.join(counts, "pair")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("k", "count", "best"))).alias("scores"))
    )
    rows = own.select(
        "block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "unit_n", "units", "same_n", "same", "pair_n", "pairs"
    ).join(scores, "block", "left")
    return rows.mapInArrow(
        _scorer(shipped),
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    )


def query(spark, sf_dir: str) -> DataFrame:
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))
