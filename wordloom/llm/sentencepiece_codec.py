"""SentencePiece encoding and decoding with the tokenizers library as backend (operator 2).

The model file is parsed from its protobuf wire format. Its normaliser (the compiled character map,
removal of extra spaces, dummy prefix), the space marker, the scores and the byte pieces are rebuilt
as a ``tokenizers`` object: a unigram model from its scores, or a pair-merge model whose merge order
follows the scores of the merged pieces. Its ids are the result; every encoding is compared with the
sentencepiece library, and every document is decoded again.

Where no piece has the space marker behind another character, as is usual, a text is a sequence of
independent units, each a run of spaces with the characters up to the next space. Then each
distinct unit of a chunk is encoded once, with others in lines of text that go to both libraries in
multithreaded batches, and the ids are gathered. Units are told apart by two independent hashes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.hashing import U64, chunks, give_back, span_hashes, text_bytes

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: The largest model file that is sent to the executors.
MODEL_BYTES = 64 << 20
#: Bytes of text whose distinct units are encoded together.
CHUNK = 1 << 21
#: Encoded units that a task remembers.
REMEMBER = 1 << 17
#: Bytes of units that are encoded in one call, and bytes of a line of units.
CALL, LINE = 1 << 17, 2_000
THREADS = 2

#: Fixed values of the model format: the space marker and the kinds of pieces.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message; fixed-width values stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + size]
            at += size
        elif kind == 2:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size
        else:
            raise ValueError(f"wire type {kind} in a model file")


@dataclass
class Model:
    """What of a model file decides encoding. Field numbers are those of the published format."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    unigram: bool = True
    byte_fallback: bool = False
    suffix: bool = False
    charsmap: bytes = b""
    prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> Model:
        model = cls()
        for number, value in _fields(data):
            if number == 1:
                text, score, kind = "", 0.0, NORMAL
                for n, x in _fields(value):
                    if n == 1:
                        text = x.decode()
                    elif n == 2:
                        score = float(np.frombuffer(x, "<f4")[0])
                    elif n == 3:
                        kind = x
                model.pieces.append((text, score, kind))
            elif number == 2:
                trainer = dict(_fields(value))
                model.unigram = trainer.get(3, 1) == 1
                if trainer.get(3, 1) not in (1, 2):
                    raise ValueError("only unigram and BPE models can be rebuilt")
                model.suffix = bool(trainer.get(24, 0))
                model.byte_fallback = bool(trainer.get(35, 0))
            elif number == 3:
                rules = dict(_fields(value))
                model.charsmap = rules.get(2, b"")
                model.prefix = bool(rules.get(3, 1))
                model.squeeze = bool(rules.get(4, 1))
                model.escape = bool(rules.get(5, 1))
        if not model.pieces:
            raise ValueError("a model file without pieces")
        return model

    def splits_at_spaces(self) -> bool:
        """Whether a text may be encoded unit by unit."""
        plain = not self.charsmap and not self.squeeze and self.prefix and self.escape
        crossing = any(
            MARK in text.lstrip(MARK) for text, _, kind in self.pieces if kind in (NORMAL, USER)
        )
        user = any(kind == USER for *_, kind in self.pieces)
        return plain and not self.suffix and not crossing and not user

    def merges(self) -> list[tuple[str, str]]:
        """Pairs in the order in which the scores ask for them; of equal scores, the longer left."""
        score = {text: s for text, s, kind in self.pieces if kind in (NORMAL, USER)}
        found = []
        for text, s in score.items():
            for i in range(1, len(text)):
                left, right = text[:i], text[i:]
                if left in score and right in score:
                    found.append((-s, -len(left), left, right))
        found.sort(key=lambda x: x[:2])
        return [(left, right) for _, _, left, right in found]

    def tokenizer(self):
        from tokenizers import AddedToken, Tokenizer, models, normalizers

        unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        if self.unigram:
            lowest = min(s for _, s, _ in self.pieces)
            # only normal pieces may match text
            vocab = [
                (text if kind in (NORMAL, USER, BYTE, UNKNOWN) else f"\0{i}", s if kind in (NORMAL, USER) else lowest - 10)
                for i, (text, s, kind) in enumerate(self.pieces)
            ]
            built = Tokenizer(models.Unigram(vocab, unknown, self.byte_fallback))
        else:
            vocab = {text: i for i, (text, _, _) in enumerate(self.pieces)}
            built = Tokenizer(
                models.BPE(
                    vocab=vocab,
                    merges=self.merges(),
                    unk_token=self.pieces[unknown][0],
                    fuse_unk=True,
                    byte_fallback=self.byte_fallback,
                )
            )
        steps = []
        if self.charsmap:
            steps.append(normalizers.Precompiled(self.charsmap))
        if self.squeeze:
            from tokenizers import Regex

            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.prefix:
            steps.append(normalizers.Prepend(" "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        built.normalizer = normalizers.Sequence(steps)
        user = [AddedToken(t, normalized=False) for t, _, kind in self.pieces if kind == USER]
        if user:
            built.add_tokens(user)
        built.encode_special_tokens = True
        return built


class Codec:
    """Encoder, decoder and parity check of one model, inside a task."""

    def __init__(self, data: bytes, threads: int = THREADS):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece

        self.model = Model.parse(data)
        self.backend = self.model.tokenizer()
        self.exact = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.threads = threads
        self.by_unit = self.model.splits_at_spaces()
        self.mark_id = {t: i for i, (t, _, _) in enumerate(self.model.pieces)}.get(MARK)
        self.by_unit &= self.mark_id is not None
        spelled = []
        for text, _, kind in self.model.pieces:
            if kind == BYTE:
                spelled.append(bytes([int(text[3:5], 16)]))
            elif kind == CONTROL:
                spelled.append(b"")
            elif kind == UNKNOWN:
                spelled.append(" ⁇ ".encode())  # as the published decoder spells it
            else:
                spelled.append(text.replace(MARK, " ").encode())
        self.length = np.array([len(x) for x in spelled], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(spelled) + b"\0", np.uint8)
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros((0, 2), U64)  # by the first hash; the second tells units of one hash apart
        self.ids = np.zeros(0, np.int32)
        self.at = np.zeros(1, np.int64)
        self.differs = np.zeros(0, bool)

    def encode_texts(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of each text by the backend, and where those of the sentencepiece library differ."""
        fast = getattr(self.backend, "encode_batch_fast", self.backend.encode_batch)
        mine = [e.ids for e in fast(texts, add_special_tokens=False)]
        theirs = self.exact.encode(texts, num_threads=self.threads)
        differs = np.array([a != b for a, b in zip(mine, theirs, strict=True)], bool)
        return [np.array(x, np.int32) for x in mine], differs

    def _in_lines(self, units: list[bytes]):
        """(flat ids, ids per unit) of units that hold more than spaces; None where a unit needs a look of its own."""
        raw, ends = b"".join(units), np.cumsum([len(u) for u in units])
        cuts = ends[np.append(np.diff(ends // LINE) > 0, True)].tolist()
        lines = [raw[a + 1 : z].decode("utf-8", "replace") for a, z in zip([0, *cuts[:-1]], cuts, strict=True)]
        fast = getattr(self.backend, "encode_batch_fast", self.backend.encode_batch)
        mine = _flat([e.ids for e in fast(lines, add_special_tokens=False)])
        theirs = _flat(self.exact.encode(lines, num_threads=self.threads))
        if not np.array_equal(mine, theirs):
            return None
        token_ends = np.cumsum(self.length[mine])
        if not len(token_ends) or token_ends[-1] != ends[-1]:
            return None
        last = np.searchsorted(token_ends, ends)
        if not np.array_equal(token_ends[last], ends):
            return None
        return mine, np.diff(last, prepend=-1)

    def _encode_units(self, units: list[bytes], together: bool):
        """(flat ids, ids per unit, differences) of units with their leading spaces."""
        flat, counts, differs, first = [np.zeros(0, np.int32)], [], [], 0
        while first < len(units):
            last, size = first, 0
            while last < len(units) and (last == first or size < CALL):
                size += len(units[last])
                last += 1
            part = units[first:last]
            found = self._in_lines(part) if together else None
            if found is None:
                ids, off = self.encode_texts([u[1:].decode("utf-8", "replace") for u in part])
                for i, unit in enumerate(part):
                    if len(unit) == 1:  # one space alone
                        ids[i] = np.array([self.mark_id], np.int32)
                found = np.concatenate([flat[0][:0], *ids]), np.array([len(x) for x in ids], np.int64)
            else:
                off = np.zeros(len(part), bool)
            flat.append(found[0])
            counts.append(found[1])
            differs.append(off)
            first = last
        none = [np.zeros(0, np.int64)]
        return np.concatenate(flat), np.concatenate(counts or none), np.concatenate(differs or [np.zeros(0, bool)])

    def _units(self, data: np.ndarray, offsets: np.ndarray):
        """Ids of a chunk by its distinct units: (flat ids, offsets per text, differences per text).

        None if two different units share a hash.
        """
        sizes = np.diff(offsets)
        full = np.flatnonzero(sizes)
        data = np.insert(data, offsets[:-1][full], 32)
        offsets = np.append(0, np.cumsum(sizes + (sizes > 0)))
        space = data == 32
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[offsets[:-1][full]] = True
        start = np.flatnonzero(first)
        end = np.append(start[1:], len(data))
        key, check = (span_hashes(data, start, end, seed) for seed in (21, 22))
        unique, index, inverse = np.unique(key, return_index=True, return_inverse=True)
        if not np.array_equal(check[index][inverse], check):
            return None
        if len(self.keys) > REMEMBER:
            self.forget()
        place = np.searchsorted(self.keys[:, 0], unique)
        known = place < len(self.keys)
        known[known] = self.keys[place[known], 0] == unique[known]
        if not np.array_equal(self.keys[place[known], 1], check[index][known]):
            return None
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            units = [raw[start[i] : end[i]] for i in index[new]]
            plain = np.array([not u.isspace() for u in units], bool)
            new = np.concatenate([new[plain], new[~plain]])
            parts = [
                self._encode_units([u for u, p in zip(units, plain.tolist(), strict=True) if p == some], some)
                for some in (True, False)
            ]
            ids, sizes, differs = (np.concatenate(x) for x in zip(*parts, strict=True))
            lengths = np.append(np.diff(self.at), sizes).astype(np.int64)
            keys = np.concatenate([self.keys, np.stack([unique[new], check[index][new]], 1)])
            flat = np.concatenate([self.ids, ids])
            begin = np.cumsum(lengths) - lengths
            order = np.argsort(keys[:, 0])
            self.ids = _gather(flat, begin[order], lengths[order])
            self.keys, self.at = keys[order], np.append(0, np.cumsum(lengths[order]))
            self.differs = np.append(self.differs, differs)[order]
            place = np.searchsorted(self.keys[:, 0], unique)
        place = place[inverse]
        count = self.at[place + 1] - self.at[place]
        flat = _gather(self.ids, self.at[place], count)
        bounds = np.searchsorted(start, offsets)
        total = np.append(0, np.cumsum(count))
        odd = np.append(0, np.cumsum(self.differs[place]))
        return flat, total[bounds], odd[bounds[1:]] - odd[bounds[:-1]]

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        mark = MARK.encode()
        raw = data.tobytes()
        if self.by_unit and mark not in raw:
            found = self._units(data, offsets)
            if found is not None:
                return found
        texts = [raw[a:z].decode("utf-8", "replace") for a, z in zip(offsets[:-1], offsets[1:], strict=True)]
        ids, differs = self.encode_texts(texts)
        flat = np.concatenate([np.zeros(0, np.int32), *ids])
        return flat, np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int64), differs.astype(np.int64)

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts behind lists of ids; one leading space goes, if added."""
        length = self.length[ids]
        data = _gather(self.bytes, self.begin[ids], length)
        offsets = np.append(0, np.cumsum(length))[at]
        if self.model.prefix and len(data):
            some = np.flatnonzero(np.diff(offsets) > 0)
            lead = offsets[some][data[offsets[some]] == 32]
            keep = np.ones(len(data), bool)
            keep[lead] = False
            before = np.append(0, np.cumsum(~keep))
            data, offsets = data[keep], offsets - before[offsets]
        return data, offsets


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int32, sum(map(len, lists)))


def _gather(values: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[begin : begin + length]``."""
    ends = np.cumsum(length)
    if not len(ends) or not ends[-1]:
        return values[:0]
    return values[np.repeat(begin - (ends - length), length) + np.arange(ends[-1])]


def _encoder(model, threads: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or Codec(model.value, threads)
            column = batch.column("text")
            data, offsets = text_bytes(column)
            for first, last in chunks(offsets, CHUNK):
                part = data[offsets[first] : offsets[last]]
                at = offsets[first : last + 1] - offsets[first]
                ids, bounds, differs = codec.encode(part, at)
                back, ends = codec.decode(ids, bounds)
                if len(back) == len(part) and np.array_equal(back, part) and np.array_equal(ends, at):
                    same = np.ones(last - first, bool)
                else:
                    same = np.array(
                        [
                            np.array_equal(back[ends[i] : ends[i + 1]], part[at[i] : at[i + 1]])
                            for i in range(last - first)
                        ]
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)),
                        pa.array(same),
                        pa.array(differs.astype(np.int64)),
                    ],
                    names=["doc_id", "ids", "round_trip", "n_differences"],
                )
        del codec
        give_back()

    return run


def _shipped(df: DataFrame, model_path: str):
    with open(model_path, "rb") as file:
        data = file.read(MODEL_BYTES + 1)
    if len(data) > MODEL_BYTES:
        raise ValueError(f"{model_path} has over {MODEL_BYTES} bytes")
    Model.parse(data)
    return df.sparkSession.sparkContext.broadcast(data)


def encode(docs: DataFrame, model_path: str = MODEL_PATH, threads: int = THREADS) -> DataFrame:
    """(doc_id, ids, round_trip, n_differences) for each row of ``docs``.

    ``model_path`` is a file of the driver, sent to the executors as bytes. Null and empty texts
    have no ids. ``n_differences`` counts units (whole texts, where the model needs them) at which
    the rebuilt tokenizer, whose ids are returned, and the sentencepiece library differ.
    ``round_trip`` is false where decoding gives another text: with normalisation, with the space
    marker in the text, or with unknown characters in a model without byte pieces. Repeated rows
    are encoded each; null ids stay null; further columns are ignored; an empty table gives no rows. A very
    long text is a chunk of its own; its memory grows with its length.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(
        _encoder(_shipped(docs, model_path), threads),
        "doc_id long, ids array<int>, round_trip boolean, n_differences long",
    )


def decode(encoded: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); a null list gives an empty text.

    Bytes that are no UTF-8 become the replacement character, as in the sentencepiece library.
    """
    model = _shipped(encoded, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or Codec(model.value, 1)
            lists = batch.column("ids").fill_null([])
            at = np.asarray(lists.offsets).astype(np.int64)
            data, ends = codec.decode(np.asarray(lists.flatten()), at - at[0])
            raw = data.tobytes()
            texts = [raw[a:z].decode("utf-8", "replace") for a, z in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>")).mapInArrow(
        run, "doc_id long, text string"
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip", "n_differences"
    )
