"""Vectorised hashing of UTF-8 text inside tasks: words, word n-grams, prefix polynomial hashes.

A word's bytes go through a mixing hash, eight at a time. A polynomial hash of bytes ``[s, e)`` is ``sum(T[byte_j] * B**(j - s))`` modulo 2**64 with a random
table ``T`` and an odd base, so that one running sum over a buffer gives the hash of every
substring: ``(S[e] - S[s]) * B**-s``. Modulo a power of two, strings of a self-similar order of 1,024 bytes
or more can share such a hash, whatever the base, so it is for shorter ones only. All functions work on one chunk of whole texts; their memory
is a fixed multiple of the chunk, and a chunk is longer than ``CHUNK_BYTES`` only where one text is.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are handled in chunks of about so many bytes.
CHUNK_BYTES = 1 << 20

#: The bytes that separate words (space, and tab to carriage return).
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word; a bijection."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: Spans of more bytes are hashed one by one.
LONG_BYTES = 256


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A mixing hash of the bytes of each span ``[start, end)``."""
    size = end - start
    out = mix(size.astype(U64) + U64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
    many = np.flatnonzero(size > LONG_BYTES)
    for i in many.tolist():
        whole = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little"))
        out[i] = int.from_bytes(whole.digest(), "little")
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # the eight bytes from each byte on
    live = np.flatnonzero((size > 0) & (size <= LONG_BYTES))
    at, rest = start[live], size[live]
    while len(live):
        block = eights[at]
        tail = rest < 8
        block[tail] &= (U64(1) << (rest[tail] * 8).astype(U64)) - U64(1)
        out[live] = mix((out[live] ^ block) * U64(0xD6E8FEB86659FD93) + U64(0xA0761D6478BD642F))
        more = rest > 8
        live, at, rest = live[more], at[more] + 8, rest[more] - 8
    return out


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32


class Poly:
    """Prefix polynomial hashes under one base and one random table of byte values, for substrings below 1,024 bytes."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
        self.base = int(rng.integers(1 << 40, 1 << 62)) | 5
        self.up = self.down = np.ones(1, U64)

    def powers(self, n: int) -> None:
        if len(self.up) >= n:
            return
        size = 1 << max(12, (n - 1).bit_length())
        inverse = pow(self.base, -1, 1 << 64)
        self.up = np.multiply.accumulate(
            np.concatenate([[U64(1)], np.full(size - 1, self.base, U64)])
        )
        self.down = np.multiply.accumulate(
            np.concatenate([[U64(1)], np.full(size - 1, inverse, U64)])
        )

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self.powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(self.table[data] * self.up[: len(data)], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the substrings ``[start, end)``, not mixed."""
        return (sums[end] - sums[start]) * self.down[start]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without copying; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes each, one text at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of every word ``[^\\x20\\x09-\\x0D]+`` of a chunk."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_IS_SPACE[data]
    borders = offsets[1:-1]
    fresh = inside[1:] & ~inside[:-1]  # a word starts at i
    over = inside[:-1] & ~inside[1:]  # a word ends before i
    touching = borders[(borders > 0) & (borders < len(data))]
    touching = touching[inside[touching] & inside[touching + 1]]
    fresh[touching] = True
    over[touching] = True
    start, end = np.flatnonzero(fresh), np.flatnonzero(over)
    return start, end, np.searchsorted(offsets, start, "right") - 1


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes, regardless of text borders."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, U64)
    out = np.zeros(count, U64)
    factor = 1
    for i in range(n):
        out += words[i : i + count] * U64(factor)
        factor = factor * 0x9E3779B97F4A7C15 % (1 << 64)
    return mix(out)


class Words:
    """Hashes of words and word n-grams of a chunk of texts, ASCII letters in either case alike."""

    def __init__(self, seed: int = 11, fold_case: bool = True):
        self.seed, self.fold_case = seed, fold_case

    def hash_spans(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return span_hashes(_FOLD[data] if self.fold_case else data, start, end, self.seed)

    def hash_words(self, data: np.ndarray, offsets: np.ndarray):
        """(word hash, start, end, first word of each text with one more at the end)."""
        start, end, text = word_spans(data, offsets)
        bounds = np.searchsorted(text, np.arange(len(offsets)))
        return self.hash_spans(data, start, end), start, end, bounds


def give_back() -> None:
    """Return freed memory to the system at the end of a task, since Spark keeps its Python workers."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)
