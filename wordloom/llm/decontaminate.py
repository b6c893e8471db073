"""Benchmark decontamination by rare n-gram seeds and local alignment (operator 6).

The benchmark is the query set: it is read in blocks of bounded size, each of which goes to all
executors, and every document is compared with every block.

A leak is a passage whose Smith-Waterman alignment with an item of ``L`` words scores ``T = 2 s L`` or more, at +2
for equal words and -1 for a changed, inserted or dropped one, ``s`` being ``SIMILARITY``. Of its ``m`` matches, each two
neighbours have some edits between them, ``2 m - T`` at most in all. So at least ``s L - 1`` neighbours have one
edit between them at most: two words that stand one or two apart both in the item and in the document. Such
ordered pairs are the seeds, two for each word of an item but the last.

1. A first pass counts in how many documents each seed of a block occurs.
2. Of an item's ``L - 1`` seed places, a leak misses ``L - s L`` at most. So of the rarest
   ``L - s L + r - 1`` places it holds ``r``, and common phrases need no look: a second pass joins documents to
   items by the seeds of these places. Hits of one item within its length of each other form a
   passage, which needs ``r`` places, then ``s L - 1`` places of all, and ``s L`` of the item's words. No leak misses
   one of these bounds.
3. The alignment compares what is left with the item word by word.

Items of under ``MIN_WORDS`` words would be met by chance; they are looked for verbatim, and those of one
or two words only as a whole text.

Words are runs of non-space characters, ASCII letters in either case alike, without ASCII
punctuation at their ends. Both passes keep one chunk of texts in memory and shuffle only counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.hashing import U64, Words, chunks, mix, ngram_hashes, text_bytes, word_spans
from wordloom.llm.shared import received, settled, shipped

#: Items of fewer words match only verbatim, those of under WHOLE_WORDS only a whole text.
MIN_WORDS, WHOLE_WORDS = 8, 3
#: Rare seed places that a passage must hold.
MIN_SEEDS = 3
#: Least share of the score of a verbatim copy.
SIMILARITY = 0.5
#: Bytes of items that are sent to the executors at once.
BLOCK_BYTES = 8 << 20
#: Alignments that run side by side, in cells of one row.
ALIGN_CELLS = 1 << 16
#: Hits with their items, and words of passages and items, that are compared at once.
PAIRS = 1 << 20

MATCH, EDIT = 2, 1

_ENDS = np.zeros(256, bool)
_ENDS[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


class _Reader:
    """Hashes of the words of a chunk, punctuation at their ends left out."""

    def __init__(self):
        self.words = Words(61)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, end, text = word_spans(data, offsets)
        bounds = np.searchsorted(text, np.arange(len(offsets)))
        for side in (0, 1):
            live = np.arange(len(start))
            while len(live):
                at = end[live] - 1 if side else start[live]
                live = live[_ENDS[data[at]] & (end[live] - start[live] > 1)]
                if side:
                    end[live] -= 1
                else:
                    start[live] += 1
        return self.words.hash_spans(data, start, end), bounds


def _pairs(words: np.ndarray, gap: int) -> np.ndarray:
    """Hash of each word with the one ``gap`` places after it; the gap itself does not count."""
    return mix(words[:-gap] + words[gap:] * U64(0x9E3779B97F4A7C15))


def _least(length: np.ndarray, similarity: float) -> np.ndarray:
    """Seed places that a leak of an item holds."""
    return np.ceil(similarity * length - 1e-9).astype(np.int64) - 1


class _Items:
    """A block of items: word hashes, and their seeds in order of hash."""

    def __init__(self, ids: list, texts: list[str], similarity: float):
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        self.ids, self.similarity = ids, similarity
        self.words, self.bounds = _Reader()(data, offsets)
        self.length = np.diff(self.bounds)
        self.least = _least(self.length, similarity)
        self.vocabulary, self.word = np.unique(self.words, return_inverse=True)
        owner = np.repeat(np.arange(len(ids)), self.length)
        place = np.arange(len(self.words)) - self.bounds[owner]
        seeds = []
        for gap in (1, 2):
            at = np.flatnonzero((place + gap < self.length[owner]) & (self.length[owner] >= MIN_WORDS))
            hashed = _pairs(self.words, gap) if len(self.words) > gap else np.zeros(0, U64)
            seeds.append((hashed[at], owner[at], place[at]))
        gram, item, place = (np.concatenate(x) for x in zip(*seeds, strict=True))
        # all seeds item by item, and those that are looked for, by hash
        self.seeds, number = np.unique(gram, return_inverse=True)
        order = np.argsort(item, kind="stable")
        self.seed, self.seed_place = number[order], place[order]
        self.seed_bounds = np.searchsorted(item[order], np.arange(len(ids) + 1))
        self._index(gram, item, place)
        self.short = {}
        for n in range(1, MIN_WORDS):
            own = np.flatnonzero(self.length == n)
            if len(own):
                hashed = ngram_hashes(self.words, n)[self.bounds[own]]
                order = np.argsort(hashed, kind="stable")
                self.short[n] = hashed[order], own[order]

    def _index(self, gram: np.ndarray, item: np.ndarray, place: np.ndarray) -> None:
        order = np.lexsort((item, gram))
        self.gram, self.item, self.place = gram[order], item[order], place[order]
        self.distinct = np.unique(self.gram)
        self.key = np.searchsorted(self.distinct, self.gram) * len(self.ids) + self.item

    def weigh(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        """Look only for the seeds of each item's rarest places, as many as any leak must meet."""
        full = np.zeros(len(self.distinct))
        full[np.searchsorted(self.distinct, hashes)] = counts
        width = int(self.length.max(initial=1))
        where = self.item * width + self.place
        spot, index = np.unique(where, return_inverse=True)
        weight = np.bincount(index, full[np.searchsorted(self.distinct, self.gram)], len(spot))
        item = spot // width
        order = np.lexsort((spot, weight, item))
        rank = np.empty(len(spot), np.int64)
        rank[order] = np.arange(len(spot)) - np.searchsorted(item, item[order])
        looked = self.length - 1 - self.least + np.minimum(MIN_SEEDS, self.least)
        kept = (rank < looked[item])[index]
        self._index(self.gram[kept], self.item[kept], self.place[kept])


def _hits(items: _Items, words: np.ndarray, bounds: np.ndarray):
    """(position, text, hash) of the seeds of a chunk that some item has, text by text."""
    none = (np.zeros(0, np.int64),) * 2 + (np.zeros(0, U64),)
    if not len(items.distinct):
        return none
    # a small table of leading bits turns most pairs away before the search
    bits = U64(64 - 20)
    table = np.zeros(1 << 20, bool)
    table[items.distinct >> bits] = True
    found = [none]
    for gap in (1, 2):
        if len(words) <= gap:
            continue
        grams = _pairs(words, gap)
        at = np.flatnonzero(table[grams >> bits])
        place = np.searchsorted(items.distinct, grams[at])
        place[place == len(items.distinct)] = 0
        at = at[items.distinct[place] == grams[at]]
        text = np.searchsorted(bounds, at, "right") - 1
        inside = at + gap < bounds[text + 1]
        found.append((at[inside], text[inside], grams[at[inside]]))
    at, text, gram = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(text, kind="stable")
    return at[order], text[order], gram[order]


def _verbatim(items: _Items, words: np.ndarray, bounds: np.ndarray):
    """(text, item, start, end) of the first place of each short item in each text that holds it."""
    found = [(np.zeros(0, np.int64),) * 4]
    for n, (hashed, own) in items.short.items():
        grams = ngram_hashes(words, n)
        low, high = np.searchsorted(hashed, grams, "left"), np.searchsorted(hashed, grams, "right")
        at = np.flatnonzero(high > low)
        text = np.searchsorted(bounds, at, "right") - 1
        inside = at + n <= bounds[text + 1]
        if n < WHOLE_WORDS:
            inside &= bounds[text + 1] - bounds[text] == n
        at, text = at[inside], text[inside]
        many = high[at] - low[at]  # items of the same words
        at, text, row = np.repeat(at, many), np.repeat(text, many), np.repeat(low[at] - np.cumsum(many) + many, many)
        item = own[row + np.arange(len(row))]
        _, first = np.unique(text * len(items.ids) + item, return_index=True)
        found.append((text[first], item[first], at[first], at[first] + n))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _count(block):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, items = _Reader(), received(block)
        total = np.zeros(len(items.distinct), np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in chunks(offsets):
                part = data[offsets[first] : offsets[last]]
                words, bounds = read(part, offsets[first : last + 1] - offsets[first])
                _, text, gram = _hits(items, words, bounds)
                if len(gram):
                    index = np.searchsorted(items.distinct, gram)
                    once = np.unique(text * len(total) + index) % len(total)
                    total += np.bincount(once, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(items.distinct[some].view(np.int64)), pa.array(total[some])], names=["gram", "n"]
        )

    return count


def align(
    item: np.ndarray, passage: np.ndarray, backwards: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score and where it ends, for rows of padded word hashes.

    Padding is 0 in items and 1 in passages, so that it equals nothing. With ``backwards`` both are
    read from the end.
    """
    if backwards:
        item, passage = item[:, ::-1], passage[:, ::-1]
    rows, width = passage.shape
    slope = EDIT * np.arange(width + 1)
    row = np.zeros((rows, width + 1), np.int64)
    best, end = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    for i in range(item.shape[1]):
        same = passage == item[:, i : i + 1]
        new = np.maximum(row - EDIT, 0)
        np.maximum(new[:, 1:], row[:, :-1] + np.where(same, MATCH, -EDIT), out=new[:, 1:])
        # a run of inserted words: the best start, less one for each word since
        new = np.maximum.accumulate(new + slope, axis=1) - slope
        row = np.maximum(new, 0)
        top = row.argmax(axis=1)
        score = row[np.arange(rows), top]
        better = score > best
        best, end = np.where(better, score, best), np.where(better, top, end)
    if backwards:
        end = width - end
    return best, end


def _portions(items: _Items, text: np.ndarray, gram: np.ndarray):
    """Hits with every item that has them, as (hit, index into the items' n-grams).

    Portions have about PAIRS rows; those of one text and item stay together.
    """
    n, rank = len(items.ids), np.searchsorted(items.distinct, gram)
    total = np.cumsum(np.searchsorted(items.key, (rank + 1) * n) - np.searchsorted(items.key, rank * n))
    first = before = 0
    while first < len(gram):
        last = int(np.searchsorted(total, before + PAIRS, "right"))
        if last < len(gram):
            last = int(np.searchsorted(text, text[last]))
            if last <= first:
                last = int(np.searchsorted(text, text[first], "right"))
        own = rank[first:last] * n
        parts = min(-(-int(total[last - 1] - before) // PAIRS), n)
        edges = np.arange(parts + 1) * n // parts
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            low, high = np.searchsorted(items.key, own + a), np.searchsorted(items.key, own + z)
            many = high - low
            if many.any():
                index = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
                yield np.repeat(np.arange(first, last), many), index
        first, before = last, total[last - 1]


def _ranges(low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of all values of the ranges ``low`` to ``low + size``."""
    row = np.repeat(np.arange(len(low)), size)
    return row, np.repeat(low - np.cumsum(size) + size, size) + np.arange(len(row))


def _enough(items: _Items, words, item, low, high) -> np.ndarray:
    """Which passages ``[low, high)`` hold as many of their item's words and seed places as a leak does."""
    out = np.zeros(len(item), bool)
    size = items.length[item]
    work = np.cumsum(high - low + size)
    first = before = 0
    while first < len(item):
        last = max(int(np.searchsorted(work, before + PAIRS, "right")), first + 1)
        own, start, width = item[first:last], low[first:last], (high - low)[first:last]

        def held(known: np.ndarray, row: np.ndarray, values: np.ndarray) -> np.ndarray:
            place = np.minimum(np.searchsorted(known, values), len(known) - 1)
            same = known[place] == values
            return np.unique(row[same] * len(known) + place[same])

        row, at = _ranges(start, width)
        found = held(items.vocabulary, row, words[at])
        of, at = _ranges(items.bounds[own], items.length[own])
        shared = np.bincount(of[np.isin(of * len(items.vocabulary) + items.word[at], found)], minlength=len(own))
        some = np.flatnonzero(shared >= items.similarity * items.length[own])
        if len(some):
            pairs = []
            for gap in (1, 2):
                row, at = _ranges(start[some], np.maximum(width[some] - gap, 0))
                pairs.append((row, mix(words[at] + words[at + gap] * U64(0x9E3779B97F4A7C15))))
            found = held(items.seeds, *(np.concatenate(x) for x in zip(*pairs, strict=True)))
            begin = items.seed_bounds[own[some]]
            of, at = _ranges(begin, items.seed_bounds[own[some] + 1] - begin)
            met = np.isin(of * len(items.seeds) + items.seed[at], found)
            span = int(items.length.max())
            places = np.unique(of[met] * span + items.seed_place[at[met]]) // span
            out[first + some] = np.bincount(places, minlength=len(some)) >= items.least[own[some]]
        first, before = last, work[last - 1]
    return out


def _scored(items: _Items, words, text, item, low, high) -> tuple[np.ndarray, ...]:
    """Scores and word ranges of passages ``[low, high)`` against their items, side by side."""
    score = np.zeros(len(item), np.int64)
    start, end = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
    order = np.lexsort((high - low, items.length[item]))
    a = 0
    while a < len(order):
        z = a + 1
        width = high[order[a]] - low[order[a]]
        while z < len(order):
            wider = max(width, high[order[z]] - low[order[z]])
            if (z + 1 - a) * wider > ALIGN_CELLS or items.length[item[order[z]]] > 2 * items.length[item[order[a]]]:
                break
            width, z = wider, z + 1
        now = order[a:z]
        tall = int(items.length[item[now]].max())
        left = np.zeros((len(now), tall), U64)
        right = np.ones((len(now), int(width)), U64)
        for i, k in enumerate(now):
            own = items.words[items.bounds[item[k]] : items.bounds[item[k] + 1]]
            left[i, : len(own)] = own
            right[i, : high[k] - low[k]] = words[low[k] : high[k]]
        best, till = align(left, right)
        behind = np.arange(right.shape[1])[None, :] >= till[:, None]
        _, since = align(left, np.where(behind, U64(1), right), backwards=True)
        score[now], end[now], start[now] = best, low[now] + till, low[now] + since
        a = z
    return score, start, end


def _passages(items: _Items, text, item, origin, place, bounds):
    """(text, item, low, high) of the passages of hits that lie within their item's length of each other."""
    order = np.lexsort((origin, item, text))
    text, item, origin, place = text[order], item[order], origin[order], place[order]
    size = items.length[item]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (origin[1:] - origin[:-1] > size[1:])
    group = np.flatnonzero(new)
    tail = np.append(group[1:], len(text)) - 1
    width = int(size.max(initial=1))
    places = np.unique((np.cumsum(new) - 1) * width + place) // width
    enough = np.bincount(places, minlength=len(group)) >= np.minimum(MIN_SEEDS, items.least[item[group]])
    group, tail = group[enough], tail[enough]
    text, item, size = text[group], item[group], size[group]
    # a leak has no more edits than its item has words
    low = np.maximum(origin[group] - size, bounds[text])
    high = np.minimum(origin[tail] + 2 * size + 1, bounds[text + 1])
    return text, item, low, high


def _find(block, similarity: float):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, items = _Reader(), received(block)
        names = ["doc_id", "item", "score", "full", "first_word", "end_word"]

        def rows(ids, text, item, score, full, start, end) -> pa.RecordBatch:
            found = [pa.array(np.asarray(x, np.int64)) for x in (item, score, full, start, end)]
            return pa.RecordBatch.from_arrays([pa.array(ids[text], from_pandas=True).cast(pa.int64()), *found], names=names)

        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            data, offsets = text_bytes(batch.column("text"))
            for first, last in chunks(offsets):
                part = data[offsets[first] : offsets[last]]
                words, bounds = read(part, offsets[first : last + 1] - offsets[first])
                own, item, start, end = _verbatim(items, words, bounds)
                if len(own):
                    full = MATCH * items.length[item]
                    yield rows(ids, first + own, item, full, full, start - bounds[own], end - bounds[own])
                at, text, gram = _hits(items, words, bounds)
                if not len(at):
                    continue
                for hit, index in _portions(items, text, gram):
                    origin = at[hit] - items.place[index]
                    own, item, low, high = _passages(items, text[hit], items.item[index], origin, items.place[index], bounds)
                    sure = _enough(items, words, item, low, high)
                    own, item, low, high = own[sure], item[sure], low[sure], high[sure]
                    size = items.length[item]
                    score, start, end = _scored(items, words, own, item, low, high)
                    good = np.flatnonzero(score >= similarity * MATCH * size)
                    # the best passage of each document and item; of equal ones the first
                    good = good[np.lexsort((start[good], -score[good], item[good], own[good]))]
                    once = np.ones(len(good), bool)
                    once[1:] = (own[good][1:] != own[good][:-1]) | (item[good][1:] != item[good][:-1])
                    good = good[once]
                    own, item = own[good], item[good]
                    yield rows(
                        ids, first + own, item, score[good], MATCH * size[good], start[good] - bounds[own], end[good] - bounds[own]
                    )

    return find


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list, list[str]]]:
    """The benchmark's distinct items in blocks of about BLOCK_BYTES, one item at least."""
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    rows = rows.where("item_id is not null and text is not null").distinct().orderBy("item_id", "text")
    ids, texts, size = [], [], 0
    for row in rows.toLocalIterator():
        ids.append(row.item_id)
        texts.append(row.text)
        size += len(row.text.encode())
        if size >= BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, score, similarity, first_word, end_word): items that documents contain.

    One row per pair, for its best passage, given as a range of words; of equally good ones the first.
    ``similarity`` is the score as a share of a verbatim copy's. Items of under ``MIN_WORDS`` words match
    verbatim, those of one or two words only a whole text; null and empty items match nothing, null and
    empty texts contain nothing. Rows of one id are judged each and repeated in the result if
    several hold an item; a row without id is reported with a null id. Further columns are ignored. Empty
    tables give no rows. A very long text is a chunk of its own; its memory grows with its length.

    Each block of items is settled before the next one is sent, so that one is held at a time.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id long, item_id {kind}, score long, similarity double, first_word long, end_word long"
    found = spark.createDataFrame([], schema)
    for ids, texts in _blocks(benchmark):
        items = _Items(ids, texts, similarity)
        if len(items.gram):
            block = shipped(spark, items)
            counts = own.mapInArrow(_count(block), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
            rows = counts.toPandas()  # at most one row per seed of the block
            block.destroy()
            items.weigh(rows["gram"].to_numpy(np.int64).view(U64), rows["n"].to_numpy(float))
        elif not items.short:
            continue
        weighed = shipped(spark, items)
        pairs = settled(
            own.mapInArrow(
                _find(weighed, similarity),
                "doc_id long, item long, score long, full long, first_word long, end_word long",
            ),
            "leaks",
        )
        weighed.destroy()
        names = spark.createDataFrame(list(enumerate(ids)), f"item long, item_id {kind}")
        part = pairs.join(names, "item").select(
            "doc_id",
            "item_id",
            "score",
            (F.col("score") / F.col("full")).alias("similarity"),
            "first_word",
            "end_word",
        )
        found = found.unionByName(part)
    return found


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
