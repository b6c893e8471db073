"""Exact removal of repeated byte strings by hash-compared suffix sorting (operator 8).

Every ``length``-byte string (100) that also starts earlier, in a document of smaller id or at a
smaller offset of the same one, is removed with all bytes that it covers. Three steps:

1. *Anchors.* Of the ``SEED``-byte strings inside each ``length``-byte window, the one of the least
   hash is the window's anchor, so equal windows have equal anchors at equal offsets. Neighbouring
   windows share an anchor; together they are its context. Contexts are compared by two
   independent 64-bit hashes: all but the first of equal contexts are repeats as a whole. Repeats
   inside one task never leave it, so a passage in a third of all rows travels once per task.
2. *Suffix sort.* Contexts of one anchor that differ, which lie at the borders of repeated
   passages, are cut into blocks of windows and meet by the hash of the bytes that all windows of a
   block share. There the suffixes that start at the windows are merge-sorted: prefix polynomial
   hashes and a binary search give the common extension of two suffixes, so that a comparison
   takes a logarithmic number of steps. Neighbours whose common extension reaches ``length`` are
   verified byte by byte; the first of each run stays.
3. The removed ranges of a document are united and cut from its text.

A document's list of ranges is bounded by its length. Nothing is dropped, capped or sampled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.hashing import CHUNK_BYTES, U64, Poly, mix, text_bytes
from wordloom.llm.shared import settled

#: Length of the strings that are removed.
LENGTH = 100
#: Length of an anchor.
SEED = 30
#: Windows that are routed together in the second step.
BLOCK = 16
#: Anchors that a task gathers before it drops its own repeats.
GATHER = 1 << 20
#: Suffixes that are sorted at once. Of a group with more, the first of equal ones are held.
SORT_ROWS = 1 << 18

_POSITION = U64((1 << 24) - 1)
_MARK = -(1 << 63)

_ANCHOR_SCHEMA = "route long, context long, doc_id long, packed long, until long"
_PIECE_SCHEMA = "route long, doc_id long, first long, offset int, count int, bytes binary"


def _pieces(offsets: np.ndarray, length: int, limit: int) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last text, start, end): whole texts, or parts of one that overlap by a window."""
    first, n = 0, len(offsets) - 1
    while first < n:
        if offsets[first + 1] - offsets[first] > limit:
            for start in range(int(offsets[first]), int(offsets[first + 1]), limit):
                end = min(start + limit + length - 1, int(offsets[first + 1]))
                yield first, first + 1, start, end
            first += 1
            continue
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        yield first, last, int(offsets[first]), int(offsets[last])
        first = last


def anchors(
    data: np.ndarray, bounds: np.ndarray, one: Poly, two: Poly, length: int, seed: int
) -> tuple[np.ndarray, ...]:
    """(anchor hash, context hash, text, anchor position, first window, last window) per context."""
    n, width = len(data), length - seed + 1
    grams = n - seed + 1
    windows = n - length + 1
    if windows <= 0:
        return (np.zeros(0, U64),) * 2 + (np.zeros(0, np.int64),) * 4
    sums = one.prefix(data)
    gram = (sums[seed:] - sums[:grams]) * one.down[:grams]
    gram = mix(gram)
    key = (gram & ~_POSITION) | np.arange(grams, dtype=U64)
    rows = np.full(-(-grams // width) * width, ~U64(0))
    rows[:grams] = key
    rows = rows.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    at = np.minimum(back[:windows], ahead[width - 1 : width - 1 + windows]) & _POSITION
    at = at.astype(np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:windows]
    start = np.flatnonzero(np.arange(length, windows + length) <= bounds[1:][text])
    if not len(start):
        return (np.zeros(0, U64),) * 2 + (np.zeros(0, np.int64),) * 4
    at = at[start]
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    new = np.flatnonzero(new)
    low = start[new]
    high = start[np.append(new[1:], len(start)) - 1]
    at = at[new]
    sums = two.prefix(data)
    context = two.spans(sums, low, high + length)
    context = mix(mix(context ^ (at - low).astype(U64)) + (high - low).astype(U64))
    return gram[at], context, text[low], at, low, high


def _find_anchors(length: int, seed: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Poly(81), Poly(82)
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def settle() -> pa.RecordBatch:
            gram, context, doc, packed = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((packed, doc, context, gram))
            gram, context, doc, packed = (x[order] for x in (gram, context, doc, packed))
            group = np.ones(len(gram), bool)
            group[1:] = gram[1:] != gram[:-1]
            fresh = group.copy()
            fresh[1:] |= context[1:] != context[:-1]
            low, high = (packed >> 16) - ((packed >> 8) & 255), packed & 255
            # repeats of what this task has seen: ranges, united per document
            again = ~fresh
            union = _unite(doc[again], low[again], low[again] + high[again] + length)
            # anchors with several contexts here are known to be borders; one mark tells the others
            index = np.cumsum(group) - 1
            several = np.bincount(index, weights=fresh)[index] > 1
            route = np.where(several, mix(gram ^ context), gram)
            mark = np.flatnonzero(group & several)
            keep = np.flatnonzero(fresh)
            columns = (
                [route[keep], gram[mark], mix(union[1].astype(U64) ^ mix(union[0].astype(U64)))],
                [context[keep], np.full(len(mark), _MARK).view(U64), np.zeros(len(union[0]), U64)],
                [doc[keep], np.full(len(mark), -1), union[0]],
                [packed[keep], np.full(len(mark), -1), union[1]],
                [np.where(several[keep], -2, -1), np.full(len(mark), -3), union[2]],
            )
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.asarray(x).view(np.int64) for x in c])) for c in columns],
                names=["route", "context", "doc_id", "packed", "until"],
            )

        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, last, start, end in _pieces(offsets, length, CHUNK_BYTES):
                bounds = np.clip(offsets[first : last + 1], start, end) - start
                gram, context, text, at, low, high = anchors(
                    data[start:end], bounds, one, two, length, seed
                )
                base = start - offsets[first + text]
                packed = ((at + base) << 16) | ((at - low) << 8) | (high - low)
                if len(gram):
                    held.append((gram, context, ids[first + text].astype(np.int64), packed))
                    count += len(gram)
                if count >= GATHER:
                    yield settle()
                    count = 0
        if count:
            yield settle()

    return find


def _unite(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Union of ranges per document: (document, start, end), in order."""
    if not len(doc):
        return (np.zeros(0, np.int64),) * 3
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    _, rank = np.unique(doc, return_inverse=True)
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + rank * span)
    new = np.ones(len(doc), bool)
    new[1:] = start[1:] + rank[1:] * span > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], reach[last] - rank[first] * span


def common_extension(
    sums: np.ndarray, poly: Poly, a: np.ndarray, b: np.ndarray, length: int
) -> np.ndarray:
    """Length of the common prefix, up to ``length``, of the suffixes that start at a and b."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), length)
    for _ in range(int(length).bit_length()):
        middle = (low + high + 1) >> 1
        same = poly.spans(sums, a, a + middle) == poly.spans(sums, b, b + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def merge_sort(
    data: np.ndarray, poly: Poly, start: np.ndarray, segment: np.ndarray, length: int
) -> np.ndarray:
    """Order of the ``length``-byte suffixes at ``start`` inside each segment, stable.

    Segments are contiguous. Runs double with each round; an element's place in the merged run is
    its own plus its rank in the sibling run, which a binary search over suffix comparisons finds.
    """
    sums = poly.prefix(data)
    n = len(start)
    order = np.arange(n)
    begin = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
    size = np.diff(np.append(begin, n))
    origin, extent = np.repeat(begin, size), np.repeat(size, size)
    local = np.arange(n) - origin
    run, longest = 1, int(size.max(initial=0))
    while run < longest:
        mine = np.flatnonzero(extent > run)
        block = local[mine] // run
        left = block % 2 == 0
        low = origin[mine] + (block ^ 1) * run
        end = origin[mine] + extent[mine]
        high = np.minimum(low + run, end)
        keep = low < end
        mine, block, left, low, high = (x[keep] for x in (mine, block, left, low, high))
        first = low.copy()
        own = start[order[mine]]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            other = start[order[middle]]
            same = common_extension(sums, poly, own[open_], other, length)
            equal = same == length
            at = np.minimum(same, length - 1)
            less = data[other + at] < data[own[open_] + at]
            less = np.where(equal, ~left[open_], less)  # of equals, the left run comes first
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)
        pair = origin[mine] + (block // 2) * 2 * run
        inside = mine - (origin[mine] + block * run)
        new = order.copy()
        new[pair + inside + (low - first)] = order[mine]
        order = new
        run *= 2
    return order


def repeated_windows(
    data: np.ndarray, start: np.ndarray, segment: np.ndarray, length: int, poly: Poly
) -> np.ndarray:
    """Which of the windows, in order of precedence inside a segment, equal an earlier one there."""
    order = merge_sort(data, poly, start, segment, length)
    a, b = order[:-1], order[1:]
    beside = np.flatnonzero(segment[a] == segment[b])
    a, b = a[beside], b[beside]
    same = common_extension(poly.prefix(data), poly, start[a], start[b], length) == length
    a, b = a[same], b[same]
    for part in range(0, len(a), 1 << 16):  # verify the bytes behind equal hashes
        x, y = a[part : part + (1 << 16)], b[part : part + (1 << 16)]
        view = np.lib.stride_tricks.sliding_window_view(data, length)
        if not (view[start[x]] == view[start[y]]).all():
            raise ValueError("equal hashes of different strings; choose another seed")
    out = np.zeros(len(start), bool)
    out[b] = True
    return out


def _cut_pieces(length: int, block: int):
    """Rows (doc_id, text, borders) to pieces; pieces that a task has already sent are repeats."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly, check = Poly(83), Poly(84)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            lists = batch.column("borders")
            at = np.asarray(lists.offsets)
            packed = np.asarray(lists.flatten())
            row = np.repeat(np.arange(len(ids)), np.diff(at))
            pos = packed >> 16
            deep = (packed >> 8) & 255
            low, high = pos - deep, pos - deep + (packed & 255)
            parts = []
            for b in range(-(-(length) // block)):
                first = np.maximum(low, pos - block * b - block + 1)
                last = np.minimum(high, pos - block * b)
                some = np.flatnonzero(first <= last)
                core = pos[some] - block * b
                offset = np.full(len(some), b) * block + block - 1 - (pos[some] - first[some])
                parts.append((row[some], first[some], last[some], core, offset, (pos - first)[some]))
            row, first, last, core, offset, deep = (
                np.concatenate(x) for x in zip(*parts, strict=True)
            )
            order = np.lexsort((first, ids[row]))
            row, first, last, core, offset, deep = (
                x[order] for x in (row, first, last, core, offset, deep)
            )
            base = offsets[row]
            route = np.zeros(len(row), U64)
            whole = np.zeros(len(row), U64)
            for a, z, start, end in _pieces_of_rows(row, offsets):
                sums, twice = poly.prefix(data[start:end]), check.prefix(data[start:end])
                x = base[a:z] - start
                route[a:z] = poly.spans(
                    sums, x + core[a:z], x + core[a:z] + length - block + 1
                )
                whole[a:z] = check.spans(twice, x + first[a:z], x + last[a:z] + length)
            route = mix(route ^ mix((deep // block).astype(U64)))
            whole = mix(whole ^ mix((last - first).astype(U64) << U64(8) | offset.astype(U64)))
            order = np.lexsort((np.arange(len(row)), whole, route))
            fresh = np.ones(len(row), bool)
            fresh[1:] = (route[order][1:] != route[order][:-1]) | (
                whole[order][1:] != whole[order][:-1]
            )
            send = np.zeros(len(row), bool)
            send[order] = fresh
            start, end = base + first, base + last + length
            for a in range(0, len(row), 1 << 14):
                now = slice(a, a + (1 << 14))
                ship = send[now]
                sizes = np.where(ship, (end - start)[now], 0)
                ends = np.cumsum(sizes)
                index = np.repeat(start[now] - (ends - sizes), sizes) + np.arange(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(route[now].view(np.int64)),
                        pa.array(ids[row[now]]),
                        pa.array(first[now]),
                        pa.array(offset[now].astype(np.int32)),
                        pa.array((last - first + 1)[now].astype(np.int32)),
                        pa.Array.from_buffers(
                            pa.binary(),
                            len(sizes),
                            [
                                pa.py_buffer(np.packbits(ship, bitorder="little").tobytes()),
                                pa.py_buffer(np.append(0, ends).astype(np.int32).tobytes()),
                                pa.py_buffer(data[index].tobytes()),
                            ],
                        ),
                    ],
                    names=["route", "doc_id", "first", "offset", "count", "bytes"],
                )

    return cut


def _pieces_of_rows(row: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of pieces whose texts lie together in at most about CHUNK_BYTES, and that place."""
    a = 0
    while a < len(row):
        top = int(row[a])
        last = int(np.searchsorted(offsets, offsets[top] + CHUNK_BYTES, "right")) - 1
        last = max(last, top + 1)
        z = a + int(np.argmax(row[a:] >= last)) if (row[a:] >= last).any() else len(row)
        # rows are sorted by id, which need not be the order of the batch
        inside = (row[a:z] >= top) & (row[a:z] < last)
        z = a + (int(np.argmin(inside)) if not inside.all() else z - a)
        yield a, z, int(offsets[top]), int(offsets[last])
        a = z


def _sort_pieces(length: int):
    """Pieces sorted by (route, doc_id, first) to ranges of repeated windows."""

    def solve(block: pa.Table, poly: Poly) -> tuple[pa.RecordBatch, pa.Table]:
        """The repeated windows' ranges, and the pieces with a window that is the first of its kind."""
        sent = np.asarray(block.column("bytes").is_null())  # its task has sent the same piece
        gone = [block.column(c).to_numpy()[sent].astype(np.int64) for c in ("doc_id", "first", "count")]
        block = block.filter(pa.array(~sent)).combine_chunks()
        route = block.column("route").to_numpy()
        doc = block.column("doc_id").to_numpy()
        first = block.column("first").to_numpy()
        offset = block.column("offset").to_numpy().astype(np.int64)
        count = block.column("count").to_numpy().astype(np.int64)
        data, at = text_bytes(block.column("bytes"))
        piece = np.repeat(np.arange(len(route)), count)
        step = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
        # windows of one route and one offset form a segment, in order of (doc_id, position)
        _, group = np.unique(route, return_inverse=True)
        segment = group[piece] * 256 + offset[piece] + step
        order = np.argsort(segment, kind="stable")
        piece, step, segment = piece[order], step[order], segment[order]
        _, inverse, sizes = np.unique(segment, return_inverse=True, return_counts=True)
        more = sizes[inverse] > 1
        piece, step, segment = piece[more], step[more], segment[more]
        again = np.zeros(len(piece), bool)
        if len(piece):
            again = repeated_windows(data, at[piece] + step, segment, length, poly)
        start = np.append(first[piece[again]] + step[again], gone[1])
        end = np.append(first[piece[again]] + step[again], gone[1] + gone[2] - 1) + length
        found = _unite(np.append(doc[piece[again]], gone[0]), start, end)
        ranges = pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["doc_id", "start", "end"])
        fresh = np.bincount(piece[again], minlength=len(count)) < count
        return ranges, block.filter(pa.array(fresh))

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Poly(85)
        held: list[pa.RecordBatch] = []
        rows, limit = 0, SORT_ROWS
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += int(np.asarray(batch.column("count")).sum())
            if rows < limit:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            route = table.column("route").to_numpy()
            cut = int(np.searchsorted(route, route[-1]))  # the last group may go on
            if cut:
                yield solve(table.slice(0, cut), poly)[0]
                table = table.slice(cut)
            else:  # one group: later pieces meet the first of each window only
                found, table = solve(table, poly)
                yield found
            held = table.to_batches()
            rows = int(table.column("count").to_numpy().sum()) if table.num_rows else 0
            limit = max(SORT_ROWS, 2 * rows)
        if held:
            yield solve(pa.Table.from_batches(held).combine_chunks(), poly)[0]

    return sort


def _digest(with_text: bool):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            lists = batch.column("ranges")
            at = np.asarray(lists.offsets)
            values = lists.flatten()
            starts, ends = (np.asarray(values.field(i)) for i in (0, 1))
            removed, spans, sums, texts = [], [], [], []
            for i in range(batch.num_rows):
                body = data[offsets[i] : offsets[i + 1]]
                a, z = at[i], at[i + 1]
                if z > a:
                    _, s, e = _unite(np.zeros(z - a, np.int64), starts[a:z], ends[a:z])
                    gone = np.zeros(len(body) + 1, np.int8)
                    gone[s] += 1
                    gone[e] -= 1
                    body = body[np.cumsum(gone[:-1]) == 0]
                    spans.append([{"start": int(x), "end": int(y)} for x, y in zip(s, e)])
                    removed.append(int((e - s).sum()))
                else:
                    spans.append([])
                    removed.append(0)
                sums.append(hashlib.sha256(body).hexdigest())
                if with_text:
                    texts.append(body.tobytes())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array(np.diff(offsets)),
                "n_removed": pa.array(removed, pa.int64()),
                "spans": pa.array(spans, kind),
                "kept_sha256": pa.array(sums, pa.string()),
            }
            if with_text:
                columns["kept_bytes"] = pa.array(texts, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return digest


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, seed: int = SEED, with_text: bool = False
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256[, kept_bytes]) of every document.

    Precedence follows ``doc_id``; rows of one id are compared in no defined order and share their
    removed ranges, so ids should be unique. A row whose id is null is neither compared nor cut.
    Null text counts as empty; a text shorter than ``length`` bytes can lose nothing. Further
    columns of ``docs`` are ignored. ``spans`` are the maximal removed runs. An empty table gives no rows. Of
    equal strings the one of the smallest id and place stays. A very long text is hashed in pieces.
    """
    if not 0 < seed <= length - 16 or length > 240:
        raise ValueError("need 0 < seed <= length - 16 and length <= 240")
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    own = every.where("doc_id is not null")
    found = own.where(F.octet_length("text") >= length).mapInArrow(_find_anchors(length, seed), _ANCHOR_SCHEMA)
    by_route = Window.partitionBy("route").orderBy("context", "doc_id", "packed")
    whole = by_route.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = found.select(
        "*",
        F.lag("context").over(by_route).alias("before"),
        F.first("context").over(whole).alias("least"),
        F.last("context").over(whole).alias("most"),
    )
    low = F.shiftright("packed", 16) - F.expr("(packed >> 8) & 255")
    anchor = F.col("until").isin(-1, -2)
    again = anchor & F.col("before").eqNullSafe(F.col("context"))
    border = anchor & ~again & ((F.col("until") == -2) | (F.col("least") != F.col("most")))
    marks = (
        ranked.where((F.col("until") >= 0) | again | border)
        .select(
            "doc_id",
            F.when(F.col("until") >= 0, F.struct(F.col("packed").alias("start"), F.col("until").alias("end")))
            .when(again, F.struct(low.alias("start"), (low + F.expr("packed & 255") + length).alias("end")))
            .alias("range"),
            F.when(border, F.col("packed")).alias("border"),
        )
        .groupBy("doc_id")
        .agg(F.collect_list("range").alias("ranges"), F.collect_list("border").alias("borders"))
    )
    marks = settled(marks, "repeat-marks")
    borders = marks.where(F.size("borders") > 0).select("doc_id", "borders")
    cut = own.join(borders, "doc_id").mapInArrow(_cut_pieces(length, BLOCK), _PIECE_SCHEMA)
    more = (
        cut.repartition("route")
        .sortWithinPartitions("route", "doc_id", "first")
        .mapInArrow(_sort_pieces(length), "doc_id long, start long, end long")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("start", "end")).alias("more"))
    )
    empty = F.expr("array(cast(null as struct<start: bigint, end: bigint>))")
    ranges = marks.select("doc_id", "ranges").join(more, "doc_id", "left").select(
        "doc_id",
        F.concat("ranges", F.coalesce("more", F.filter(empty, lambda x: x.isNotNull()))).alias("ranges"),
    )
    schema = (
        "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>,"
        " kept_sha256 string" + (", kept_bytes binary" if with_text else "")
    )
    none = F.filter(empty, lambda x: x.isNotNull())
    # the texts are shuffled by id once: both joins read the same exchange
    joined = own.join(ranges, "doc_id", "left").select(
        "doc_id", "text", F.coalesce("ranges", none).alias("ranges")
    )
    loose = every.where("doc_id is null").select("doc_id", "text", none.alias("ranges"))
    return joined.unionByName(loose).mapInArrow(_digest(with_text), schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )
