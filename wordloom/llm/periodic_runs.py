"""Runs: stretches of a text that repeat one passage at least three times in a row (operator 11).

The words of a text are appended one by one to a suffix automaton, whose suffix links are kept as a
link-cut tree. A preferred path of it joins the states whose strings last ended at the same place.
Access to the state of the whole prefix walks the paths from it to the root: a path that last ended at
``j``, with longest string ``L``, says that the last ``L`` words also ended at ``j``, and nowhere later. With
``p = i - j <= L`` these are a square of period ``p``, and the ``L + p`` last words are the longest stretch of that
period that ends at ``i``. The access recolours the whole path with ``i``. A run is met at each of its ends
from its third period on with the same start and period, so it is extended to its last end by
remembering (start, period).

Before that, stretches that can hold no run are left out, exactly: in a run of period ``q`` and at least
``max(24, 3 q)`` words, every window of nine words stands again at most ``q`` words away. Windows are compared by
hashes, which can only let too much through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.expressions import let
from wordloom.llm.hashing import U64, chunks, mix, ngram_hashes

#: A run has so many words at least, and so many periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Longest window that a run of least length repeats within one period on either side of every place.
WINDOW = 9

RUNS = "array<struct<start:long,length:long,period:long>>"


def squares(words: list[int]) -> dict[tuple[int, int], int]:
    """Last end of each (start, period) stretch with three periods and ``LEAST_WORDS`` words."""
    # Node 0 is none, node 1 the root. A node's ``up`` is its parent in its splay tree or, for the root
    # of a splay tree, the state above its path; ``seen`` is the path's last end, at the splay tree's root.
    length, link, follow = [0, 0], [0, 0], [{}, {}]
    left, right, up, seen = [0, 0], [0, 0], [0, 0], [-1, -1]

    def splay(v: int) -> None:
        while True:
            p = up[v]
            if left[p] != v and right[p] != v or not p:
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                rotate(p if (left[g] == p) == (left[p] == v) else v)
            rotate(v)

    def rotate(v: int) -> None:
        p = up[v]
        g = up[p]
        if left[p] == v:
            child = right[v]
            left[p], right[v] = child, p
        else:
            child = left[v]
            right[p], left[v] = child, p
        if child:
            up[child] = p
        up[p], up[v] = v, g
        if left[g] == p:
            left[g] = v
        elif right[g] == p:
            right[g] = v
        seen[v] = seen[p]  # counts once v is the root of its splay tree

    def state(size: int, edges: dict, parent: int) -> int:
        length.append(size)
        link.append(parent)
        follow.append(edges)
        left.append(0)
        right.append(0)
        up.append(parent)
        seen.append(-1)
        return len(length) - 1

    ends: dict[tuple[int, int], int] = {}
    last = 1
    for i, word in enumerate(words):
        current = state(i + 1, {}, 1)
        p = last
        while p and word not in follow[p]:
            follow[p][word] = current
            p = link[p]
        if p:
            q = follow[p][word]
            if length[q] != length[p] + 1:
                # a new state between q and the state above it, on q's path
                splay(q)
                above = left[q]
                clone = state(length[p] + 1, dict(follow[q]), link[q])
                left[clone], left[q], up[clone] = above, clone, q
                if above:
                    up[above] = clone
                while p and follow[p].get(word) == q:
                    follow[p][word] = clone
                    p = link[p]
                link[q] = q = clone
            link[current] = up[current] = q
        last = current

        below, v = current, up[current]
        while v:
            splay(v)
            deeper = right[v]
            if deeper:
                seen[deeper] = seen[v]
            period, size = i - seen[v], length[v]
            if size >= (LEAST_PERIODS - 1) * period and size + period >= LEAST_WORDS and seen[v] >= 0:
                ends[i + 1 - size - period, period] = i + 1
            right[v] = below
            below, v = v, up[v]
        seen[below] = i
    return ends


def _stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of a text outside of which no run lies."""
    if len(ids) < LEAST_WORDS:
        return []
    key = ngram_hashes(mix(ids.astype(U64) + U64(0x9E3779B97F4A7C15)), WINDOW)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return []
    # distance from each window to the nearest equal one
    step = np.where(same, np.diff(order), len(ids))
    near = np.empty(len(key), np.int64)
    near[order] = np.minimum(np.append(step, len(ids)), np.append(len(ids), step))
    kept = near * LEAST_PERIODS <= len(ids)
    for _ in range(8):  # more rounds would only leave out more
        edges = np.diff(np.concatenate([[0], kept.view(np.int8), [0]]))
        start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        size = end - start + WINDOW - 1
        allowed = np.where(size >= LEAST_WORDS, size // LEAST_PERIODS, 0)
        fits = kept.copy()
        fits[kept] = near[kept] <= np.repeat(allowed, end - start)
        if fits.sum() == kept.sum():
            break
        kept = fits
    return [(int(a), int(z) + WINDOW - 1) for a, z in zip(start, end, strict=True)]


def runs_of(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a list of words, by start, then period."""
    numbers: dict = {}
    ids = [numbers.setdefault(w, len(numbers)) for w in words]
    found = []
    for first, end in _stretches(np.array(ids, np.int64)):
        for (start, period), stop in squares(ids[first:end]).items():
            found.append((first + start, stop - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _best(runs: list[tuple[int, int, int]]) -> dict | None:
    best = None
    for run in runs:  # by start, then period, so the first of equal ones stays
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return None if best is None else dict(zip(("start", "length", "period"), best, strict=True))


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    kept = bytearray(b"\1") * len(words)
    for start, length, period in runs:
        kept[start + period : start + length] = bytes(length - period)
    return b" ".join([w for w, k in zip(words, kept, strict=True) if k])


def _finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        texts = batch.column("text")
        sizes = np.array([len(t.as_py() or b"") for t in texts], np.int64)
        for first, last in chunks(np.append(0, np.cumsum(sizes)), 4 << 20):
            n_words, runs, best, collapsed = [], [], [], []
            for text in texts.slice(first, last - first):
                words = (text.as_py() or b"").split()
                own = runs_of(words) if len(words) >= LEAST_WORDS else []
                n_words.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in own])
                best.append(_best(own))
                collapsed.append(_collapsed(words, own) if own else b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, last - first),
                    pa.array(n_words, pa.int64()),
                    pa.array(runs, pa.list_(kind)),
                    pa.array(best, kind),
                    pa.array(collapsed, pa.binary()),
                ],
                names=["doc_id", "n_words", "runs", "best", "collapsed"],
            )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, best, collapsed) for each row of ``docs``.

    ``runs`` lists (start, length, period) in words by start, then period: all stretches of at least
    ``max(24, 3 * period)`` words, ``period`` their smallest, that no neighbouring word extends.
    ``best`` is the run of most periods (ties: least start, then period), null without runs.
    ``collapsed`` is the text with one period of each run: the words that no run holds after its first
    period, joined by one space.

    Null and empty texts have no words, no runs and an empty ``collapsed``. Repeated rows and null ids give
    a row each; further columns are ignored; an empty table gives no rows. A text is handled whole in one
    task: a very long one takes some hundred bytes for each word inside its repetitive stretches.
    """
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")
    ).mapInArrow(
        _finder,
        f"doc_id long, n_words long, runs {RUNS}, best struct<start:long,length:long,period:long>, collapsed binary",
    )
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))


def folded(doc_id: Column, text: Column) -> Column:
    """A tenth of the texts, made periodic: the digest's own change to its input.

    With ``h`` the CRC of the id, ``g = h div 10`` and ``h % 10 = 0``, each word ``i >= a`` becomes word
    ``a + (i - a) % p``, where ``a = g % n`` and ``p = 1 + (n - a) div (3 + g % 8)``. Rows without id stay.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def fold(words: Column) -> Column:
        n = F.size(words).cast("long")

        def from_place(a: Column) -> Column:
            def by_period(p: Column) -> Column:
                moved = F.transform(
                    words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int")))
                )
                return F.array_join(moved, " ")

            return let(1 + F.floor((n - a) / (3 + g % 8)).cast("long"), by_period)

        return F.when(n > 0, let(g % n, from_place)).otherwise(text)

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when(h % 10 == 0, let(words, fold)).otherwise(text)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select("doc_id", folded(F.col("doc_id"), F.col("text")).alias("text"))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return periodic_runs(docs).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
