"""Near-duplicate groups by SetSketch registers (operator 7).

A document's set holds the hashes of its distinct five-word shingles. Register ``i`` of its sketch
is ``floor(1 - log_b(h))``, truncated to the register's range, of the least exponentially
distributed hash ``h`` in the set: exponentially spaced truncated minima. The register-wise maximum
of two sketches is the sketch of the union, and equal registers grow with the Jaccard similarity.

1. Documents of equal sets are one class; its smallest id stands for it.
2. Bands of registers place classes in buckets. With ``BANDS`` bands of ``ROWS`` registers a pair at
   similarity 0.75 misses all buckets with probability (1 - 0.75^3)^32 = 2e-8.
3. In each bucket all members are paired with its smallest id. A pair is dropped only if its sizes
   rule out the similarity, or if the joint likelihood estimate of the similarity from both
   sketches lies more than ``SIGMAS`` standard errors below the threshold; all others are verified
   on full sets.
4. Buckets whose members are not in one component yet go on: the members outside of the largest
   component become further centres, ``CENTRES`` in the next round and ``CENTRES`` times as many in
   each after it, until all have been. A pair in one component needs no test; others meet in the
   first band that they share, and only if a second sketch of ``BINS`` bins, each with a code of its
   least hash, does not rule them out at ``SIGMAS`` standard errors; they go through the likelihood and
   the verification like the pairs of the first round. So no bucket is expanded into all pairs, none is
   cut, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.components import components
from wordloom.llm.hashing import U64, Words, chunks, mix, ngram_hashes, text_bytes
from wordloom.llm.shared import settled

SHINGLE = 5
#: Least similarity, in percent.
PERCENT = 75
BANDS, ROWS = 32, 3
#: Base, rate and largest value of a register.
BASE, RATE, TOP = 1.001, 20.0, 65535
#: Bins of the second sketch, of which LANES are packed in one number.
BINS, LANES = 511, 7
#: Standard errors below the threshold at which the estimate rules a pair out.
SIGMAS = 5.0
#: Centres per bucket in the second round.
CENTRES = 2048
#: Centres of a bucket that meet its members in one task, and pairs that are compared at once.
BLOCK_CENTRES = 512
BLOCK_PAIRS = 1 << 16


def shingle_sets(
    words: Words, data: np.ndarray, offsets: np.ndarray, width: int
) -> Iterator[np.ndarray]:
    """The set of each text of a chunk, as sorted distinct hashes."""
    hashed, _, _, bounds = words.hash_words(data, offsets)
    grams = ngram_hashes(hashed, width)
    for a, z in zip(bounds[:-1], bounds[1:], strict=True):
        if z - a >= width:
            yield np.unique(grams[a : z - width + 1])
        elif z > a:  # fewer words: the whole sequence is the one shingle
            yield ngram_hashes(hashed[a:z], int(z - a)) ^ U64(z - a)
        else:
            yield np.zeros(0, U64)


def registers(least: np.ndarray, base: float = BASE) -> np.ndarray:
    """Register values of the least 64-bit hashes."""
    uniform = ((least >> U64(11)).astype(float) + 0.5) * 2.0**-53
    value = np.floor(1 - np.log(-np.log1p(-uniform) / RATE) / np.log(base))
    return np.clip(value, 0, TOP).astype(np.uint16)


def bins(own: np.ndarray) -> np.ndarray:
    """Codes 1 .. 255 of the least hash in each bin, packed by seven; 0 for an empty bin."""
    hashed = np.sort(mix(own ^ U64(0x5BD1E995)))
    place = (hashed >> U64(32)) * U64(BINS) >> U64(32)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(own) else np.zeros(0, np.int64)
    codes = np.zeros(BINS, U64)
    codes[place[first].astype(np.int64)] = (mix(hashed[first]) % U64(255)) + U64(1)
    shift = np.arange(LANES, dtype=U64) * U64(8)
    return (codes.reshape(-1, LANES) << shift).sum(axis=1, dtype=U64)


def _sketch(width: int, count: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        rng = np.random.default_rng(71)
        factor = rng.integers(0, 1 << 63, count, dtype=U64) * U64(2) + U64(1)
        shift = rng.integers(0, 1 << 63, count, dtype=U64)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            n, one, two, least, codes = [], [], [], [], []
            for first, last in chunks(offsets):
                part = data[offsets[first] : offsets[last]]
                at = offsets[first : last + 1] - offsets[first]
                for own in shingle_sets(words, part, at, width):
                    n.append(len(own))
                    one.append(int(np.bitwise_xor.reduce(mix(own + U64(1)), initial=0)))
                    two.append(int(mix(own ^ U64(0xA5A5A5A5)).sum(dtype=U64)))
                    low = np.full(count, ~U64(0))
                    for a in range(0, len(own), 1 << 12):
                        block = own[None, a : a + (1 << 12)] * factor[:, None] + shift[:, None]
                        np.minimum(low, block.min(axis=1), out=low)
                    least.append(low)
                    codes.append(bins(own))
            values = registers(np.array(least, U64).reshape(-1, count))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(np.array(one, U64).view(np.int64)),
                    pa.array(np.array(two, U64).view(np.int64)),
                    pa.array([x.tobytes() for x in values], pa.binary()),
                    pa.array([x.tobytes() for x in codes], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "one", "two", "registers", "codes"],
            )

    return sketch


def _values(column: pa.Array, count: int) -> np.ndarray:
    data, _ = text_bytes(column)
    return np.frombuffer(data.tobytes(), np.uint16).reshape(-1, count)


def _band(bands: int, rows: int):
    """Each band's registers in one number, its key among all bands, and the bins' numbers."""

    def lists(values: np.ndarray) -> pa.Array:
        rows_, width = values.shape
        offsets = pa.array(np.arange(0, (rows_ + 1) * width, width, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(values.ravel().view(np.int64)))

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = _values(batch.column("registers"), bands * rows).astype(U64)
            pack = np.zeros((len(value), bands), U64)
            for i in range(rows):
                pack |= value[:, i::rows] << U64(16 * i)
            key = mix(mix(pack) ^ np.arange(1, bands + 1, dtype=U64))
            codes, _ = text_bytes(batch.column("codes"))
            codes = np.frombuffer(codes.tobytes(), U64).reshape(-1, BINS // LANES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("n"), lists(key), lists(pack), lists(codes)],
                names=["rep", "n", "keys", "packs", "codes"],
            )

    return band


def _plausible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the bins of two sets, a row of bytes for each pair, leave the similarity possible.

    The share of bins with equal codes among those that are not empty in both estimates it, with
    variance J (1 - J) (1 / bins - 1 / union) or a little more where codes agree by chance.
    """
    share, spare = percent / 100, BINS // LANES  # a number's last byte is no bin
    equal = np.count_nonzero(a == b, axis=1) - spare
    empty = np.count_nonzero((a | b) == 0, axis=1) - spare
    used = float(BINS) - empty
    union = (n_a + n_b) / (1 + share)
    spread = np.sqrt(share * (1 - share) * np.maximum(1 / used - 1 / union, 0.0))
    return (equal - empty) / used >= share - SIGMAS * spread - 1e-9


def _meet(percent: int):
    """Pairs (a, b) of a centre and a row of its key and part that neither sizes nor bins rule out.

    Rows come by key and part, centres first. Only rows of different components meet, only in the first band that they
    share, and two centres once. The centres of a group that goes on are held for the next batch.
    """

    def plausible(rows: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = rows["n"]
        fit = rows["comp"][x] != rows["comp"][y]
        fit &= 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
        fit &= ~(rows["chosen"][y] & (rows["rep"][y] <= rows["rep"][x]))
        x, y = x[fit], y[fit]
        shared = rows["packs"][x] == rows["packs"][y]
        fit = shared.any(axis=1) & (shared.argmax(axis=1) == rows["band"][y])
        x, y = x[fit], y[fit]
        fit = _plausible(rows["codes"][x], rows["codes"][y], n[x], n[y], percent)
        return x[fit], y[fit]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "part", "centre", "chosen", "band", "rep", "comp", "n")}
            rows["packs"] = batch.column("packs").flatten().to_numpy().reshape(-1, BANDS)
            rows["codes"] = batch.column("codes").flatten().to_numpy().reshape(-1, BINS // LANES).view(np.uint8)
            before = 0
            if held is not None and held["key"][0] == rows["key"][0] and held["part"][0] == rows["part"][0]:
                before = len(held["key"])
                rows = {c: np.concatenate([held[c], v]) for c, v in rows.items()}
            new = (rows["key"][1:] != rows["key"][:-1]) | (rows["part"][1:] != rows["part"][:-1])
            first = np.append(0, np.flatnonzero(new) + 1)
            group = np.cumsum(np.append(0, new))
            centres = np.add.reduceat(rows["centre"].astype(np.int64), first)
            met = centres[group]  # centres that a row meets
            ends = np.cumsum(met)
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            low = 0
            while low < len(met):
                done = ends[low - 1] if low else 0
                high = max(int(np.searchsorted(ends, done + BLOCK_PAIRS, "right")), low + 1)
                y = np.repeat(np.arange(low, high), met[low:high])
                x = np.arange(len(y)) - np.repeat(ends[low:high] - met[low:high] - done, met[low:high]) + first[group[y]]
                fresh = (x >= before) | (y >= before)
                found.append(plausible(rows, x[fresh], y[fresh]))
                low = high
            x, y = (np.concatenate(f) for f in zip(*found, strict=True))
            pairs = np.sort(np.stack([rows["rep"][x], rows["rep"][y]]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
            last = slice(int(first[-1]), int(first[-1] + centres[-1]))
            held = {c: v[last].copy() for c, v in rows.items()} if centres[-1] else None

    return meet


def estimate(
    more: np.ndarray, less: np.ndarray, same: np.ndarray, n_a: np.ndarray, n_b: np.ndarray
) -> np.ndarray:
    """Jaccard similarity that maximises the joint likelihood of two sketches' comparisons.

    ``more``, ``less`` and ``same`` count the registers of a that lie above, below and at those of
    b; the sizes of both sets are known. The likelihood is concave, so a ternary search finds it.
    """
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)

    def above(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = above(u - v * j), above(v - u * j)
        tiny = 1e-12
        return (
            more * np.log(np.maximum(p, tiny))
            + less * np.log(np.maximum(q, tiny))
            + same * np.log(np.maximum(1 - p - q, tiny))
        )

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        right = likelihood(a) < likelihood(b)
        low, high = np.where(right, a, low), np.where(right, high, b)
    return (low + high) / 2


def _screen(count: int, percent: int):
    least = percent / 100 - SIGMAS * np.sqrt(percent / 100 * (1 - percent / 100) / count)

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (_values(batch.column(c), count).astype(np.int32) for c in ("ra", "rb"))
            n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            found = estimate(
                (x > y).sum(axis=1), (x < y).sum(axis=1), (x == y).sum(axis=1), n_a, n_b
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(found >= least)],
                names=["a", "b", "likely"],
            )

    return screen


def _verify(width: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        held, own_a = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("a").to_pylist()
            data_a, at_a = text_bytes(batch.column("ta"))
            data_b, at_b = text_bytes(batch.column("tb"))
            both, either = [], []
            row = 0
            for first, last in chunks(at_b):
                part = data_b[at_b[first] : at_b[last]]
                for own_b in shingle_sets(words, part, at_b[first : last + 1] - at_b[first], width):
                    here = data_a[at_a[row] : at_a[row + 1]]
                    if held is None or held[0] != ids[row] or not np.array_equal(held[1], here):
                        held = (ids[row], here.copy())
                        own_a = next(
                            shingle_sets(words, held[1], np.array([0, len(held[1])]), width)
                        )
                    common = len(np.intersect1d(own_a, own_b, assume_unique=True))
                    both.append(common)
                    either.append(len(own_a) + len(own_b) - common)
                    row += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("a"),
                    batch.column("b"),
                    pa.array(both, pa.int64()),
                    pa.array(either, pa.int64()),
                ],
                names=["a", "b", "common", "either"],
            )

    return verify


def near_duplicates(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, class_id) for each row of ``docs``.

    ``class_id`` is the smallest id with the same set. Null, empty and word-free texts have an empty
    set, are linked with nothing and kept. Rows of one id are one document, linked if any of
    them is. A row without id forms no links: its component is null and it is kept. Further columns
    are ignored. An empty table gives no rows. Of ties, in classes, buckets and components, the smallest id
    counts. A very long text is a chunk of its own; its set takes eight bytes for each of its words.
    """
    count = BANDS * ROWS
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    sketches = settled(
        own.mapInArrow(
            _sketch(width, count),
            "doc_id long, n_shingles long, one long, two long, registers binary, codes binary",
        ),
        "sketches",
    )
    usable = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("one", "two", "n_shingles").agg(F.min("doc_id").alias("rep"))
    classes = settled(classes, "classes")  # so that the join may split a hot class
    sets = sketches.select("doc_id", "n_shingles", "one", "two").join(
        classes, ["one", "two", "n_shingles"], "left"
    )
    sets = settled(
        sets.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep"), "one"),
        "sets",
    )
    reps = settled(
        usable.join(
            sets.where("doc_id = rep").select(F.col("rep"), F.col("one").alias("sign")).distinct(),
            (F.col("doc_id") == F.col("rep")) & (F.col("one") == F.col("sign")),
        )
        .select("rep", F.col("n_shingles").alias("n"), "registers", "codes")
        .dropDuplicates(["rep", "n"]),
        "representatives",
    )
    banded = settled(
        reps.mapInArrow(_band(BANDS, ROWS), "rep long, n long, keys array<long>, packs array<long>, codes array<long>"), "bands"
    )
    keyed = banded.select("rep", F.posexplode("keys").alias("band", "key"))
    shared = (
        keyed.groupBy("key")
        .agg(F.min("rep").alias("centre"), F.max("rep").alias("other"))
        .where("centre <> other")
        .select("key", "centre")
    )
    buckets = settled(keyed.join(shared, "key"), "buckets")
    texts = settled(
        own.join(buckets.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"),
        "near-texts",
    )
    # rows of one id with different sets are one document
    one = sets.where("rep is not null").groupBy("doc_id").agg(
        F.min("rep").alias("a"), F.max("rep").alias("top")
    ).where("a <> top").select("doc_id", "a")
    links = sets.join(one, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b"))

    def likely(pairs: DataFrame) -> DataFrame:
        """Pairs that neither sizes nor sketches rule out."""
        a = reps.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
        b = reps.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
        fit = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
        found = pairs.join(b, "b").join(a, "a").where(fit)
        found = found.mapInArrow(_screen(count, percent), "a long, b long, likely boolean")
        return found.where("likely").select("a", "b").distinct()

    def linked(pairs: DataFrame) -> DataFrame:
        """Pairs whose full sets reach the similarity."""
        ta = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
        tb = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
        tested = pairs.join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb")
        tested = tested.mapInArrow(_verify(width), "a long, b long, common long, either long")
        return settled(tested.where(100 * F.col("common") >= percent * F.col("either")).select("a", "b"), "links")

    star = buckets.where("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    labels = components(links.unionByName(linked(settled(likely(star), "likely"))))
    used = buckets.where("rep = centre").select("key", "rep")
    wanted = CENTRES
    while True:
        members = buckets.join(labels, buckets.rep == labels.node, "left").select(
            "key", "band", "rep", F.coalesce("comp", "rep").alias("comp")
        )
        sizes = members.groupBy("key", "comp").agg(F.count("*").alias("size"))
        largest = sizes.groupBy("key").agg(
            F.max(F.struct("size", "comp"))["comp"].alias("largest"), F.count("*").alias("comps")
        )
        mixed = settled(members.join(largest.where("comps > 1").drop("comps"), "key"), "mixed")
        outside = mixed.where("comp <> largest").join(used, ["key", "rep"], "left_anti")
        rank = F.row_number().over(Window.partitionBy("key").orderBy("rep"))
        chosen = outside.withColumn("rank", rank).where(F.col("rank") <= wanted)
        chosen = chosen.select("key", "rep", F.floor((F.col("rank") - 1) / BLOCK_CENTRES).cast("int").alias("slice"))
        chosen = settled(chosen, "centres")
        if chosen.isEmpty():
            break
        # the members of a bucket come once for each slice of its centres
        parts = chosen.groupBy("key").agg(F.max("slice").alias("parts"))
        here = mixed.join(parts, "key").join(chosen, ["key", "rep"], "left")
        here = here.select("*", F.explode(F.sequence(F.lit(0), "parts")).alias("part"))
        here = here.select(
            "key", "part", F.col("slice").eqNullSafe(F.col("part")).alias("centre"), F.col("slice").isNotNull().alias("chosen"),
            F.col("band").cast("int").alias("band"), "rep", "comp",
        )
        here = here.join(banded.select("rep", "n", "packs", "codes"), "rep")
        here = here.repartition("key", "part").sortWithinPartitions("key", "part", F.desc("centre"))
        fresh = here.mapInArrow(_meet(percent), "a long, b long").distinct()
        more = linked(settled(likely(settled(fresh, "plausible")), "likely"))
        used = settled(used.unionByName(chosen.drop("slice")), "used")
        wanted *= CENTRES
        # new links join whole components
        ends = [labels.select(F.col("node").alias(c), F.col("comp").alias(f"c{c}")) for c in ("a", "b")]
        joined = more.join(ends[0], "a", "left").join(ends[1], "b", "left").select(
            F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")
        )
        merged = components(joined)
        old = labels.unionByName(more.select(F.explode(F.array("a", "b")).alias("node")).withColumn("comp", F.col("node")))
        old = old.groupBy("node").agg(F.min("comp").alias("comp"))
        top = merged.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
        labels = settled(
            old.join(top, "comp", "left").select("node", F.coalesce("top", "comp").alias("comp")), "labels"
        )
    return sets.join(labels, sets.rep == labels.node, "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("comp", "rep", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("comp", "rep", "doc_id")).alias("kept"),
        F.coalesce("rep", "doc_id").alias("class_id"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
