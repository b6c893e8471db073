"""Quality classifier: ordinal cumulative-link regression on graded ratings (operator 10).

Grades are ordered: 0 toxic, 1 of low quality, 2 good. One vector of weights over hashed text is
shared by all grades, and ordered thresholds cut its line: P(grade <= k) = sigmoid(t_k - w.x). The
expected grade and the tail probability P(grade = 2) follow from it; documents whose tail
probability reaches ``KEEP`` are selected.

Features of a text: its distinct words (ASCII letters in either case alike), and the share of words
of each shape (runs of capitals, small letters, digits and single marks), of repeats of the word
before, and of words said twice or more. All are hashed into ``BUCKETS`` weights.

The model is fitted on a bounded sample: at most ``SAMPLE`` labelled documents in the order of a
hash of their ids, and at most ``ENTRIES`` feature values. Every document is scored as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.hashing import U64, Words, chunks, mix, text_bytes
from wordloom.llm.shared import received, settled, shipped

BUCKETS = 1 << 16
SAMPLE = 14_000
ENTRIES = 6_000_000
KEEP = 0.5
GRADES = 3
#: Strength of the penalty on weights, and rounds of fitting.
PENALTY, ROUNDS = 0.1, 150
#: Documents of the sample that must hold a feature.
FEW = 5
#: Weight of the shares of shapes against single words.
SHAPES = 6.0

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_CLASS[128:] = ord("a")


class Features:
    """Hashed features of the texts of a chunk."""

    def __init__(self):
        self.words, self.shape = Words(101), Words(102, fold_case=False)

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """(bucket, value, first entry of each text with one more at the end)."""
        texts = len(offsets) - 1
        hashed, start, end, bounds = self.words.hash_words(data, offsets)
        if not len(hashed):
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(texts + 1, np.int64)
        text = np.repeat(np.arange(texts), np.diff(bounds))
        kind = _CLASS[data]
        turn = np.ones(len(data), bool)
        turn[1:] = kind[1:] != kind[:-1]
        turn[start] = True
        place = np.append(0, np.cumsum(turn))
        short = kind[turn]
        shape = self.shape.hash_spans(short, place[start], place[end])
        same = np.zeros(len(hashed), bool)
        same[1:] = (hashed[1:] == hashed[:-1]) & (text[1:] == text[:-1])
        bits = U64(64 - int(BUCKETS).bit_length() + 1)
        word = (hashed >> bits).astype(np.int64)
        keys, counts = np.unique(text * BUCKETS + word, return_counts=True)
        size = np.diff(bounds)
        own = keys // BUCKETS
        value = np.ones(len(keys))
        # shares: shapes, repeats of the word before, words said twice or more
        share = mix(shape ^ U64(7)) >> bits
        repeat = np.full(int(same.sum()), mix(np.array([1], U64))[0] >> bits)
        often = own[counts > 1]
        weight = np.append(np.ones(len(hashed) + len(repeat)), counts[counts > 1])
        fixed = np.full(len(often), mix(np.array([2], U64))[0] >> bits)
        bucket = np.concatenate([share, repeat, fixed]).astype(np.int64)
        of = np.concatenate([text, text[same], often])
        more, inverse = np.unique(of * BUCKETS + bucket, return_inverse=True)
        extra = SHAPES * np.bincount(inverse, weights=weight) / size[more // BUCKETS]
        keys, value = np.append(keys, more), np.append(value, extra)
        order = np.argsort(keys, kind="stable")
        keys, value = keys[order], value[order]
        return keys % BUCKETS, value, np.searchsorted(keys // BUCKETS, np.arange(texts + 1))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k below the highest grade."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.append(0.0, np.cumsum(values))
    return total[bounds[1:]] - total[bounds[:-1]]


def fit(bucket: np.ndarray, value: np.ndarray, bounds: np.ndarray, grade: np.ndarray) -> Model:
    """Weights and thresholds that maximise the penalised likelihood, by adaptive gradient steps.

    Thresholds stay ordered because their gaps are exponentials. A grade that the sample lacks
    leaves its threshold at the edge of the others. Without rows every document is good.
    """
    if not len(grade):
        return Model(np.zeros(BUCKETS), np.full(GRADES - 1, -20.0) + np.arange(GRADES - 1))
    seen = np.bincount(bucket, minlength=BUCKETS) >= FEW
    value = np.where(seen[bucket], value, 0.0)  # too rare to learn from: the weight stays 0
    row = np.repeat(np.arange(len(grade)), np.diff(bounds))
    share = np.array([(grade > k).mean() for k in range(GRADES - 1)]).clip(0.001, 0.999)
    cut = -np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(cut), 0.05))
    theta = np.concatenate([np.zeros(BUCKETS), cut[:1], gaps])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    balance = len(grade) / (GRADES * np.maximum(np.bincount(grade, minlength=GRADES), 1))
    weight = np.sqrt(balance[grade])
    weight /= weight.mean()
    for step in range(1, ROUNDS + 1):
        cut = np.cumsum(np.append(theta[BUCKETS], np.exp(theta[BUCKETS + 1 :])))
        score = _sums(value * theta[bucket], bounds)
        below = 1 / (1 + np.exp(np.clip(score[:, None] - cut[None, :], -40, 40)))
        low = np.hstack([np.zeros((len(grade), 1)), below])[np.arange(len(grade)), grade]
        high = np.hstack([below, np.ones((len(grade), 1))])[np.arange(len(grade)), grade]
        p = np.maximum(high - low, 1e-9)
        d_low, d_high = low * (1 - low), high * (1 - high)
        by_score = weight * (d_high - d_low) / p  # gradient of the loss by the score
        gradient = np.zeros_like(theta)
        gradient[:BUCKETS] = np.bincount(bucket, weights=value * by_score[row], minlength=BUCKETS)
        by_cut = np.array(
            [
                (weight * (((grade == k + 1) * d_low) - (grade == k) * d_high) / p).sum()
                for k in range(GRADES - 1)
            ]
        )
        tail = by_cut[::-1].cumsum()[::-1]
        gradient[BUCKETS] = tail[0]
        gradient[BUCKETS + 1 :] = tail[1:] * np.exp(theta[BUCKETS + 1 :])
        gradient /= len(grade)
        gradient[:BUCKETS] += PENALTY / 100 * theta[:BUCKETS]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        rate = 0.1 * (1 - 0.9 * step / ROUNDS)
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    return Model(theta[:BUCKETS], np.cumsum(np.append(theta[BUCKETS], np.exp(theta[BUCKETS + 1 :]))))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = Features()
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for first, last in chunks(offsets):
            part = data[offsets[first] : offsets[last]]
            bucket, value, bounds = features(part, offsets[first : last + 1] - offsets[first])
            lists = [
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), x)
                for x in (pa.array(bucket.astype(np.int32)), pa.array(value.astype(np.float32)))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(first, last - first) for c in ("doc_id", "grade")] + lists,
                names=["doc_id", "grade", "bucket", "value"],
            )


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from (doc_id, quality, toxic); a row with a null in them is no label.

    Of several labels of one document the lowest grade counts.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(GRADES - 1)
    graded = (
        labels.where("doc_id is not null and quality is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(grade).alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE)
    )
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    rows = own.join(F.broadcast(graded), "doc_id").select("doc_id", "grade", "text")  # SAMPLE rows at most
    rows = rows.mapInArrow(_features, "doc_id long, grade int, bucket array<int>, value array<float>")
    # both bounds follow the hash, whatever the order of the table
    rows = settled(rows, "sample").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("bucket", "value"))
    buckets, values, grades, size = [], [], [], 0
    for row in rows.toLocalIterator():
        if size + len(row.bucket) > ENTRIES:
            break
        size += len(row.bucket)
        grades.append(row.grade)
        buckets.append(np.array(row.bucket, np.uint32))
        values.append(np.array(row.value, np.float32))
    bounds = np.append(0, np.cumsum([len(x) for x in buckets])).astype(np.int64)
    none = [np.zeros(0)]
    return fit(
        np.concatenate(buckets or none).astype(np.int64),
        np.concatenate(values or none),
        bounds,
        np.array(grades, np.int64),
    )


def _score(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, own = Features(), received(model)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in chunks(offsets):
                part = data[offsets[first] : offsets[last]]
                bucket, value, bounds = features(part, offsets[first : last + 1] - offsets[first])
                tails = own.tails(_sums(value * own.weights[bucket], bounds))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.array(tails.sum(axis=1)),
                        pa.array(tails[:, -1]),
                    ],
                    names=["doc_id", "expected_grade", "p_good"],
                )

    return score


def grade(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """(doc_id, expected_grade, p_good, kept) for each row of ``docs``.

    Null, empty and word-free texts have no features and get the thresholds' own probabilities.
    Repeated rows and null ids are scored like others; further columns are ignored; an empty table gives no
    rows. Equal texts get equal scores. A very long text is a chunk of its own.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    model = shipped(docs.sparkSession, model)  # BUCKETS weights
    scored = own.mapInArrow(_score(model), "doc_id long, expected_grade double, p_good double")
    return scored.withColumn("kept", F.col("p_good") >= keep)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return grade(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
