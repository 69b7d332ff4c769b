"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL-proximal updates.

A word is what stands between white space. Its n-grams are taken of the words as written and of their shapes
(capitals, digits, closing punctuation, whether the word repeats the one before), hashed to a fixed number of
weights. A score is a sparse dot product: the weights of all n-grams of a text, over the root of their number.

Training sees a bounded sample of the labelled rows, those with the least hash of their id, in one task that
reads them as a stream; the weights (one megabyte) are broadcast. Every text is scored in full.

Null texts are empty and get the score of the intercept; without labelled rows every score is one half. Rows
without a quality label or without doc_id are not learnt from. A document with several labels has their mean, rounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcount.llm.textbytes import between, blocks, flat, mixed, prefixes

#: Labelled documents that are learnt from, at most.
SAMPLE = 6000
EPOCHS = 3
BUCKETS = 1 << 18
# FTRL-proximal: step size, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.5

_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_CODES = np.arange(256)
_UPPER = (_CODES >= 65) & (_CODES <= 90)
_LOWER = ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 0x80)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)


def features(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, and where those of each text begin and end.

    Four for each word: the word, it and the one before, its shape, and the shapes of it and the two before.
    """
    word = ~_SPACE[x]
    inner = at[(at > 0) & (at < len(x))]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    first[inner] = word[inner]
    last[:-1] &= ~word[1:]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = np.searchsorted(starts, at)
    if not len(starts):
        return np.zeros(0, np.int64), bounds * 4
    own = mixed(between(prefixes(x), starts, ends))

    def count(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind[x])])
        return total[ends] - total[starts]

    upper, lower, digit = count(_UPPER), count(_LOWER), count(_DIGIT)
    opening = np.zeros(len(starts) + 1, bool)
    opening[bounds[:-1]] = True  # first word of a text: no word before
    before = np.concatenate([own[:1], own[:-1]])
    before[opening[:-1]] = 0
    close = x[ends - 1]
    close = np.where(_UPPER[close] | _LOWER[close] | _DIGIT[close], 0, close)
    shape = ((np.minimum(upper, 2) * 2 + (lower > 0)) * 2 + (digit > 0)) * 2 + (own == before)
    shape = mixed((shape * 256 + close).astype(np.uint64) + np.uint64(1))
    one, two = np.concatenate([shape[:1], shape[:-1]]), np.concatenate([shape[:1], shape[:1], shape[:-2]])[:len(shape)]
    one[opening[:-1]] = 0
    two[opening[:-1]] = 0
    second = np.flatnonzero(opening[:-1]) + 1
    two[second[second < len(two)]] = 0
    grams = np.stack([own + np.uint64(1), own + before * np.uint64(3), shape + np.uint64(7),
                      shape + one * np.uint64(5) + two * np.uint64(11)], axis=1)
    return (mixed(grams.ravel()) % np.uint64(BUCKETS)).astype(np.int64), bounds * 4


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


class Ftrl:
    """Follow the regularised leader, per coordinate; the last weight is the intercept."""

    def __init__(self, buckets: int = BUCKETS):
        self.z, self.n = np.zeros(buckets + 1), np.zeros(buckets + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (sigmoid(w @ value) - label) * value
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - step * w
        self.n[at] += g * g


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct buckets and values of training texts."""
    for batch in blocks(batches):
        bucket, bounds = features(*flat(batch.column("text")))
        at, value = [], []
        for a, b in zip(bounds[:-1], bounds[1:]):
            own, n = np.unique(bucket[a:b], return_counts=True)
            at.append(np.append(own, BUCKETS).astype(np.int32).tobytes())
            value.append(np.append(n / np.sqrt(max(b - a, 1)), 1.0).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("rank"), batch.column("label"), pa.array(at, pa.binary()), pa.array(value, pa.binary())],
            names=["rank", "label", "at", "value"])


def _trained(epochs: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns))]
        model = Ftrl()
        for _ in range(epochs):
            for _, label, at, value in rows:
                model.learn(np.frombuffer(at, np.int32), np.frombuffer(value, np.float32).astype(float), label)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype(np.float32).tobytes()], pa.binary())],
                                         names=["weights"])
    return train


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> np.ndarray:
    """Weights, the intercept last, learnt from at most ``sample`` of the rows whose remainder is not 1."""
    rank = F.xxhash64("doc_id")
    chosen = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
        .filter(remainder(F.col("doc_id")) != 1)
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .orderBy(rank, "doc_id").limit(sample))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    examples = (texts.join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows
                .select(rank.alias("rank"), "label", "text")
                .mapInArrow(_examples, "rank long, label int, at binary, value binary"))
    row = (examples.repartition(1).sortWithinPartitions("rank", "label", "at")
           .mapInArrow(_trained(epochs), "weights binary").first())
    return np.frombuffer(row["weights"], np.float32) if row else np.zeros(BUCKETS + 1, np.float32)


def _scorer(weights):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in blocks(batches):
            bucket, bounds = features(*flat(batch.column("text")))
            total = np.concatenate([[0.0], np.cumsum(w[bucket], dtype=np.float64)])
            n = np.diff(bounds)
            z = w[-1] + (total[bounds[1:]] - total[bounds[:-1]]) / np.sqrt(np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sigmoid(z))],
                                             schema=batch.schema.append(pa.field("__score", pa.float64())))
    return score


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """docs with __score (0 to 1) as the last column; no shuffle."""
    value = docs.sparkSession.sparkContext.broadcast(weights)
    return docs.mapInArrow(_scorer(value), docs.withColumn("__score", F.lit(0.0)).schema)


def predictions(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of docs."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scored(plain, fit(docs, labels, sample)).select(
        "doc_id", (remainder(F.col("doc_id")) == 1).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that score one half or more, with all their columns."""
    return scored(docs, fit(docs, labels, sample)).filter("__score >= 0.5").drop("__score")
