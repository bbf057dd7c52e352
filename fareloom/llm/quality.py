"""Quality of texts: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Features are n-grams of the words as written (one and two), n-grams of the words' shapes (one to three; runs of small letters,
capitals, digits and bytes of other letters count as one sign each) and whether a word repeats the one before it, all
hashed into 2^bits weights. A feature's value is its count over the number of words, so that a score is a sparse dot
product that the length of a text does not swell.

The model is fitted on a bounded sample of labelled rows: `sample` documents, about, chosen by the hash of the id. The
sample is dealt to `shards` tasks; each runs FTRL-proximal over its rows for some epochs, and the weights are averaged. All
documents are scored, each over its whole text.

Defined results: a text without words has the score of the intercept; labels other than 0 and 1 and ids without a
document do not train, and an id with several labels trains with each; without training rows every score is 0.5; null ids
and repeated rows are scored row by row; an empty table gives no rows. Columns other than doc_id, text and quality are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.frames import python_tasks, stored, text_column
from fareloom.llm.words import Words, hash_words, mixed, split_words, text_slices

BITS = 18
SAMPLE = 12_000
SHARDS = 4
EPOCHS = 4
SCALE = 16.0  # of feature values: shares of a text's words are small numbers
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001

# One sign for each class of bytes; other bytes stand for themselves.
_SIGN = np.arange(256, dtype=np.uint8)
_SIGN[ord("a"):ord("z") + 1] = ord("a")
_SIGN[ord("A"):ord("Z") + 1] = ord("A")
_SIGN[ord("0"):ord("9") + 1] = ord("9")
_SIGN[0x80:] = ord("a")


def word_shapes(data: np.ndarray, words: Words) -> np.ndarray:
    """Hash of each word's shape."""
    if not len(words.start):
        return np.zeros(0, np.uint64)
    sign = _SIGN[data]
    new = np.ones(len(sign), bool)
    new[1:] = sign[1:] != sign[:-1]
    new[words.start] = True
    inside = np.zeros(len(sign) + 1, np.int8)
    inside[words.start] += 1
    np.subtract.at(inside, words.end, 1)
    keep = new & (np.cumsum(inside[:-1]) > 0)
    place = np.append(0, np.cumsum(keep))
    return hash_words(sign[keep], Words(place[words.start], place[words.end], words.first))


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts, one row per word and one column per kind of n-gram, and the texts' first words.

    An n-gram belongs to its last word and does not reach into the text before: there it is a shorter one.
    """
    words = split_words(data, offsets)
    plain, shape = hash_words(data, words), word_shapes(data, words)
    count = words.count
    place = np.arange(len(plain)) - np.repeat(words.first[:-1], count)

    def before(h: np.ndarray, steps: int) -> np.ndarray:
        out = np.zeros(len(h), np.uint64)
        out[steps:] = h[:-steps] if steps < len(h) else 0
        out[place < steps] = 0
        return out

    with np.errstate(over="ignore"):
        one, two = before(shape, 1), before(shape, 2)
        last = before(plain, 1)
        kinds = [mixed(plain, 51), mixed(plain + mixed(last, 52), 53), mixed(shape, 54), mixed(shape + mixed(one, 55), 56),
                 mixed(shape + mixed(one, 55) + mixed(two, 57), 58), mixed((plain == last).astype(np.uint64), 59)]
    return np.stack([k & np.uint64((1 << bits) - 1) for k in kinds], axis=1).astype(np.int64), words.first


class Leader:
    """FTRL-proximal: per-coordinate rates, weights of little evidence stay 0. The intercept is the last coordinate."""

    def __init__(self, bits: int):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, at: np.ndarray, value: np.ndarray, label: float) -> None:
        w = self.weights(at)
        gradient = (1 / (1 + np.exp(-np.clip(w @ value, -30, 30))) - label) * value
        square = gradient * gradient
        self.z[at] += gradient - (np.sqrt(self.n[at] + square) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] += square


def trained_weights(labelled: DataFrame, bits: int, shards: int, epochs: int) -> np.ndarray:
    """Mean of the shards' weights; zeros if there is nothing to learn from. `labelled` is a bounded sample."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[np.ndarray, np.ndarray, float]] = []
        for batch in batches:
            labels = batch.column(1).to_pylist()
            for start, end, data, offsets in text_slices(batch.column(0)):
                numbers, first = features(data, offsets, bits)
                for i in range(end - start):
                    own = numbers[first[i]:first[i + 1]].ravel()
                    at, count = np.unique(own, return_counts=True)
                    value = count * SCALE / max(first[i + 1] - first[i], 1)
                    rows.append((np.append(at, 1 << bits), np.append(value, 1.0), float(labels[start + i])))
        if rows:
            leader = Leader(bits)
            for _ in range(epochs):
                for at, value, label in rows:
                    leader.learn(at, value, label)
            weights = leader.weights(slice(None))
            some = np.flatnonzero(weights)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(weights[some])], ["feature", "weight"])

    dealt = labelled.repartition(shards, F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards))).sortWithinPartitions(F.xxhash64("doc_id"), "quality")
    fitted = stored(dealt.select("text", "quality").mapInArrow(fit, "feature long, weight double")
                    .withColumn("shard", F.spark_partition_id()), "quality-weights")
    used = max(fitted.agg(F.count_distinct("shard").alias("n")).first().n, 1)
    out = np.zeros((1 << bits) + 1, np.float64)
    for row in fitted.groupBy("feature").agg(F.sum("weight").alias("w")).collect():  # at most 2^bits + 1 rows
        out[row.feature] = row.w / used
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, trains: Column, sample: int) -> DataFrame:
    """doc_id, text and quality of about `sample` labelled rows, chosen by the hash of the id."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & trains).select("doc_id", "quality").distinct()
    share = min(1.0, sample / max(usable.count(), 1))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)) < F.lit(share * (1 << 20)))
    # about `sample` rows: small whatever the input
    return docs.select("doc_id", text_column().alias("text")).join(F.broadcast(chosen), "doc_id")


def quality_scores(docs: DataFrame, labels: DataFrame, trains: Column | None = None, bits: int = BITS, sample: int = SAMPLE,
                   shards: int = SHARDS, epochs: int = EPOCHS) -> DataFrame:
    """doc_id and score of each row of `docs`; `trains` marks label rows (by doc_id) that may be learned from."""
    spark = docs.sparkSession
    python_tasks(spark)
    chosen = labelled_sample(docs, labels, F.lit(True) if trains is None else trains, sample)
    shared = spark.sparkContext.broadcast(trained_weights(chosen, bits, shards, epochs))  # 2^bits + 1 numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            parts = [np.zeros(0)]
            for _, _, data, offsets in text_slices(batch.column(1)):
                numbers, first = features(data, offsets, bits)
                by_word = np.append(weights[numbers].sum(axis=1), 0.0)
                sums = np.append(0.0, np.cumsum(by_word))
                count = np.diff(first)
                margin = weights[-1] + SCALE * (sums[first[1:]] - sums[first[:-1]]) / np.maximum(count, 1)
                parts.append(1 / (1 + np.exp(-np.clip(margin, -500, 500))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts))], ["doc_id", "score"])

    return docs.select("doc_id", text_column().alias("text")).mapInArrow(score, "doc_id long, score double")
