"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL.

Words and runs of punctuation are hashed in numpy, one batch of texts at a
time; a text's features are the buckets of its words and word pairs, each
occurrence with the value ``1 / sqrt(number of features)``. The weights, one
per bucket, are broadcast and a batch is scored as one gather and one sum per
text: a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismcube.llm.common import mix, row_sums, text_chunks, texts_of, word_hashes

#: Hash buckets, as a power of two; one more holds the bias.
BUCKET_BITS = 18
#: Most labelled rows that training reads: those whose ids have the smallest hashes.
TRAINING_ROWS = 12_000
#: Hash of any word pair that is one word twice: repetition is alike whatever the word.
SAME = np.uint64(0xB5297A4D3F84D5B5)


@dataclass(frozen=True)
class Ftrl:
    """Step size, its offset, L1 and L2 penalties, and passes over the rows."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.3
    l2: float = 1.0
    passes: int = 3


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and word pairs of all texts, and how many each text has."""
    words, counts = word_hashes([t.encode("utf-8", "replace") for t in texts], marks="apart")
    last = np.cumsum(counts) - 1
    follows = np.ones(len(words), dtype=bool)
    follows[last[counts > 0]] = False
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), counts)
    first = np.flatnonzero(follows)
    pairs = mix(words[first] * np.uint64(3) + words[first + 1])
    pairs[words[first] == words[first + 1]] = SAME
    every = np.concatenate((words, pairs))
    owners = np.concatenate((owner, owner[first]))
    order = np.argsort(owners, kind="stable")
    buckets = (every >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    return buckets[order], np.bincount(owners, minlength=len(texts))


def probabilities(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """How likely each text has label 1; a text without words has the bias alone."""
    buckets, counts = features(texts)
    sums = row_sums(weights[buckets], counts) / np.sqrt(np.maximum(counts, 1))
    return 1 / (1 + np.exp(-np.clip(sums + weights[-1], -35, 35)))


def _training_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's distinct buckets and their values, for the learner."""
    for batch in text_chunks(batches):
        buckets, counts = features(texts_of(batch))
        ends = np.cumsum(counts)
        indices, values = [], []
        for end, n in zip(ends, counts, strict=True):
            index, times = np.unique(buckets[end - n : end], return_counts=True)
            indices.append(index)
            values.append((times / np.sqrt(max(n, 1))).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"), batch.column("label"), pa.array(indices, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
            ["place", "label", "buckets", "amounts"],
        )


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], options: Ftrl) -> np.ndarray:
    """FTRL-proximal over sparse rows, each with a bias of value 1; the last weight is the bias."""
    bias = 1 << BUCKET_BITS
    z = np.zeros(bias + 1)
    n = np.zeros_like(z)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        step = (options.beta + np.sqrt(n[at])) / options.alpha + options.l2
        return -np.sign(z[at]) * np.maximum(np.abs(z[at]) - options.l1, 0) / step

    for _ in range(options.passes):
        for own, amounts, label in rows:
            index, value = np.append(own, bias), np.append(amounts, np.float32(1))
            w = weights(index)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
            gradient = (p - label) * value
            sigma = (np.sqrt(n[index] + gradient**2) - np.sqrt(n[index])) / options.alpha
            z[index] += gradient - sigma * w
            n[index] += gradient**2
    return weights(slice(None))


def train(docs: DataFrame, labels: DataFrame, options: Ftrl | None = None, most: int = TRAINING_ROWS) -> np.ndarray:
    """Weights learned from ``doc_id, text`` and ``doc_id, label``.

    The ``most`` labelled ids with the smallest hashes are learned from, in
    the order of the hashes: a bounded sample that doesn't depend on how rows
    are partitioned. NULL labels are left out. Without labels, all weights are
    0 and every score is one half.
    """
    place = F.xxhash64("doc_id")
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    sample = known.withColumn("place", place).orderBy("place", "doc_id", "label").limit(most)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("place", "label", "text")
    table = chosen.mapInArrow(_training_features, "place long, label int, buckets array<int>, amounts array<float>").toArrow()
    # The learner reads the rows where Arrow holds them.
    rows = [
        (place_.as_py(), label.as_py(), buckets.values.to_numpy(), amounts.values.to_numpy())
        for place_, label, buckets, amounts in zip(*(table.column(c) for c in ("place", "label", "buckets", "amounts")), strict=True)
    ]
    rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
    return follow_the_leader([(index, value, label) for _, label, index, value in rows], options or Ftrl())


def score_quality(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs`` with a ``held_out`` column.

    A NULL or empty text is scored by the bias alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            scores = probabilities(texts_of(batch), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast("int64"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(predict, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier accepts."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            yield batch.filter(pa.array(probabilities(texts_of(batch), shared.value) >= 0.5))

    return docs.mapInArrow(accepted, docs.schema)
