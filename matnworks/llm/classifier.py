"""Quality classifier: hashed word n-gram logistic regression trained with follow-the-regularised-leader.

Tokens are runs of letters, of digits and of other printable characters, case kept; features are hashed
single tokens, pairs, and a mark for a token that repeats the one before. A document is a vector of unit
length of damped counts. Every shard of the training rows is learned by the per-coordinate
follow-the-regularised-leader update, sparse by its L1 term, and the shards' weights are averaged. Scores are
sparse dot products over whole buffers.

At most about ``max_rows`` labelled rows train the model, chosen by a hash of their id: a documented bound.
Null or empty text: no features, scored by the intercept. Empty tables give no rows; without training rows
every score is 0.5. Repeated rows are scored one by one. Null labels do not train. Columns other than
``doc_id``, ``text`` and the label are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matnworks.llm.words import BASE, Texts, mix, slices

BITS = 18
SHARD_ROWS = 2_500
MAX_ROWS = 20_000
EPOCHS, LEAST_UPDATES = 4, 5_000
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.01, 0.0

LETTER, DIGIT, OTHER = 1, 2, 3
KIND = np.full(256, OTHER, np.uint8)
KIND[[0x20, *range(0x09, 0x0E)]] = 0
KIND[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = LETTER
KIND[0x80:] = LETTER
KIND[list(b"0123456789")] = DIGIT
REPEAT = 0

WEIGHTS = "feature int, weight double"
SCORES = "doc_id long, score double"


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, feature numbers and values of the nonzero entries, ordered by row and feature."""
    kind = KIND[texts.bytes]
    edge = np.zeros(len(kind) + 1, bool)
    edge[texts.bounds] = True
    change = np.ones(len(kind), bool)
    change[1:] = kind[1:] != kind[:-1]
    starts = np.flatnonzero(change | edge[:-1])
    ends = np.concatenate([starts[1:], [len(kind)]])[: len(starts)]
    token = kind[starts] > 0
    starts, ends = starts[token], ends[token]
    hashes = texts.hashes(starts, ends)
    rows = np.searchsorted(texts.bounds, starts, "right") - 1
    pairs = mix(hashes[:-1] * np.uint64(BASE) + hashes[1:])
    close = rows[:-1] == rows[1:] if len(rows) else np.zeros(0, bool)
    same = hashes[:-1] == hashes[1:] if len(rows) else np.zeros(0, bool)
    mask = np.uint64((1 << BITS) - 1)
    numbers = np.concatenate([hashes & mask, np.where(same, np.uint64(REPEAT), pairs & mask)[close]]).astype(np.int64)
    of = np.concatenate([rows, rows[1:][close]]) if len(rows) else rows
    keys, counts = np.unique((of << BITS) | numbers, return_counts=True)
    of, numbers = keys >> BITS, keys & ((1 << BITS) - 1)
    values = np.log1p(counts)
    norms = np.sqrt(np.bincount(of, values * values, texts.rows))
    return of, numbers, values / norms[of]


def logistic(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


class Leader:
    """Follow-the-regularised-leader state of one shard; the intercept is the last coordinate, unregularised by L1."""

    def __init__(self) -> None:
        size = (1 << BITS) + 1
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        pull = np.sign(z) * L1 - z
        return np.where(np.abs(z) <= L1, 0.0, pull / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(at)
        slope = (float(logistic(np.array(w @ values))) - label) * values
        n = self.n[at]
        square = slope * slope
        self.z[at] += slope - (np.sqrt(n + square) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + square


def train(rows: DataFrame, shards: int) -> np.ndarray:
    """Averaged weights from ``doc_id, text, label``, with the intercept last; one task learns each shard."""

    def fit(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by("doc_id")
        leader = Leader()
        examples = []
        for batch in slices(shard.combine_chunks().to_batches()):
            of, numbers, values = features(Texts(batch.column(batch.schema.get_field_index("text"))))
            bounds = np.searchsorted(of, np.arange(batch.num_rows + 1))
            labels = batch.column(batch.schema.get_field_index("label")).to_pylist()
            for i, label in enumerate(labels):
                a, b = bounds[i], bounds[i + 1]
                at, value = np.append(numbers[a:b], 1 << BITS), np.append(values[a:b], 1.0)
                examples.append((at.astype(np.int32), value.astype(np.float32), label))
        order = np.arange(len(examples))
        for epoch in range(max(EPOCHS, -(-LEAST_UPDATES // len(examples)))):
            np.random.default_rng(epoch).shuffle(order)
            for i in order:
                leader.learn(*examples[i])
        weights = leader.weights(slice(None))
        used = np.flatnonzero(weights)
        return pa.table({"feature": pa.array(used, pa.int32()), "weight": pa.array(weights[used])})

    labelled = rows.where("label IN (0, 1)").select("doc_id", "text", "label", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard"))
    parts = labelled.groupBy("shard").applyInArrow(fit, WEIGHTS).groupBy("feature").agg((F.sum("weight") / shards).alias("weight"))
    weights = np.zeros((1 << BITS) + 1)
    for feature, weight in parts.collect():  # at most one row per feature number, whatever the corpus
        weights[feature] = weight
    return weights


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> np.ndarray:
    """Weights learned from ``docs`` (``doc_id``, ``text``) and at most about ``max_rows`` rows of ``labels``
    (``doc_id``, ``label``), in shards of about ``SHARD_ROWS``."""
    total = max(1, labels.count())
    share = min(1.0, max_rows / total)
    chosen = labels.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by max_rows
    return train(rows, max(1, round(total * share / SHARD_ROWS)))


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, score`` for each row of ``docs`` (``doc_id``, ``text``)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in slices(batches):
            texts = Texts(batch.column(1))
            of, numbers, values = features(texts)
            margin = w[-1] + np.bincount(of, w[numbers] * values, texts.rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(logistic(margin))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, SCORES)
