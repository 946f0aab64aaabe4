"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct buckets of its single words, word pairs, pairs with one word between them, and
the first and last letters of words. Each coordinate has its own learning rate and L1 sets most weights to zero (McMahan
et al. 2013), so the model is a short list of (bucket, weight) that goes to every task."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sampled_labels, schema_with
from tidemark.llm.kernels import SPACE, mix, text_bytes, word_hashes

BITS = 22
#: Labelled rows of each class that the model is fitted on, about.
SAMPLE_ROWS = 6_000
#: Texts of a sample weigh at most this much together; later rows are left out of the fit.
SAMPLE_BYTES = 48_000_000
PREFIX = 5


def _trimmed(data: np.ndarray) -> np.ndarray:
    """ASCII punctuation at either end of words counts as white space; inside words it stays."""
    mark = np.zeros(256, bool)
    mark[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
    out = data.copy()
    blank = SPACE[data]
    soft = mark[data]
    size = len(data)
    if not size:
        return out
    # runs of marks that touch white space or an end
    step = np.flatnonzero(soft)
    if not len(step):
        return out
    starts = step[np.concatenate([[True], step[1:] != step[:-1] + 1])]
    ends = step[np.concatenate([step[1:] != step[:-1] + 1, [True]])] + 1
    edge = (starts == 0) | blank[np.maximum(starts - 1, 0)] | (ends == size) | blank[np.minimum(ends, size - 1)]
    fill = np.zeros(size + 1, np.int32)
    fill[starts[edge]] = 1
    fill[ends[edge]] -= 1
    out[np.cumsum(fill[:-1]) > 0] = 32
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of all feature occurrences."""
    data = _trimmed(data)
    words, at, starts, ends = word_hashes(data, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    stems, _, _, _ = _affixes(data, starts, ends)
    parts, rows = [mix(words + np.uint64(1)), stems], [row, row]
    for gap in (1, 2):
        if len(words) > gap:
            same = row[gap:] == row[:-gap]
            parts.append(mix(words[:-gap] * np.uint64(3) + words[gap:] * np.uint64(7) + np.uint64(gap))[same])
            rows.append(row[:-gap][same])
    return np.concatenate(rows), (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)


def _affixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash of the first PREFIX bytes, lower-cased, of every word."""
    lower = np.arange(256, dtype=np.uint64)
    lower[65:91] += np.uint64(32)
    key = np.zeros(len(starts), np.uint64)
    for k in range(PREFIX):
        at = starts + k
        byte = np.where(at < ends, lower[data[np.minimum(at, max(len(data) - 1, 0))]] if len(data) else 0, 0).astype(np.uint64)
        key = key * np.uint64(257) + byte
    return mix(key + np.uint64(1 << 60)), key, starts, ends


@dataclass(frozen=True)
class Model:
    """Sparse weights by bucket, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[self.buckets] = self.weights
        return self._score(table, data, offsets)

    def _score(self, table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, bucket = features(data, offsets)
        weight = table[bucket]
        heavy = np.flatnonzero(weight)
        pair = np.unique(row[heavy].astype(np.int64) << BITS | bucket[heavy])
        odds = np.full(len(offsets) - 1, self.bias)
        np.add.at(odds, pair >> BITS, table[pair & ((1 << BITS) - 1)])
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def fit(texts: list[str], labels: list[int], epochs: int = 6, alpha: float = 1.0, beta: float = 1.0, l1: float = 3.0, l2: float = 0.0) -> Model:
    """FTRL-proximal over the texts in the given order, a few times. No texts: a model that gives 0.5."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = bias = 0.0
    rows = []
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        rows.append(np.unique(features(data, np.array([0, len(data)]))[1]).astype(np.int32))
    for _ in range(epochs):
        for x, y in zip(rows, labels, strict=True):
            zx, nx = z[x], n[x]
            w = np.where(np.abs(zx) <= l1, 0.0, -(zx - np.sign(zx) * l1) / ((beta + np.sqrt(nx)) / alpha + l2))
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -50, 50)))
            g = p - y
            sigma = (np.sqrt(nx + g * g) - np.sqrt(nx)) / alpha
            z[x] = zx + g - sigma * w
            n[x] = nx + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / alpha * bias
            bias_n += g * g
            bias = -bias_z / ((beta + np.sqrt(bias_n)) / alpha)
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    used = np.flatnonzero(w)
    return Model(used.astype(np.int32), w[used].astype(np.float32), float(bias))


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id") -> Model:
    """Fit on a bounded sample of the labelled documents: about SAMPLE_ROWS of each class and at most SAMPLE_BYTES of text.

    Rows are chosen and ordered by a hash of their key; rows without a label are left out; a null text is empty. Scores
    refer to the sample's share of classes, which is more even than that of the labels."""
    chosen, _ = sampled_labels(labels, label, SAMPLE_ROWS, key)
    rows = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), key)
    sample = rows.select("text", F.col(label).alias("y"), F.xxhash64(F.col(key).cast("string")).alias("h")).toPandas().sort_values(["h", "text"])
    sample = sample[sample["text"].str.len().cumsum() <= SAMPLE_BYTES]
    return fit(sample["text"].tolist(), sample["y"].tolist())


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with score (0 to 1) of every whole text; empty and null texts get the intercept's. Other columns stay."""
    kept = docs.drop("score")
    at, columns = kept.columns.index(text), kept.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        table = np.zeros(1 << BITS, np.float32)
        table[own.buckets] = own.weights
        for whole in batches:
            for begin in range(0, len(whole), 500):
                batch = whole.slice(begin, 500)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own._score(table, *text_bytes(batch.column(at))))], [*columns, "score"])

    return kept.mapInArrow(run, schema_with(kept, ("score", "double")))
