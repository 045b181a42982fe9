"""Text quality by a hashed word n-gram model trained with FTRL-proximal updates.

A word is a run of letters and digits or a run of other signs, in its own case. Single
words and pairs of neighbours are hashed into ``2**BITS`` features; a text is the
vector of the logarithms of their counts, scaled to length one. A logistic
regression is fitted one text at a time by follow-the-regularised-leader updates
(McMahan et al., 2013), which keep weights of no use at zero; a score is the logistic
of a sparse dot product.

The training sample is bounded by ``max_train`` labelled rows, taken in the order of
a hash of the id; it is turned into vectors in parallel and fitted in one task of
bounded memory. Scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import materialise
from . import hashing
from .frames import map_arrow

BITS = 20
_MASK = (1 << BITS) - 1


class Model(NamedTuple):
    features: np.ndarray
    weights: np.ndarray
    bias: float


def _kinds() -> np.ndarray:
    """0 white space, 1 letters, digits and all beyond ASCII, 2 other signs."""
    kinds = np.full(256, 2, dtype=np.uint8)
    for code in range(128):
        if chr(code).isalnum():
            kinds[code] = 1
    kinds[128:] = 1
    kinds[list(hashing.SPACES)] = 0
    return kinds


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, feature, value)`` of all texts of a column, by text and feature."""
    hashes, starts = hashing.words_by_text(column, _kinds())
    text = np.repeat(np.arange(len(column)), np.diff(starts))
    pair = hashing.mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
    joined = text[:-1] == text[1:]
    owner = np.concatenate([text, text[:-1][joined]]) << BITS
    feature = np.concatenate([hashes, pair[joined]]) >> np.uint64(64 - BITS)
    both = np.sort(owner | feature.astype(np.int64))
    first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else both
    value = np.log1p(np.diff(np.append(first, len(both))))
    both = both[first]
    text = both >> BITS
    length = np.sqrt(np.bincount(text, value**2, minlength=len(column)))
    return text, both & _MASK, value / length[text]


def ftrl(
    examples: list[tuple[np.ndarray, np.ndarray, int]],
    *,
    passes: int,
    alpha: float,
    beta: float,
    l1: float,
    l2: float,
) -> tuple[np.ndarray, float]:
    """Weights of all features and the bias after ``passes`` over the examples in order."""
    z, n, bias_z, bias_n, bias = np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0, 0.0

    def weight(z, n):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(passes):
        for feature, value, label in examples:
            own = weight(z[feature], n[feature])
            bias = -bias_z / ((beta + bias_n**0.5) / alpha)
            error = 1 / (1 + np.exp(-np.clip(own @ value + bias, -50, 50))) - label
            slope = error * value
            step = (np.sqrt(n[feature] + slope**2) - np.sqrt(n[feature])) / alpha
            z[feature] += slope - step * own
            n[feature] += slope**2
            bias_z += error - ((bias_n + error**2) ** 0.5 - bias_n**0.5) / alpha * bias
            bias_n += error**2
    return weight(z, n), bias


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    max_train: int = 8_000,
    passes: int = 10,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 0.5,
    l2: float = 0.1,
) -> Model:
    """Fit on ``docs (doc_id, text)`` with ``labels (doc_id, label)``.

    Only labels of 0 and 1 count. Without labelled rows all texts score a half.
    """
    sample = (
        labels.where("doc_id is not null and label in (0, 1)")
        .dropDuplicates(["doc_id"])
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_train)
    )
    # At most max_train ids and labels are broadcast.
    rows = docs.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label")

    def gather(batch: pa.RecordBatch) -> pa.RecordBatch:
        text, feature, value = vectors(batch.column("text"))
        ends = pa.array(np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("label").cast(pa.int32()),
                pa.ListArray.from_arrays(ends, pa.array(feature.astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(value.astype(np.float32))),
            ],
            ["doc_id", "label", "features", "vals"],
        )

    def fit(batches):
        examples = []
        for batch in batches:
            places = np.asarray(batch.column("features").offsets)
            feature = np.asarray(batch.column("features").flatten())
            value = np.asarray(batch.column("vals").flatten())
            places = places - places[0]
            for i, label in enumerate(batch.column("label").to_pylist()):
                own = slice(places[i], places[i + 1])
                examples.append((feature[own], value[own].astype(float), label))
        weights, bias = ftrl(examples, passes=passes, alpha=alpha, beta=beta, l1=l1, l2=l2)
        kept = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array([kept.tobytes()]), pa.array([weights[kept].tobytes()]), pa.array([float(bias)])],
            ["features", "weights", "bias"],
        )

    gathered = materialise(
        map_arrow(rows, gather, "doc_id long, label int, features array<int>, vals array<float>"), "quality"
    )
    fitted = (
        gathered.repartition(1)
        .sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "label")
        .mapInArrow(fit, "features binary, weights binary, bias double")
        .first()
    )
    if fitted is None:
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0)
    return Model(np.frombuffer(fitted["features"], np.int64), np.frombuffer(fitted["weights"]), fitted["bias"])


def score(docs: DataFrame, model: Model, *, threshold: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted`` of every row of ``docs (doc_id, text)``."""

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        weights = np.zeros(1 << BITS)
        weights[model.features] = model.weights
        text, feature, value = vectors(batch.column("text"))
        margin = np.bincount(text, weights[feature] * value, minlength=batch.num_rows) + model.bias
        chance = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(chance), pa.array((chance >= threshold).astype(np.int32))],
            ["doc_id", "score", "predicted"],
        )

    return map_arrow(docs, scored, "doc_id long, score double, predicted int")


def quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    train_on=None,
    threshold: float = 0.7,
    **options,
) -> DataFrame:
    """Train on the labelled rows where ``train_on`` (a condition) holds and score all rows.

    Returns ``doc_id, score, predicted``, a row for each row of ``docs``, repeated
    ones too. A null text scores as an empty one, by the bias alone. Labels that
    repeat an id count once; null ids are scored but never trained on. ``options`` go
    to ``train``. Further columns are passed over.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    marks = labels.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")
    )
    if train_on is not None:
        marks = marks.where(train_on)
    return score(texts, train(texts, marks, **options), threshold=threshold)
