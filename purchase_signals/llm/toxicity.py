"""Toxicity by a linear model over character n-grams scaled by naive Bayes ratios.

A text is lower-cased, its white space becomes single spaces (one at either end),
and its n-grams of 3 to 6 code points are hashed into ``2**BITS`` features that
count once a text. A feature is scaled by the logarithm of the ratio of its smoothed
document frequencies in the two classes; a logistic regression is fitted on the
scaled features (Wang and Manning, 2012).

The training sample is bounded by ``max_train`` labelled rows, taken in the order of
a hash of the id. Its frequencies are counted in Spark; the model has at most
``max_features`` features, so it is fitted in one task of bounded memory and sent
to all tasks. Scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import materialise
from .frames import map_arrow

BITS = 20
SIZES = (3, 4, 5, 6)
CHUNK = 1 << 16
_FACTOR, _SPREAD = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


class Model(NamedTuple):
    features: np.ndarray
    weights: np.ndarray
    bias: float


def _features(points: np.ndarray) -> Iterator[np.ndarray]:
    """Feature numbers of the n-grams of each size that begin at each code point."""
    state = np.zeros(len(points), dtype=np.uint32)
    for size in range(1, SIZES[-1] + 1):
        if len(points) < size:
            return
        state = state[: len(points) - size + 1] * _FACTOR + points[size - 1 :]
        if size in SIZES:
            spread = (state ^ (state >> np.uint32(15))) * _SPREAD
            yield (spread >> np.uint32(32 - BITS)).astype(np.int64)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def _chunks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of the normalised texts, about ``CHUNK`` together, and the text of each.

    A longer text comes in parts that overlap by one n-gram less a code point.
    """
    held: list[np.ndarray] = []
    owners: list[int] = []
    size = 0

    def out():
        return np.concatenate(held), np.repeat(np.array(owners, dtype=np.int64), [len(h) for h in held])

    for i, text in enumerate(texts):
        clean = f" {' '.join((text or '').lower().split())} \x00"
        points = np.frombuffer(clean.encode("utf-32-le"), dtype=np.uint32)
        step = CHUNK - SIZES[-1] + 1
        for start in range(0, max(1, len(points) - SIZES[-1] + 1), step):
            held.append(points[start : start + CHUNK])
            owners.append(i)
            size += len(held[-1])
            if size >= CHUNK:
                yield out()
                held, owners, size = [], [], 0
    if held:
        yield out()


def distinct_features(texts: list[str | None], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(text, feature)`` once for each text and each of its features where ``wanted`` holds."""
    found = [np.zeros(0, dtype=np.int64)]
    for points, owner in _chunks(texts):
        own = []
        for features in _features(points):
            at = np.flatnonzero(wanted[features])
            own.append((owner[at] << BITS) | features[at])
        found.append(_distinct(np.concatenate(own)) if own else found[0])
    both = _distinct(np.concatenate(found))
    return both >> BITS, both & ((1 << BITS) - 1)


def log_ratios(with_one, with_zero, ones: int, zeros: int):
    """Naive Bayes log-count ratios of document frequencies, smoothed by one."""
    return np.log((with_one + 1) / (ones + 2)) - np.log((with_zero + 1) / (zeros + 2))


def fit_weights(
    rows: np.ndarray, columns: np.ndarray, ratios: np.ndarray, labels: np.ndarray, rounds: int, penalty: float
) -> tuple[np.ndarray, float]:
    """Logistic regression on the scaled features by full gradients with adaptive steps.

    Returns the weights with the scale multiplied in, and the bias.
    """
    n, weights, bias = len(labels), np.zeros(len(ratios)), 0.0
    if n:
        share = np.clip(labels.mean(), 0.5 / n, 1 - 0.5 / n)
        bias = float(np.log(share / (1 - share)))
    seen, seen_bias = np.full(len(ratios), 1e-8), 1e-8
    values = ratios[columns]
    for _ in range(rounds if n else 0):
        margin = np.bincount(rows, weights[columns] * values, minlength=n) + bias
        error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - labels) / n
        slope = np.bincount(columns, error[rows] * values, minlength=len(ratios)) + penalty * weights
        seen += slope**2
        seen_bias += error.sum() ** 2
        weights -= 0.05 * slope / np.sqrt(seen)
        bias -= 0.05 * error.sum() / np.sqrt(seen_bias)
    return weights * ratios, bias


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    max_train: int = 8_000,
    max_features: int = 8_192,
    min_documents: int = 5,
    evidence: float = 4.0,
    rounds: int = 120,
    penalty: float = 1e-5,
) -> Model:
    """Fit on ``docs (doc_id, text)`` with ``labels (doc_id, label)``.

    Features whose log ratio is less than ``evidence`` standard errors from 0 are left
    out. Only labels of 0 and 1 count. Without labelled rows of both classes the model
    knows the share of ones (a half where there are none) and nothing else.
    """
    sample = (
        labels.where("doc_id is not null and label in (0, 1)")
        .dropDuplicates(["doc_id"])
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_train)
    )
    # At most max_train ids and labels are broadcast.
    rows = materialise(docs.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label"), "toxicity")
    counts = rows.groupBy("label").count().collect()
    ones = sum(r["count"] for r in counts if r["label"] == 1)
    zeros = sum(r["count"] for r in counts if r["label"] == 0)
    nothing = np.zeros(0)
    if not ones or not zeros:
        share = (ones + 0.5) / (ones + zeros + 1)
        return Model(nothing.astype(np.int64), nothing, float(np.log(share / (1 - share))))

    def frequencies(batches):
        seen = np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in batches:
            label = np.asarray(batch.column("label"))
            text, feature = distinct_features(batch.column("text").to_pylist(), np.ones(1 << BITS, bool))
            for side in (0, 1):
                seen[side] += np.bincount(feature[label[text] == side], minlength=1 << BITS)
        feature = np.flatnonzero(seen.sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(feature), pa.array(seen[1, feature]), pa.array(seen[0, feature])],
            ["feature", "ones", "zeros"],
        )

    ratio = (
        F.log((F.col("ones") + 1) / (ones + 2)) - F.log((F.col("zeros") + 1) / (zeros + 2))
    )
    # max_features rows come to the driver.
    best = (
        rows.select("label", "text")
        .mapInArrow(frequencies, "feature long, ones long, zeros long")
        .groupBy("feature")
        .agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
        .where(F.col("ones") + F.col("zeros") >= min_documents)
        .withColumn("evidence", F.abs(ratio) / F.sqrt(1 / (F.col("ones") + 1) + 1 / (F.col("zeros") + 1)))
        .where(F.col("evidence") >= evidence)
        .orderBy(F.desc("evidence"), "feature")
        .limit(max_features)
        .collect()
    )
    features = np.array(sorted(r["feature"] for r in best), dtype=np.int64)
    by_feature = {r["feature"]: (r["ones"], r["zeros"]) for r in best}
    seen = np.array([by_feature[f] for f in features.tolist()]).reshape(-1, 2)
    ratios = log_ratios(seen[:, 0], seen[:, 1], ones, zeros)

    def gather(batch: pa.RecordBatch) -> pa.RecordBatch:
        wanted = np.zeros(1 << BITS, bool)
        wanted[features] = True
        text, feature = distinct_features(batch.column("text").to_pylist(), wanted)
        ends = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
        columns = np.searchsorted(features, feature).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("label").cast(pa.int32()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(columns)),
            ],
            ["doc_id", "label", "columns"],
        )

    def fit(batches):
        found = list(batches)
        label = np.concatenate([np.asarray(b.column("label")) for b in found])
        lengths = np.concatenate([np.diff(np.asarray(b.column("columns").offsets)) for b in found])
        columns = np.concatenate([np.asarray(b.column("columns").flatten()) for b in found])
        owner = np.repeat(np.arange(len(label)), lengths)
        weights, bias = fit_weights(owner, columns, ratios, label, rounds, penalty)
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.tobytes()]), pa.array([bias])], ["weights", "bias"]
        )

    gathered = map_arrow(rows, gather, "doc_id long, label int, columns array<int>")
    fitted = (
        gathered.repartition(1)
        .sortWithinPartitions("doc_id")
        .mapInArrow(fit, "weights binary, bias double")
        .first()
    )
    return Model(features, np.frombuffer(fitted["weights"]), fitted["bias"])


def _judge(model: Model):
    """A function from a column of texts to their scores."""
    wanted, weights = np.zeros(1 << BITS, bool), np.zeros(1 << BITS)
    wanted[model.features] = True
    weights[model.features] = model.weights

    def judge(texts: pa.Array) -> np.ndarray:
        text, feature = distinct_features(texts.to_pylist(), wanted)
        margin = np.bincount(text, weights[feature], minlength=len(texts)) + model.bias
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))

    return judge


def score(docs: DataFrame, model: Model, *, threshold: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted`` of every row of ``docs (doc_id, text)``."""

    def scored(batches):
        judge = _judge(model)
        for batch in batches:
            chance = judge(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(chance), pa.array((chance >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return docs.mapInArrow(scored, "doc_id long, score double, predicted int")


def without_toxic(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    threshold: float = 0.7,
    **options,
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns and no shuffle.

    Trained on all of ``labels``; nulls, empty texts and repeated rows as in ``toxicity``.
    """
    marks = labels.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")
    )
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    model = train(texts, marks, **options)

    def clean(batches):
        judge = _judge(model)
        for batch in batches:
            yield batch.filter(pa.array(judge(batch.column(text)) < threshold))

    return docs.mapInArrow(clean, docs.schema)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    train_on=None,
    threshold: float = 0.7,
    **options,
) -> DataFrame:
    """Train on the labelled rows where ``train_on`` (a condition) holds and score all rows.

    Returns ``doc_id, score, predicted``, a row for each row of ``docs``, repeated
    ones too. A null text scores as an empty one, which has no features. Labels that
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
