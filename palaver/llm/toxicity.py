"""Toxicity classifier: FTRL-proximal logistic regression over hashed n-grams.

Features are words, pairs of neighbours and pairs with one word between
(lower-cased runs of letters and digits), hashed to ``2 ** BITS`` coordinates, each
present or not.  Every coordinate has its own learning rate, and the L1 term
leaves most weights at exactly zero, so the model is an array of a few thousand
places and weights, at most ``2 ** BITS``, which bounds what is sent to the tasks.

Training takes at most ``max_rows`` labelled rows, those of the smallest id hash;
scoring covers every whole text.  NULL and empty texts have no feature and get the
score of the bias.  Without a labelled row the score is that of ``START_BIAS``.
Rows with a NULL label or NULL id teach nothing; if ids repeat in the labels, the
largest label counts.  Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import ALNUM, LOWER, ODD, Words, map_slices, mix, slices, utf8

BITS = 20
START_BIAS = -3.0
FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_SKIP = np.uint64(0x165667B19E3779F9)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and coordinate of every feature, with repeats."""
    words = Words(data, offsets, ALNUM, LOWER)
    docs, places = [words.doc], [words.hashes.copy()]
    for gap, salt in ((1, _PAIR), (2, _SKIP)):
        size = max(len(words.hashes) - gap, 0)
        same = words.doc[:size] == words.doc[gap:]
        docs.append(words.doc[:size][same])
        places.append(mix((words.hashes[:size] * salt + words.hashes[gap:] * ODD)[same]))
    mask = np.uint64((1 << BITS) - 1)
    return np.concatenate(docs), (np.concatenate(places) & mask).astype(np.int32)


@dataclass
class Ftrl:
    """Per-coordinate FTRL-proximal state; coordinate ``2 ** BITS`` is the bias."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 10.0
    l2: float = 1.0

    def __post_init__(self):
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)
        self.z[-1] = -START_BIAS * self.beta / self.alpha

    def weights(self, at=slice(None)) -> np.ndarray:
        z, rate = self.z[at], (self.beta + np.sqrt(self.n[at])) / self.alpha
        w = -(z - np.sign(z) * self.l1) / (rate + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def bias(self) -> float:
        return float(-self.z[-1] / ((self.beta + np.sqrt(self.n[-1])) / self.alpha))

    def learn(self, at: np.ndarray, label: int) -> None:
        w, bias = self.weights(at), self.bias()
        p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -30, 30)))
        gradient = p - label
        at, w = np.append(at, 1 << BITS), np.append(w, bias)
        before = self.n[at]
        after = before + gradient * gradient
        self.z[at] += gradient - (np.sqrt(after) - np.sqrt(before)) / self.alpha * w
        self.n[at] = after


@dataclass(frozen=True)
class Model:
    places: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        size = len(offsets) - 1
        dense = np.zeros(1 << BITS)
        dense[self.places] = self.weights
        doc, at = features(data, offsets)
        used = dense[at] != 0
        once = np.unique(doc[used] << BITS | at[used])
        total = np.bincount(once >> BITS, dense[once & ((1 << BITS) - 1)], size)
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -30, 30)))


def training_rows(docs: DataFrame, labels: DataFrame, allowed: Column, doc_id: str, text: str,
                  label: str, max_rows: int) -> DataFrame:
    """Id hash, label and text of at most ``max_rows`` labelled rows."""
    chosen = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & allowed)
              .groupBy(doc_id).agg(F.max(label).cast("int").alias("label"))
              .withColumn("draw", F.xxhash64(doc_id))
              .orderBy("draw", doc_id).limit(max_rows))
    # At most max_rows lean rows are broadcast.
    texts = docs.select(doc_id, utf8(text).alias("text"))
    return texts.join(F.broadcast(chosen), doc_id).select("draw", "label", "text")


def train(rows: DataFrame, epochs: int = 6, **settings: float) -> Model:
    """Fit on a bounded table of ``draw, label, text``.

    Texts become coordinates where they lie; only the bounded rows then meet in one
    task, which learns from them in the order of their draw.
    """
    def to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(2)):
                doc, at = features(data, offsets)
                once = np.unique(doc << BITS | at)
                found = np.searchsorted(once >> BITS, np.arange(end - row + 1))
                lists = pa.ListArray.from_arrays(
                    pa.array(found, pa.int32()),
                    pa.array((once & ((1 << BITS) - 1)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [c.slice(row, end - row) for c in batch.columns[:2]] + [lists],
                    names=["draw", "label", "at"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            values = batch.column(2).flatten().to_numpy()
            ends = np.cumsum(batch.column(2).value_lengths().to_numpy())[:-1]
            examples += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                            np.split(values, ends))
        if not examples:
            return
        examples.sort(key=lambda e: e[0])
        model = Ftrl(**settings)
        for _ in range(epochs):
            for _, label, at in examples:
                model.learn(at, label)
        w = model.weights(slice(0, 1 << BITS))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array([at.astype(np.int32)], pa.list_(pa.int32())), pa.array([w[at]]),
             pa.array([model.bias()])], names=["places", "weights", "bias"])

    learned = (rows.mapInArrow(to_features, "draw long, label int, at array<int>").repartition(1)
               .mapInArrow(fit, "places array<int>, weights array<double>, bias double").first())
    if learned is None:
        return Model(np.zeros(0, np.int32), np.zeros(0), START_BIAS)
    return Model(np.array(learned.places, np.int32), np.array(learned.weights), learned.bias)


def with_scores(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
                threshold: float = 0.3) -> DataFrame:
    """``docs`` (or its columns ``keep``) with a score and a prediction."""
    def work(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        score = model.score(data, offsets)
        return [score, (score >= threshold).astype(np.int32)]

    return map_slices(docs, text, docs.columns if keep is None else keep, FIELDS, work)
