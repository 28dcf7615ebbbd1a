"""Quality classifier: naive Bayes support vectors over n-gram indicators.

Each n-gram indicator is scaled by the log of its class count ratio; a linear
hinge-loss model on the scaled, length-normalised indicators is fitted by dual
coordinate descent; margins of rows left out of each fold's fit are turned into
probabilities by a sigmoid. The fit uses a bounded sample of labelled texts
(``PER_CLASS`` a class, the first by a hash of the id); every document is scored,
over its whole text.

A null or empty text has no features and scores what the offset alone gives.
Repeated rows score alike. Without labelled rows of both classes the model says
the classes' share (one half without any labels). An empty table gives an empty
result; extra columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.common import crc_bucket, text_buffers
from statforge.llm.hashed_text import Grams, Sample, calibrate, feature_sets, fitted, fold_of, probability

#: Labelled texts a class in the sample that the model is fitted on.
PER_CLASS = 2000
#: The fold rule: rows whose id hashes to ``HELD_OUT`` of ``FOLDS`` are never learnt from.
FOLDS, HELD_OUT = 5, 0
#: A text is predicted good from this probability on.
THRESHOLD = 0.3
#: Penalty of a margin violation, passes over the sample, smoothing of counts.
COST, PASSES, ALPHA = 1.0, 12, 1.0
CALIBRATION_FOLDS = 3

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


@dataclass
class Model:
    """Weight of each slot (ratio times normal), squared ratio, intercept, sigmoid."""

    weight: np.ndarray
    square: np.ndarray
    intercept: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, slots: np.ndarray) -> float:
        norm = np.sqrt(self.square[slots].sum())
        return self.intercept + (float(self.weight[slots].sum()) / norm if norm > 0 else 0.0)


def log_count_ratios(sample: Sample, width: int) -> np.ndarray:
    """Log of the smoothed share of good rows with a feature over that of the others."""
    good = np.repeat(sample.label, np.diff(sample.bounds)).astype(float)
    p = ALPHA + np.bincount(sample.slots, weights=good, minlength=width)
    q = ALPHA + np.bincount(sample.slots, weights=1 - good, minlength=width)
    n1, n0 = sample.label.sum(), (1 - sample.label).sum()
    return np.log(p / (n1 + 2 * ALPHA)) - np.log(q / (n0 + 2 * ALPHA))


def fit_margin(sample: Sample, width: int, seed: int = 5) -> Model:
    """Dual coordinate descent for the hinge loss, one coordinate a row."""
    ratio = log_count_ratios(sample, width)
    y = np.where(sample.label == 1, 1.0, -1.0)
    rows = []
    for i in range(len(sample)):
        v = ratio[sample.row(i)].astype(np.float32)
        n = np.sqrt((v * v).sum())
        rows.append(v / n if n > 0 else v)
    diag = np.array([float(v @ v) + 1.0 for v in rows], dtype=float)  # the intercept is a feature of value one
    normal, intercept, dual = np.zeros(width), 0.0, np.zeros(len(sample))
    rng = np.random.Generator(np.random.PCG64(seed))
    for _ in range(PASSES):
        moved = 0.0
        for i in rng.permutation(len(sample)):
            slots, v = sample.row(i), rows[i]
            gradient = y[i] * (normal[slots] @ v + intercept) - 1.0
            new = min(max(dual[i] - gradient / diag[i], 0.0), COST)
            if new != dual[i]:
                step = (new - dual[i]) * y[i]
                normal[slots] += step * v  # the slots of a row are distinct
                intercept += step
                moved = max(moved, abs(new - dual[i]))
                dual[i] = new
        if moved < 1e-4:
            break
    return Model(normal * ratio, ratio * ratio, intercept)


def fit(docs: DataFrame, labels: DataFrame, grams: Grams = Grams(), per_class: int = PER_CLASS) -> Model:
    """Fit on the labelled rows outside the held-out fold, in one task."""

    def learn(sample: Sample, sizes: dict[int, int]) -> Model:
        if len(set(sample.label.tolist())) < 2:
            n1 = int(sample.label.sum())
            share = np.log((n1 + 1.0) / (len(sample) - n1 + 1.0))
            return Model(np.zeros(grams.width, np.float32), np.zeros(grams.width, np.float32), 0.0, 1.0, float(share))
        fold = fold_of(len(sample), CALIBRATION_FOLDS, seed=3)
        margins = np.zeros(len(sample))
        for k in range(CALIBRATION_FOLDS):
            inner = fit_margin(sample.take(np.flatnonzero(fold != k)), grams.width)
            for i in np.flatnonzero(fold == k):
                margins[i] = inner.margin(sample.row(i))
        model = fit_margin(sample, grams.width)
        slope, offset = calibrate(margins, sample.label, sizes)
        return Model(model.weight.astype(np.float32), model.square.astype(np.float32), model.intercept, slope, offset)

    return fitted(docs, labels, grams, per_class, FOLDS, HELD_OUT, learn)


def score(docs: DataFrame, model: Model, grams: Grams = Grams(), threshold: float = THRESHOLD) -> DataFrame:
    """The contract's columns for every document."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((model.weight, model.square))  # two arrays of the hashed width
    intercept, slope, offset = model.intercept, model.slope, model.offset

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, square = shared.value
        own = Model(weight, square, intercept)
        for b in batches:
            margins = np.array([own.margin(s) for s in feature_sets(*text_buffers(b.column(2)), grams)], dtype=float)
            p = probability(margins, slope, offset)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (crc_bucket(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        F.col("text").alias("text"),
    )
    return rows.mapInArrow(scored, SCHEMA)


def filtered(docs: DataFrame, model: Model, grams: Grams = Grams(), threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the model predicts good, in place: no text is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.square))
    intercept, slope, offset = model.intercept, model.slope, model.offset
    at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value, intercept)
        for b in batches:
            margins = np.array([own.margin(s) for s in feature_sets(*text_buffers(b.column(at)), grams)], dtype=float)
            yield b.filter(pa.array(probability(margins, slope, offset) >= threshold))

    return docs.mapInArrow(kept, docs.schema)
