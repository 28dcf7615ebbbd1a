"""Quality rules: text counts with fixed limits, and a calibrated n-gram logistic regression.

The counts are taken from whole texts: words, their code points, symbols, repeated
lines, and words inside five-word windows that occur more than once. Texts that
break a fixed limit fail. All others are judged by a logistic regression over
hashed word and character n-grams, trained on a bounded sample of labelled texts
(``PER_CLASS`` a class), calibrated on rows left out of each fold's fit, and
scored batch by batch against a fixed threshold.

A null or empty text has no words and fails. Repeated rows are judged alike.
Without labelled rows of both classes only the limits decide. An empty table gives
an empty result; extra columns are passed over.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.common import gram_hashes, text_buffers, word_hashes
from statforge.llm.hashed_text import Grams, Sample, calibrate, feature_sets, fitted, fold_of, probability

#: Labelled texts a class in the sample that the model is fitted on.
PER_CLASS = 2000
#: Rows of this fold are left for measuring.
FOLDS, HELD_OUT = 5, 0
#: Limits: least words, most percent of words in repeated windows, least probability of good quality.
MIN_WORDS, MAX_REPEAT_PERCENT, THRESHOLD = 10, 20, 0.5
WINDOW = 5
#: Fixed value: the characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
#: Ridge penalty, step size, passes over the sample.
PENALTY, RATE, PASSES = 1e-5, 0.1, 15
CALIBRATION_FOLDS = 3

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, probability double"

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def repeated_words(text: bytes, words: np.ndarray) -> int:
    """Words inside five-word windows that occur twice or more.

    Equal windows have equal hashes, so a text without equal hashes has none; the
    windows of other texts are compared word by word.
    """
    grams = gram_hashes(words, WINDOW)
    ordered = np.sort(grams)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    own = text.split()
    suspect = np.flatnonzero(np.isin(grams, ordered[1:][ordered[1:] == ordered[:-1]]))
    windows = [tuple(own[i : i + WINDOW]) for i in suspect]
    count = Counter(windows)
    covered = np.zeros(len(own) + 1, dtype=np.int64)
    for i, w in zip(suspect, windows, strict=True):
        if count[w] > 1:
            covered[i] += 1
            covered[i + WINDOW] -= 1
    return int((np.cumsum(covered)[:-1] > 0).sum())


def count_batch(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """``COUNTS`` of every text of a buffer."""
    hashes, bounds = word_hashes(raw, offsets, lower=False)
    out = []
    for i in range(len(offsets) - 1):
        text, words = raw[offsets[i] : offsets[i + 1]], hashes[bounds[i] : bounds[i + 1]]
        blank = (text == 0x20) | ((text >= 0x09) & (text <= 0x0D))
        chars = int(((text & 0xC0) != 0x80).sum() - blank.sum())
        data = text.tobytes()
        out.append((len(words), chars, int(_SYMBOL[text].sum()), duplicate_lines(data), repeated_words(data, words)))
    return out


@dataclass
class Model:
    weight: np.ndarray
    intercept: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, slots: np.ndarray) -> float:
        return self.intercept + (float(self.weight[slots].sum()) / np.sqrt(len(slots)) if len(slots) else 0.0)


def fit_margin(sample: Sample, width: int, seed: int = 6) -> Model:
    """Logistic regression by adaptive stochastic steps; rows are scaled to length one, classes to equal weight."""
    n1 = max(int(sample.label.sum()), 1)
    n0 = max(len(sample) - n1, 1)
    importance = np.where(sample.label == 1, 0.5 * len(sample) / n1, 0.5 * len(sample) / n0)
    weight, square = np.zeros(width), np.full(width, 1e-8)
    intercept, intercept_square = 0.0, 1e-8
    rng = np.random.Generator(np.random.PCG64(seed))
    for _ in range(PASSES):
        for i in rng.permutation(len(sample)):
            slots = sample.row(i)
            value = 1 / np.sqrt(max(len(slots), 1))
            margin = intercept + value * float(weight[slots].sum())
            pull = importance[i] * (1 / (1 + np.exp(-min(max(margin, -500.0), 500.0))) - sample.label[i])
            square[slots] += (pull * value) ** 2  # the slots of a row are distinct
            weight[slots] -= RATE * (pull * value / np.sqrt(square[slots]) + PENALTY * weight[slots])
            intercept_square += pull * pull
            intercept -= RATE * pull / np.sqrt(intercept_square)
    return Model(weight, float(intercept))


def fit(docs: DataFrame, labels: DataFrame, grams: Grams = Grams(), per_class: int = PER_CLASS) -> Model | None:
    """Fit on labelled rows outside the held-out fold, in one task; ``None`` without rows of both classes."""

    def learn(sample: Sample, sizes: dict[int, int]) -> Model | None:
        if len(set(sample.label.tolist())) < 2:
            return None
        fold = fold_of(len(sample), CALIBRATION_FOLDS, seed=4)
        margins = np.zeros(len(sample))
        for k in range(CALIBRATION_FOLDS):
            inner = fit_margin(sample.take(np.flatnonzero(fold != k)), grams.width)
            for i in np.flatnonzero(fold == k):
                margins[i] = inner.margin(sample.row(i))
        model = fit_margin(sample, grams.width)
        slope, offset = calibrate(margins, sample.label, sizes)
        return Model(model.weight.astype(np.float32), model.intercept, slope, offset)

    return fitted(docs, labels, grams, per_class, FOLDS, HELD_OUT, learn)


def judge(docs: DataFrame, model: Model | None, grams: Grams = Grams(), threshold: float = THRESHOLD) -> DataFrame:
    """The contract's columns for every document, and the model's probability."""
    weight = docs.sparkSession.sparkContext.broadcast(model.weight if model else None)  # one array of the hashed width
    numbers = (model.intercept, model.slope, model.offset) if model else (0.0, 1.0, 0.0)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if weight.value is None else Model(weight.value, *numbers)
        for b in batches:
            buffers = text_buffers(b.column(1))
            counts = np.array(count_batch(*buffers), dtype=np.int64).reshape(-1, len(COUNTS))
            failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])
            if own is None:
                p = np.ones(len(counts))
            else:
                p = probability(np.array([own.margin(s) for s in feature_sets(*buffers, grams)], dtype=float), own.slope, own.offset)
            columns = [b.column(0), *(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(failed), pa.array(~failed & (p >= threshold)), pa.array(p, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "base_failed", "kept", "probability"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(judged, SCHEMA)
