"""Hashed word and character n-gram indicators, and bounded samples of labelled rows."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.common import crc_bucket, gram_hashes, mix, text_buffers, word_hashes

#: Bytes whose character n-grams are hashed at a time.
CHAR_PIECE = 1 << 20


@dataclass(frozen=True)
class Grams:
    """Which n-grams become features, and the width of the hashed space."""

    words: tuple[int, ...] = (1, 2)
    chars: tuple[int, ...] = (2, 3, 4)
    repeats: tuple[int, ...] = (1, 2, 3, 4, 5, 6)
    bits: int = 18

    @property
    def width(self) -> int:
        return 1 << self.bits


_MULT = np.random.Generator(np.random.PCG64(11)).integers(0, 2**32, size=(16, 256), dtype=np.uint64).astype(np.uint32)


def _char_slots(raw: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Slot of every run of ``n`` bytes: table values per place, mixed, top bits kept."""
    if len(raw) < n:
        return np.zeros(0, np.uint32)
    h = _MULT[0][raw[: len(raw) - n + 1]].copy()
    for k in range(1, n):
        h ^= _MULT[k][raw[k : len(raw) - n + 1 + k]]
    h *= np.uint32(0x9E3779B1)
    h ^= np.uint32(n * 0x85EBCA6B % 2**32)
    return h >> np.uint32(32 - bits)


def _repeat_codes(words: np.ndarray) -> np.ndarray:
    """For each word, how far back the same word stands (1 to 4), or 0: word repetition free of the words."""
    codes = np.zeros(len(words), np.uint64)
    for d in (4, 3, 2, 1):
        codes[d:][words[d:] == words[:-d]] = d
    return codes


def _repeat_slots(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Slots of the runs of ``n`` repeat codes with a repeat in them."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(codes) - n + 1, np.uint64)
    for k in range(n):
        h = h * np.uint64(5) + codes[k : len(codes) - n + 1 + k]
    return mix(h[h > 0] + np.uint64(n << 40)) >> np.uint64(64 - bits)


def feature_sets(raw: np.ndarray, offsets: np.ndarray, grams: Grams) -> Iterator[np.ndarray]:
    """The sorted distinct feature slots of every text of a buffer."""
    words, bounds = word_hashes(raw, offsets, lower=False)
    seen = np.zeros(grams.width, dtype=bool)
    shift = np.uint64(64 - grams.bits)
    for i in range(len(offsets) - 1):
        text, own = raw[offsets[i] : offsets[i + 1]], words[bounds[i] : bounds[i + 1]]
        for n in grams.words:
            seen[(own if n == 1 else gram_hashes(own, n)) >> shift] = True
        codes = _repeat_codes(own)
        for n in grams.repeats:
            seen[_repeat_slots(codes, n, grams.bits)] = True
        for at in range(0, len(text), CHAR_PIECE):
            for n in grams.chars:
                seen[_char_slots(text[at : at + CHAR_PIECE + n - 1], n, grams.bits)] = True
        slots = np.flatnonzero(seen)
        seen[slots] = False
        yield slots.astype(np.int32)


def labelled_ids(labels: DataFrame, label_col: str, per_class: int, folds: int, held_out: int) -> tuple[DataFrame, dict[int, int]]:
    """A bounded sample of labelled ids outside the held-out fold, and the class sizes.

    At most ``per_class`` ids of each class, the first by a hash of the id, so the
    sample depends on no layout. Ids with two labels take the larger one.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .where(crc_bucket(F.col("doc_id"), folds) != held_out)
    )
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    picks = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    return picks[0].unionByName(picks[1]), sizes


@dataclass
class Sample:
    """Features of the sampled rows as one concatenated index array."""

    slots: np.ndarray
    bounds: np.ndarray
    label: np.ndarray

    def row(self, i: int) -> np.ndarray:
        return self.slots[self.bounds[i] : self.bounds[i + 1]]

    def __len__(self) -> int:
        return len(self.label)

    def take(self, rows: np.ndarray) -> Sample:
        parts = [self.row(i) for i in rows]
        return Sample(np.concatenate(parts) if parts else np.zeros(0, np.int32), np.cumsum([0, *map(len, parts)]), self.label[rows])


def fitted(docs: DataFrame, labels: DataFrame, grams: Grams, per_class: int, folds: int, held_out: int, learn: Callable[[Sample, dict[int, int]], Any], label_col: str = "quality") -> Any:
    """What ``learn`` makes of a bounded sample of labelled texts, in the order of their ids, and of the classes' sizes.

    The sampled ids are at most ``2 * per_class`` rows, so they are broadcast and
    the texts are read in place. The feature sets of the sampled texts meet in one
    task, which learns; only what it has learnt reaches the driver.
    """
    ids, sizes = labelled_ids(labels, label_col, per_class, folds, held_out)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).join(F.broadcast(ids), "doc_id")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [s.tobytes() for s in feature_sets(*text_buffers(b.column(1)), grams)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(sets, pa.binary())], names=["doc_id", "label", "slots"])

    def learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((i, s, y) for b in batches for i, y, s in zip(*(c.to_pylist() for c in b.columns), strict=True))
        parts = [np.frombuffer(s, np.int32) for _, s, _ in rows]
        sample = Sample(np.concatenate(parts) if parts else np.zeros(0, np.int32), np.cumsum([0, *map(len, parts)]), np.array([y for _, _, y in rows], dtype=np.int64))
        del rows, parts
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(learn(sample, sizes))], pa.binary())], names=["model"])

    features = rows.select("doc_id", "text", "label").mapInArrow(featured, "doc_id long, label int, slots binary")
    got = features.repartition(1).mapInArrow(learnt, "model binary").collect()  # one task of at most 2 * per_class rows
    if got:
        return pickle.loads(got[0]["model"])
    return learn(Sample(np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, np.int64)), sizes)


def fold_of(n: int, folds: int, seed: int) -> np.ndarray:
    """A balanced random fold number for each of ``n`` rows."""
    return np.random.Generator(np.random.PCG64(seed)).permutation(np.arange(n) % folds)


def calibrate(margin: np.ndarray, label: np.ndarray, sizes: dict[int, int]) -> tuple[float, float]:
    """Slope and offset of the sigmoid that turns margins into probabilities (Newton steps).

    Rows are weighted so that the sample's classes count as in all labelled rows;
    targets are smoothed by one row a class, so a perfect split stays finite.
    """
    n1, n0 = int(label.sum()), int((1 - label).sum())
    if not n0 or not n1:
        return 1.0, float(np.log((n1 + 1.0) / (n0 + 1.0)))
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(label == 1, sizes[1] / n1, sizes[0] / n0)
    weight = weight / weight.mean()
    scale = max(float(np.abs(margin).mean()), 1e-9)
    x = np.stack([margin / scale, np.ones(len(margin))])
    ab = np.array([1.0, 0.0])
    loss = lambda v: float((weight * (np.logaddexp(0, v @ x) - target * (v @ x))).sum())
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(ab @ x, -500, 500)))
        grad = x @ (weight * (p - target))
        hess = (x * (weight * p * (1 - p))) @ x.T + 1e-9 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        t = 1.0
        while t > 1e-6 and loss(ab - t * step) > loss(ab):
            t /= 2
        ab = ab - t * step
        if np.abs(t * step).max() < 1e-9:
            break
    return max(float(ab[0]) / scale, 1e-9), float(ab[1])


def probability(margin: np.ndarray, slope: float, offset: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * margin + offset, -500, 500)))
