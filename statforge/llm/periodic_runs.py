"""Maximal periodic runs of words, by a branching-tandem test on enhanced suffix arrays.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart
are identical), at least two periods and ``LEAST_LENGTH`` words long, that no
neighbouring word extends with the same period. Texts are worked on in pieces of about
``PIECE_WORDS`` words of one Arrow batch, with array operations:

* *Suffix array.* Words are numbered exactly (a dictionary, no hashes), each document's
  apart, so suffixes of different documents never share a prefix. Prefix doubling
  sorts only the suffixes whose place is not settled; the ranks of every level are kept
  and give the common prefix (LCP) of neighbours by descending them.
* *Intervals.* One pass with a stack finds, for every boundary between neighbouring
  suffixes, the two sides of its LCP interval that it separates; there are no tree nodes.
* *Branching tandems.* For a boundary of depth ``d`` every suffix ``i`` of the smaller side
  is tested: where ``ISA[i + d]`` or ``ISA[i - d]`` lies in the other side, a square of
  period ``d`` begins at the smaller of both, and the word after it breaks the period.
  Smaller sides sum up to ``n log n``; they are tested in slices of bounded size.
* *Rotation.* Every run ends with exactly one such square. Squares of one end are taken
  by growing period; one whose period is a multiple of the period of a run that covers it
  is no smallest period. The others are rotated to the left, in strides of growing length,
  until the period breaks: square and rotation make the run.

A document is one row and is never split: its memory is some 200 bytes a word and 4 more for
each level (``log2`` of its longest repeat); its time is ``n log n``. Nothing is shuffled. A null text has
no words; texts without words have no runs. Repeated rows each give their own result. An
empty table gives an empty result; extra columns are passed over.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.common import encoded_of

#: Least length of a run in words.
LEAST_LENGTH = 12
#: Words worked on together (a longer document makes a longer piece); suffixes tested at once.
PIECE_WORDS, SLICE = 1 << 17, 1 << 19

RUNS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


# --------------------------------------------------------------------------- suffix array
def suffix_levels(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array, and per level ``k`` the rank of every suffix by its first ``2 ** k`` words.

    ``codes`` are equal only for equal words of one document, ``ends`` has the end of the
    document of every place. Equal ranks mean equal prefixes of full length; a rank is the
    first place of its group in the array. The ranks of the last level differ all.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if n else np.zeros(0, np.int64)
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.repeat(first, np.diff(first, append=n)).astype(np.int32)
    levels, width = [rank], 1
    open_slots = _unsettled(first, n)
    while len(open_slots):
        active = order[open_slots]
        ahead = active + width
        known = ahead < ends[active]
        second = np.where(known, rank[np.where(known, ahead, 0)].astype(np.int64) + 1, 0)
        key = rank[active].astype(np.int64) * (n + 1) + second
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        order[open_slots] = active
        head = np.append(True, key[1:] != key[:-1])
        starts = np.flatnonzero(head)
        rank = rank.copy()
        rank[active] = np.repeat(open_slots[starts], np.diff(starts, append=len(key))).astype(np.int32)
        sizes = np.diff(starts, append=len(key))
        open_slots = open_slots[np.repeat(sizes > 1, sizes)]
        levels.append(rank)
        width *= 2
    return order, levels


def _unsettled(first: np.ndarray, n: int) -> np.ndarray:
    sizes = np.diff(first, append=n)
    return np.flatnonzero(np.repeat(sizes > 1, sizes))


def neighbour_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places ``k`` of the suffix array that share a prefix with the place before, and its length."""
    n = len(order)
    near = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1 if n else np.zeros(0, np.int64)
    i, j = order[near - 1].copy(), order[near].copy()
    shared = np.zeros(len(near), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.maximum(i, j) < n
        same = inside & (levels[k][np.where(inside, i, 0)] == levels[k][np.where(inside, j, 0)])
        step = same.astype(np.int64) << k
        shared += step
        i += step
        j += step
    return near, shared


def interval_sides(near: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every boundary the first place of its left and the last place of its right side.

    The left side reaches back to the boundary before that is as deep or less deep, the
    right side on to the next less deep one; so boundaries of equal depth part their
    interval one by one, and any two suffixes in it are parted once.
    """
    left, right = [0] * len(near), [0] * len(near)
    stack: list[int] = []
    places, depths = near.tolist(), depth.tolist()
    last, base = -2, 0
    for x, (place, d) in enumerate(zip(places, depths, strict=True)):
        if place != last + 1:  # no common prefix in between: all intervals end
            for y in stack:
                right[y] = last
            stack.clear()
            base = place - 1
        while stack and depths[stack[-1]] > d:
            right[stack.pop()] = place - 1
        left[x] = places[stack[-1]] if stack else base
        stack.append(x)
        last = place
    for y in stack:
        right[y] = last
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


# --------------------------------------------------------------------------- squares and runs
def branching_squares(order: np.ndarray, near: np.ndarray, depth: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(start, period)`` of every square that the word after it does not carry on."""
    n = len(order)
    inverse = np.empty(n, dtype=np.int64)
    inverse[order] = np.arange(n)
    by_left = near - left <= right - near + 1
    low, count = np.where(by_left, left, near), np.where(by_left, near - left, right - near + 1)
    other_low, other_high = np.where(by_left, near, left), np.where(by_left, right, near - 1)
    starts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    total = np.cumsum(count)
    at = 0
    while at < len(near):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE, side="right")))
        own = np.repeat(np.arange(at, stop), count[at:stop])
        offset = np.arange(len(own)) - np.repeat(total[at:stop] - count[at:stop] - (total[at - 1] if at else 0), count[at:stop])
        i, d = order[low[own] + offset], depth[own]
        for j in (i + d, i - d):
            inside = (j >= 0) & (j < n)
            place = inverse[np.where(inside, j, 0)]
            hit = inside & (place >= other_low[own]) & (place <= other_high[own])
            starts.append(np.minimum(i, j)[hit])
            periods.append(d[hit])
        at = stop
    return np.concatenate(starts), np.concatenate(periods)


def rotated(codes: np.ndarray, start: int, period: int) -> int:
    """How far to the left the period goes on."""
    stride = 8
    while start:
        low = max(start - stride, 0)
        broken = np.flatnonzero(codes[low:start] != codes[low + period : start + period])
        if len(broken):
            return low + int(broken[-1]) + 1
        start, stride = low, stride * 2
    return start


def runs_of(codes: np.ndarray, ends: np.ndarray, least: int = LEAST_LENGTH) -> list[tuple[int, int, int]]:
    """``(start, end, period)`` of all runs of at least ``least`` words, by start, then period."""
    order, levels = suffix_levels(codes, ends)
    near, depth = neighbour_prefixes(order, levels)
    del levels
    starts, periods = branching_squares(order, near, depth, *interval_sides(near, depth))
    by = np.lexsort((periods, starts + 2 * periods))
    found: list[tuple[int, int, int]] = []
    here: list[tuple[int, int]] = []
    at_end = -1
    for start, period in zip(starts[by].tolist(), periods[by].tolist(), strict=True):
        end = start + 2 * period
        if end != at_end:
            here, at_end = [], end
        if any(period % q == 0 and s <= start for s, q in here):
            continue
        first = rotated(codes, start, period)
        here.append((first, period))
        if end - first >= least:
            found.append((first, end, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


# --------------------------------------------------------------------------- texts
def repeated_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's planted repeats: in a tenth of the documents words repeat from some place on."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def coded(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words of several documents, one after the other, and the end of the document of each."""
    parts, ends, at, base = [], [], 0, 0
    for words in texts:
        known: defaultdict[bytes, int] = defaultdict()
        known.default_factory = known.__len__  # an unseen word gets the next number
        parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)) + base)
        base += len(known)
        at += len(words)
        ends.append(np.full(len(words), at, dtype=np.int64))
    return np.concatenate(parts), np.concatenate(ends)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a blank, each run cut down to its first period."""
    if runs:
        change = np.zeros(len(words) + 1, dtype=np.int64)
        for start, end, period in runs:
            change[start + period] += 1
            change[end] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words)


def text_runs(texts: list[list[bytes]], least: int = LEAST_LENGTH) -> list[list[tuple[int, int, int]]]:
    """``(start, end, period)`` of the runs of every document, in word numbers of its own."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    codes, ends = coded(texts)
    firsts = np.cumsum([0, *map(len, texts)])
    for start, end, period in runs_of(codes, ends, least):
        doc = int(np.searchsorted(firsts, start, side="right")) - 1
        out[doc].append((start - int(firsts[doc]), end - int(firsts[doc]), period))
    return out


def _pieces(ids: list, texts: Iterator[bytes]) -> Iterator[tuple[list, list[list[bytes]]]]:
    names, held, size = [], [], 0
    for name, text in zip(ids, texts, strict=True):
        names.append(name)
        held.append(repeated_tail(text.split(), name))
        size += len(held[-1])
        if size >= PIECE_WORDS:
            yield names, held
            names, held, size = [], [], 0
    if names:
        yield names, held


def _described(name: int | None, words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    start, end, period = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=(None, None, None))
    longest = (None,) * 4 if start is None else (start, end - start, period, 1000 * (end - start) // period)
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    return (name, len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest())


def find_runs(docs: DataFrame) -> DataFrame:
    """The contract's columns: number and digest of the runs of every document, its longest run, and the digest of its collapsed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RUNS.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        for b in batches:
            for ids, texts in _pieces(b.column(0).to_pylist(), encoded_of(b.column(1))):
                rows = [_described(*x) for x in zip(ids, texts, text_runs(texts), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, RUNS)
