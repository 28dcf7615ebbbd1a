"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Texts are compared as lower-cased words of letters and digits, so punctuation and
mark-up between words do not matter. First all documents are counted for every
word trigram of the test items. In each stretch of ``STRETCH`` neighbouring
trigrams of an item the rarest one becomes a seed; a passage of an item thus holds
a seed wherever it is cut, and the item's own rarest wording finds it even if a
third of all documents hold the passage. Documents that share a seed with an item,
however common, are aligned with it, word by word, around each place where seeds point
to, unless too few of the item's words stand there for any alignment to be enough.

A document is contaminated by an item when the local alignment's score reaches
``SHARE`` of the item's best possible score, or that of ``LONG`` words in a row.

Items are taken in blocks of ``BLOCK_BYTES`` of text, each a small index held by
every task; all documents are searched for every block, so any number of items
works in bounded memory. The result has one row for each pair of document row and
item. Null and empty texts match nothing; neither do items of fewer than three
words. Items with equal text are each reported. Empty tables give an empty result;
extra columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.common import PLAIN_WORDS, gram_hashes, summed_chunks, text_buffers, word_hashes

#: Words in a seed, trigrams in a stretch that gives one seed.
SEED, STRETCH = 3, 4
#: Scores of a word: equal, different, left out or put in.
MATCH, OTHER, GAP = 2, -1, -1
#: Share of an item's best score, or words in a row, that count as contamination.
SHARE, LONG = 0.4, 13
#: Bytes of item text indexed at a time.
BLOCK_BYTES = 4 << 20
COUNT_CHUNKS = 8

SCHEMA = "doc_id long, item_id long, similarity double, score long, matched long, first_word long, last_word long"


def plain_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(*text_buffers(column), lower=True, sep=PLAIN_WORDS)


@dataclass
class Items:
    """A block of items: their words, and where each distinct trigram stands in them."""

    ids: list[int | None]
    words: list[np.ndarray]
    grams: np.ndarray  # distinct, sorted
    first: np.ndarray  # postings of gram k: first[k]:first[k + 1]
    item: np.ndarray
    place: np.ndarray
    filter: np.ndarray  # by leading bits: may be a gram

    @staticmethod
    def of(rows: list[tuple[int | None, str]]) -> Items:
        hashes, bounds = plain_words(pa.array([t for _, t in rows], pa.string()))
        words = [hashes[bounds[i] : bounds[i + 1]] for i in range(len(rows))]
        grams = [gram_hashes(w, SEED) for w in words]
        return Items.index([i for i, _ in rows], words, grams, [np.arange(len(g)) for g in grams])

    @staticmethod
    def index(ids, words, grams, places) -> Items:
        flat = np.concatenate([*grams, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*places, np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(flat, kind="stable")
        distinct, first = np.unique(flat[order], return_index=True)
        maybe = np.zeros(1 << 20, dtype=bool)
        maybe[distinct >> np.uint64(44)] = True
        return Items(ids, words, distinct, np.append(first, len(flat)).astype(np.int64), item[order], place[order], maybe)

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``grams`` that are indexed, and which gram each is."""
        at = np.flatnonzero(self.filter[grams >> np.uint64(44)])
        if not len(at) or not len(self.grams):
            return at[:0], at[:0]
        which = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        keep = self.grams[which] == grams[at]
        return at[keep], which[keep]

    def seeds(self, documents: np.ndarray) -> Items:
        """The index of only the rarest trigram of every stretch."""
        grams, places = [], []
        for w in self.words:
            own = gram_hashes(w, SEED)
            k = documents[np.searchsorted(self.grams, own)] if len(own) else np.zeros(0, np.int64)
            span = min(STRETCH, len(own))
            chosen = sorted({i + int(np.argmin(k[i : i + span])) for i in range(len(own) - span + 1)}) if span else []
            grams.append(own[chosen])
            places.append(np.array(chosen, dtype=np.int64))
        return Items.index(self.ids, self.words, grams, places)


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment: score, equal words, first and last word of the text in it.

    Rows are computed whole, and only two are held: a cell carries the place where its
    alignment begins and its number of equal words. A gap along the text is a running
    maximum; its cells take what the cell at which the maximum was reached carries.
    """
    n = len(text)
    places = np.arange(n + 1)
    slope = GAP * places
    row, first, equal = np.zeros(n + 1, dtype=np.int64), places.copy(), np.zeros(n + 1, dtype=np.int64)
    best = (0, 0, 0, -1)
    for word in item:
        alike = text == word
        across = row[:-1] + np.where(alike, MATCH, OTHER)
        down = row + GAP
        fresh = down <= 0
        score, begin, count = np.where(fresh, 0, down), np.where(fresh, places, first), np.where(fresh, 0, equal)
        better = across >= np.maximum(score[1:], 1)
        score[1:] = np.where(better, across, score[1:])
        begin[1:] = np.where(better, first[:-1], begin[1:])
        count[1:] = np.where(better, equal[:-1] + alike, count[1:])
        level = score - slope
        source = np.maximum.accumulate(np.where(level >= np.maximum.accumulate(level), places, 0))
        row = level[source] + slope
        empty = row <= 0
        first, equal = np.where(empty, places, begin[source]), np.where(empty, 0, count[source])
        last = int(np.argmax(row))
        if row[last] > best[0]:
            best = (int(row[last]), int(equal[last]), int(first[last]), last - 1)
    return best


def enough(score: int, matched: int, length: int) -> bool:
    return matched >= min(length, 8) and (score >= SHARE * MATCH * length or score >= MATCH * LONG)


def in_reach(item: np.ndarray, text: np.ndarray) -> bool:
    """Whether an alignment can be enough: it has at most the item's words that the text has, all equal."""
    most = min(int(np.isin(item, text).sum()), int(np.isin(text, item).sum()))
    return enough(MATCH * most, most, len(item))


def compare(words: np.ndarray, seeds: Items) -> Iterator[tuple[int, int, int, int, int]]:
    """``(item, score, matched, first, last)`` of the items that contaminate one text."""
    at, gram = seeds.hits(gram_hashes(words, SEED))
    if not len(at):
        return
    counts = seeds.first[gram + 1] - seeds.first[gram]
    which = np.repeat(np.arange(len(at)), counts)
    posting = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + seeds.first[gram[which]]
    item, start = seeds.item[posting], at[which] - seeds.place[posting]
    order = np.lexsort((start, item))
    item, start = item[order], start[order]
    for lo, hi in _runs(item):
        own = int(item[lo])
        length = len(seeds.words[own])
        pad = length // 4 + 2
        best = None
        # every place to which seeds point lies in a window with room for the whole item around it
        window = start[lo:hi] // (length + 2 * pad)
        cut = np.flatnonzero(np.diff(window)) + 1
        for a, b in zip([lo, *(lo + cut)], [*(lo + cut), hi], strict=True):
            begin = max(int(start[a]) - pad, 0)
            text = words[begin : int(start[b - 1]) + length + pad]
            if not in_reach(seeds.words[own], text):
                continue
            score, matched, first, last = align(seeds.words[own], text)
            if enough(score, matched, length) and (best is None or score > best[1]):
                best = (own, score, matched, begin + first, begin + last)
        if best:
            yield best


def _runs(x: np.ndarray) -> Iterator[tuple[int, int]]:
    cut = np.flatnonzero(np.diff(x)) + 1
    yield from zip([0, *cut.tolist()], [*cut.tolist(), len(x)], strict=True)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text")).alias("text"))


def document_frequency(docs: DataFrame, items: Items) -> np.ndarray:
    """For each trigram of a block, the documents that hold it."""
    shared = docs.sparkSession.sparkContext.broadcast(items)  # one block of items

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        total = np.zeros(len(own.grams), dtype=np.int64)
        for b in batches:
            hashes, bounds = plain_words(b.column(0))
            for i in range(b.num_rows):
                _, gram = own.hits(gram_hashes(hashes[bounds[i] : bounds[i + 1]], SEED))
                total[np.unique(gram)] += 1
        parts = np.array_split(total, COUNT_CHUNKS)
        task = pa.array([TaskContext.get().partitionId()] * len(parts), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), task, pa.array([x.tobytes() for x in parts], pa.binary())], names=["chunk", "part", "counts"])

    total = summed_chunks(_plain(docs).select("text").mapInArrow(counted, "chunk int, part int, counts binary"), "int64")
    return total if len(total) else np.zeros(len(items.grams), np.int64)


def search(docs: DataFrame, items: Items) -> DataFrame:
    """All contaminated pairs for one block of items."""
    seeds = items.seeds(document_frequency(docs, items))
    shared = docs.sparkSession.sparkContext.broadcast(seeds)  # one block of items

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            hashes, bounds = plain_words(b.column(1))
            rows = []
            for i, doc_id in enumerate(b.column(0).to_pylist()):
                for k, score, matched, first, last in compare(hashes[bounds[i] : bounds[i + 1]], own):
                    rows.append((doc_id, own.ids[k], score / (MATCH * len(own.words[k])), score, matched, first, last))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.float64(), *[pa.int64()] * 4]
                names = ["doc_id", "item_id", "similarity", "score", "matched", "first_word", "last_word"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return _plain(docs).mapInArrow(searched, SCHEMA)


def item_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items, streamed to the driver and indexed block by block."""
    rows: list[tuple[int | None, str]] = []
    size = 0
    wanted = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower(F.coalesce("text", F.lit(""))).alias("text")).where("text <> ''")
    for r in wanted.toLocalIterator():
        rows.append((r["item_id"], r["text"]))
        size += len(r["text"])
        if size >= BLOCK_BYTES:
            yield Items.of(rows)
            rows, size = [], 0
    if rows:
        yield Items.of(rows)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item that it holds a passage of."""
    out = docs.sparkSession.createDataFrame([], SCHEMA)
    for items in item_blocks(benchmark):
        out = out.union(search(docs, items))
    return out
