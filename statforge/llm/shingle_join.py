"""N-gram Jaccard join with count-vector R-trees, and the groups that its links make.

A text's set is its distinct five-word shingles. Two sets link when their Jaccard
similarity reaches ``PERCENT``. The work goes in steps, each a Spark job:

1. *Classes.* Equal sets form one class; only classes are compared, so exact copies
   cost one comparison however many there are.
2. *Dealing.* Take any fixed order of all shingles. Two sets that link share a shingle
   that is among the first ``n - ceil(2t n / (1 + t)) + 1`` of the smaller one and the
   first ``n - ceil(t n) + 1`` of the larger one. So sets are dealt by these first
   shingles, and a shingle that is among the fewer ones of no set deals none. The order
   puts shingles that are frequent in the corpus last (their frequency comes from a
   fixed-size sketch of all shingles), so a passage that many texts hold seldom deals
   them together. A shingle's bucket is named by the least class that has it: the many
   shingles that near copies share mostly name one bucket, where each class stands once.
3. *Search.* The shingles of a set are hashed into groups; the group counts are a
   point. In each bucket the points of one width are packed into an R-tree, those of
   twice the width that are small enough to link folded into it. The overlap of two
   sets is at most the sum over the groups of the smaller count, and for a node at
   most that with its box's upper corner, so boxes and points that cannot reach the
   similarity are passed over. Points travel as the fine codes they are counted
   from (some 32 to 64 values a shingle, about a byte each); what survives the tree
   is bounded again by the counts of these codes, which come close to the overlap.
4. *Verification.* Surviving pairs are checked on their shingle sets.

The search goes in rounds. In each bucket it keeps a spanning forest: a surviving pair is a
candidate only if it joins two trees, so a bucket names fewer candidates than it has
classes, and parts of a bucket that are joined already are passed over, node by node of the
R-tree. Candidates are verified, and links join components. If all candidates of a bucket
hold, its forest is right and every other surviving pair of it lies within one component,
so it is done. Buckets with a failed candidate are searched again, their components joined
from the start and without the failed pairs, until none is left; so in the end no two sets
of different components can link. In each round a bucket keeps ``MORE`` times as many forests as
before (``MOST_FORESTS`` at most), one within the other, so the number of rounds is small. A group of near
copies costs about its size, not its square.
A bucket of more than ``BLOCK`` classes is dealt over several tasks: in the first round
block by block, with one class in all of its blocks; later as cells of two blocks, of
which one at least is outside the bucket's largest component, so every pair across still
meets, once, and no task holds more than about twice ``BLOCK`` classes of a bucket.

A null text, or one without words, has no shingles, links with nothing and is its
own component. A text of fewer than five words is one shingle. Repeated rows share
a class. Null ids are carried along but never name a component that has another
id. An empty table gives an empty result; extra columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statforge.llm.common import materialise, mix, shingle_set, text_buffers, tree_summed, word_hashes

#: Similarity from which two sets link, in percent.
PERCENT = 75
#: Least and most coordinates of a point, and shingles that a coordinate stands for.
LEAST_GROUPS, MOST_GROUPS, LOAD = 128, 8192, 2
#: Fine codes are drawn from 32 to 64 values a shingle.
FINE = 32
#: Counters of the frequency sketch (a byte each from every task), and rows it is shipped in.
SKETCH_BITS, SKETCH_CHUNKS = 22, 64
#: Doublings above twice the sketch's mean from which a key counts as common, and parts that it is dealt in.
COMMON, SALTS = 6, 64
#: Classes in a block of a bucket; one task holds one or two blocks.
BLOCK = 4096
#: Points in a leaf, children in a node.
LEAF, FANOUT = 32, 16
#: Spanning forests of a bucket: times as many in each round, and at most so many.
MORE, MOST_FORESTS = 16, 256
#: Texts whose words are hashed at a time.
SLICE = 256

DOCS = "doc_id long, n long, sig long, point binary, chunk int, part int, counts binary"
PAIR = "a long, b long"
CANDIDATE = "bucket long, b long, a long"


# --------------------------------------------------------------------------- sets and points
def signature(s: np.ndarray) -> int:
    """A 64-bit name of a set (as a signed long)."""
    place = np.arange(1, len(s) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sums = np.array([(s ^ place).sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64), len(s)], dtype=np.uint64)
    return int(mix(sums * np.array([1, 3, 5], dtype=np.uint64)).sum(dtype=np.uint64).view(np.int64))


def groups_of(n: int) -> int:
    """Coordinates of the point of a set of ``n``: the largest power of two up to ``n / LOAD``, within limits."""
    return min(max(1 << (max(n // LOAD, 1).bit_length() - 1), LEAST_GROUPS), MOST_GROUPS)


def code_bits(n: int) -> int:
    """Width of the fine codes of a set of ``n``."""
    return max((FINE * n).bit_length(), 14)


def packed_codes(s: np.ndarray) -> bytes:
    """The sorted fine codes of a set (leading bits of its shingles) as gaps of a byte; 255 carries on."""
    codes = (s >> np.uint64(64 - code_bits(len(s)))).astype(np.int64)
    gaps = np.diff(codes, prepend=0)
    ends = np.cumsum(gaps // 255 + 1)
    out = np.full(ends[-1] if len(ends) else 0, 255, dtype=np.uint8)
    out[ends - 1] = gaps % 255
    return out.tobytes()


def unpacked(raw: np.ndarray, offsets: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The fine codes of several sets, whose gaps lie one after the other."""
    total = np.cumsum(raw, dtype=np.int64)
    base = np.append(0, total)[offsets[:-1]]
    codes = total[raw != 255] - np.repeat(base, sizes)
    return np.split(codes, np.cumsum(sizes)[:-1])


def points_of(codes: list[np.ndarray], bits: int, width: int) -> np.ndarray:
    """Group counts of several sets: codes folded into ``width`` groups by their leading bits."""
    place = np.repeat(np.arange(len(codes)) * width, list(map(len, codes)))
    flat = np.concatenate(codes) >> (bits - (width.bit_length() - 1))
    counts = np.bincount(place + flat, minlength=len(codes) * width).reshape(len(codes), width)
    counts[counts.max(axis=1) > 65535] = 65535  # too large for a counter: full ones bound nothing away
    return counts.astype(np.uint16)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def short_prefix_length(n: int, percent: int = PERCENT) -> int:
    """As :func:`prefix_length`, if the other set is at least as large."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


def needed(a, b, percent: int = PERCENT):
    """Whether an overlap is enough is ``(100 + t) * overlap >= t * (a + b)``: the right side."""
    return percent * (a + b)


def batch_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The shingle sets of a batch, some texts at a time."""
    for at in range(0, len(column), SLICE):
        part = column.slice(at, SLICE)
        hashes, bounds = word_hashes(*text_buffers(part))
        for i in range(len(part)):
            yield shingle_set(hashes[bounds[i] : bounds[i + 1]])


# --------------------------------------------------------------------------- R-tree
class CountTree:
    """A packed R-tree over count points, in an order that keeps like points together.

    ``rank`` orders the points; searches look only at points of lower rank, and pass over
    nodes all of whose points have the label of the one that searches (see :meth:`label`).
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, rank: np.ndarray, percent: int = PERCENT):
        self.percent = percent
        self.order = self._pack(points, sizes)
        self.points, self.rank = points[self.order], rank[self.order]
        self.sizes = sizes[self.order].astype(np.int64)
        starts = np.arange(0, len(points), LEAF)
        level = [np.maximum.reduceat(self.points, starts), np.minimum.reduceat(self.sizes, starts), np.maximum.reduceat(self.sizes, starts), np.minimum.reduceat(self.rank, starts)]
        self.levels = [level]
        while len(level[1]) > FANOUT:
            group = np.arange(0, len(level[1]), FANOUT)
            level = [f.reduceat(x, group) for f, x in zip((np.maximum, np.minimum, np.maximum, np.minimum), level, strict=True)]
            self.levels.append(level)
        self.labels: np.ndarray | None = None

    def label(self, labels: np.ndarray) -> None:
        """Give the points labels (in their original order)."""
        self.labels = labels[self.order]
        low = high = self.labels
        self.spans = []
        for k, level in enumerate(self.levels):
            starts = np.arange(0, len(low), FANOUT if k else LEAF)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            self.spans.append((low, high))

    @staticmethod
    def _pack(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sort by size into slabs, then halve each along its widest coordinate."""
        out: list[np.ndarray] = []
        by_size = np.argsort(sizes, kind="stable")
        slab = LEAF * FANOUT
        for at in range(0, len(by_size), slab):
            stack = [by_size[at : at + slab]]
            while stack:
                part = stack.pop()
                if len(part) <= LEAF:
                    out.append(part)
                    continue
                own = points[part]
                axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                ranked = part[np.argsort(own[:, axis], kind="stable")]
                half = max(LEAF, len(part) // 2 // LEAF * LEAF)
                stack += [ranked[half:], ranked[:half]]
        return np.concatenate(out)

    def _open(self, nodes: np.ndarray, level: int, place: int) -> tuple[np.ndarray, np.ndarray]:
        """The nodes that may hold a partner of lower rank, and their bounds."""
        high, least, most, first = self.levels[level]
        size = self.sizes[place]
        if self.labels is not None:
            low, top = self.spans[level]
            nodes = nodes[(low[nodes] != self.labels[place]) | (top[nodes] != self.labels[place])]
        nodes = nodes[(first[nodes] < self.rank[place]) & (100 * most[nodes] >= self.percent * size) & (self.percent * least[nodes] <= 100 * size)]
        bound = np.minimum(high[nodes], self.points[place]).sum(axis=1, dtype=np.int64)
        keep = (100 + self.percent) * bound >= needed(size, least[nodes], self.percent)
        return nodes[keep], bound[keep]

    def _leaf(self, node: int, place: int) -> np.ndarray:
        places = np.arange(node * LEAF, min(node * LEAF + LEAF, len(self.sizes)))
        places = places[self.rank[places] < self.rank[place]]
        bound = np.minimum(self.points[places], self.points[place]).sum(axis=1, dtype=np.int64)
        return places[(100 + self.percent) * bound >= needed(self.sizes[place], self.sizes[places], self.percent)]

    def _children(self, nodes: np.ndarray, level: int) -> np.ndarray:
        kids = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        return kids[kids < len(self.levels[level - 1][1])]

    def leaves(self, place: int) -> Iterator[np.ndarray]:
        """Leaf by leaf, best boxes first, the places of lower rank whose bound reaches the similarity."""
        top = len(self.levels) - 1
        stack = [(top, np.arange(len(self.levels[top][1])))]
        while stack:
            level, nodes = stack.pop()
            nodes, bound = self._open(nodes, level, place)
            nodes = nodes[np.argsort(bound, kind="stable")]
            if level:
                stack += [(level - 1, self._children(nodes[k : k + 1], level)) for k in range(len(nodes))]
                continue
            for node in nodes[::-1]:
                places = self._leaf(int(node), place)
                if len(places):
                    yield places


def _closer(codes: list[np.ndarray], bits: int, own: int, others: np.ndarray) -> np.ndarray:
    """Bound of the overlap from the fine codes: how many of each other set's codes the own set has."""
    mark = np.zeros(1 << bits, dtype=bool)
    mark[codes[own]] = True
    parts = [codes[k] for k in others]
    starts = np.cumsum([0, *map(len, parts[:-1])])
    return np.add.reduceat(mark[np.concatenate(parts)], starts, dtype=np.int64)


class Forests:
    """``deep`` spanning forests over the rows of a cell, each within the one before.

    Rows of one ``part`` are joined from the start. A pair goes to the first forest in which
    its ends are apart; so ends that are joined in the last forest are joined in all.
    """

    def __init__(self, part: np.ndarray, deep: int = 1):
        self.labels = np.tile(np.unique(part, return_inverse=True)[1].astype(np.int32), (deep, 1))
        self.joined = 0

    def apart(self, own: int, others: np.ndarray) -> np.ndarray:
        last = self.labels[-1]
        return last[others] != last[own]

    def join(self, own: int, other: int) -> bool:
        for labels in self.labels:
            if labels[own] != labels[other]:
                labels[labels == labels[other]] = labels[own]
                self.joined += 1
                return True
        return False


def _partners(points: np.ndarray, sizes: np.ndarray, rank: np.ndarray, rows: np.ndarray, half: np.ndarray, forests: Forests, percent: int) -> Iterator[tuple[int, Iterator[np.ndarray]]]:
    """For each row the rows of lower rank (not joined to it and, in a cell of two blocks, of the other block) that the tree lets through, leaf by leaf."""

    def elsewhere(own: int, others: np.ndarray) -> np.ndarray:
        return others[forests.apart(rows[own], rows[others]) & ((half[own] == 0) | (half[others] != half[own]))]

    if len(sizes) <= LEAF:  # one leaf: all its bounds at once
        bound = np.minimum(points[:, None, :], points[None, :, :]).sum(axis=2, dtype=np.int64)
        hit = ((100 + percent) * bound >= needed(sizes[:, None], sizes[None, :], percent)) & (rank[None, :] < rank[:, None])
        for own in np.flatnonzero(hit.any(axis=1)).tolist():
            if len(others := elsewhere(own, np.flatnonzero(hit[own]))):
                yield own, iter([others])
        return
    tree, joined = CountTree(points, sizes, rank, percent), -1
    for place in range(len(sizes)):
        own = int(tree.order[place])
        if joined != forests.joined:
            tree.label(forests.labels[-1][rows])
            joined = forests.joined
        yield own, (x for x in (elsewhere(own, tree.order[p]) for p in tree.leaves(place)) if len(x))


def _tree_pairs(sig: np.ndarray, sizes: np.ndarray, codes: list[np.ndarray], bits: int, rows: np.ndarray, half: np.ndarray, failed: list, forests: Forests, percent: int) -> Iterator[tuple[int, int]]:
    """``(row, row of a partner)`` of sets whose codes have one width: the surviving pairs that join trees."""
    rank = np.empty(len(sizes), dtype=np.int64)
    rank[np.lexsort((sig, sizes))] = np.arange(len(sizes))
    points = points_of(codes, bits, groups_of(int(sizes.min())))
    for own, found in _partners(points, sizes, rank, rows, half, forests, percent):
        for others in found:
            others = others[forests.apart(rows[own], rows[others])]
            if len(failed[own]):
                others = others[~np.isin(sig[others], failed[own])]
            if not len(others):
                continue
            bound = np.minimum(_closer(codes, bits, own, others), sizes[own])
            near = (100 + percent) * bound >= needed(sizes[own], sizes[others], percent)
            likely = bound[near] / (sizes[own] + sizes[others[near]] - bound[near])
            for other in others[near][np.argsort(-likely, kind="stable")].tolist():
                if forests.join(int(rows[own]), int(rows[other])):
                    yield own, other


def search_bucket(sig: np.ndarray, sizes: np.ndarray, every: list[np.ndarray], part: np.ndarray, half: np.ndarray, failed: list, deep: int = 1, percent: int = PERCENT) -> Iterator[tuple[int, int]]:
    """Candidates of one bucket: pairs of classes that make ``deep`` spanning forests of its surviving pairs.

    Linked sets differ in size by a third at most, so their codes are of one width or
    one's are a bit wider; each width's tree takes in the shortened codes it may need.
    ``failed`` names for each class the partners that were verified in vain. Classes whose
    ``half`` is equal and not 0 meet in another cell.
    """
    widths = np.array([code_bits(n) for n in sizes.tolist()])
    forests = Forests(part, deep)
    for bits in np.unique(widths):
        own = np.flatnonzero(widths == bits)
        wider = np.flatnonzero((widths == bits + 1) & (percent * sizes <= 100 * sizes[own].max()))
        rows = np.concatenate([own, wider])
        if len(rows) < 2:
            continue
        codes = [every[i] for i in own] + [every[i] >> 1 for i in wider]
        yield from ((int(sig[rows[i]]), int(sig[rows[j]])) for i, j in _tree_pairs(sig[rows], sizes[rows], codes, int(bits), rows, half[rows], [failed[i] for i in rows], forests, percent))


# --------------------------------------------------------------------------- Spark steps
def described(docs: DataFrame) -> DataFrame:
    """Per document its set's size, name and point; per task the counters of its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        shift = np.uint64(64 - SKETCH_BITS)
        names = [c.split()[0] for c in DOCS.split(", ")]
        for b in batches:
            n, sig, point = [], [], []
            for s in batch_sets(b.column(1)):
                n.append(len(s))
                sig.append(signature(s))
                point.append(packed_codes(s))
                np.add.at(counters, (s >> shift).astype(np.int64), 1)
            k = len(n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(sig, pa.int64()), pa.array(point, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
                names=names,
            )
        # only the order of shingles hangs on the counts, so a task's may end at 255
        chunks = [c.tobytes() for c in np.split(np.minimum(counters, 255).astype(np.uint8), SKETCH_CHUNKS)]
        k = len(chunks)
        nothing = [pa.nulls(k, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
        part = pa.array([TaskContext.get().partitionId()] * k, pa.int32())
        yield pa.RecordBatch.from_arrays([*nothing, pa.array(range(k), pa.int32()), part, pa.array(chunks, pa.binary())], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, DOCS)


def frequency_levels(rows: DataFrame) -> np.ndarray:
    """For each counter, how many doublings its sum lies above twice the mean (one byte each); only levels reach the driver."""
    total = rows.agg(F.sum("n")).first()[0] or 0
    floor = max(2 * total / (1 << SKETCH_BITS), 1.0)

    def level(x: np.ndarray) -> np.ndarray:
        return np.ceil(np.log2(np.maximum(x / floor, 1.0))).astype(np.uint8)

    out = np.zeros((SKETCH_CHUNKS, (1 << SKETCH_BITS) // SKETCH_CHUNKS), dtype=np.uint8)
    for r in tree_summed(rows, "u1", level).collect():
        out[r["chunk"]] = np.frombuffer(r["counts"], np.uint8)
    return out.ravel()


def prefix_keys(docs: DataFrame, levels: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """``key, sig, short, level``: the first shingles of every set, frequent ones last, whether a larger set must share one of these, and how frequent they are."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, shift = shared.value, np.uint64(64 - SKETCH_BITS)
        for b in batches:
            met: set[int] = set()
            for at in range(0, b.num_rows, SLICE):
                keys, sigs, lens, short, often = [], [], [], [], []
                for s in batch_sets(b.column(0).slice(at, SLICE)):
                    if not len(s) or (name := signature(s)) in met:
                        continue
                    met.add(name)
                    own, p = level[s >> shift], prefix_length(len(s), percent)
                    order = np.arange(p) if not own.any() else np.argsort(own, kind="stable")[:p]
                    keys.append(s[order])
                    often.append(own[order])
                    sigs.append(name)
                    lens.append(p)
                    short.append(np.arange(p) < short_prefix_length(len(s), percent))
                if keys:
                    columns = [np.concatenate(keys).view(np.int64), np.repeat(np.array(sigs, np.int64), lens), np.concatenate(short), np.concatenate(often).astype(np.int8)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "sig", "short", "level"])

    return docs.select(F.col("text").alias("text")).mapInArrow(run, "key long, sig long, short boolean, level byte")


def buckets_of(keys: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``bucket, sig, n``: the classes that share a key, under the name of the least of them.

    A class none of whose bucket's others is of a size that could link is left out. The
    keys are exchanged once, those that the sketch calls common salted by the class; what
    the salted parts of such a key say is combined and joined back, where a large side may
    be split.
    """
    common = F.col("level") > COMMON
    salt = F.when(common, F.pmod("sig", F.lit(SALTS))).otherwise(0)
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.select("key", "sig", "short", common.alias("common"), salt.cast("int").alias("salt")).repartition(n, "key", "salt")
    here = Window.partitionBy("key", "salt")
    seen = dealt.withColumns({"least": F.min("sig").over(here), "last": F.max("sig").over(here), "deals": F.max("short").over(here)})
    seen = materialise(seen.where("common OR (least <> last AND deals)").select("key", "sig", "least", "last", "deals", "common"), "shared")
    whole = seen.where("common").groupBy("key").agg(F.min("least").alias("bucket"), F.max("last").alias("last"), F.max("deals").alias("deals")).where("bucket <> last AND deals")
    often = seen.where("common").select("key", "sig").join(whole.select("key", "bucket"), "key").select("bucket", "sig")
    dealt_out = seen.where("NOT common").select(F.col("least").alias("bucket"), "sig").union(often).distinct()
    rows = materialise(dealt_out.join(classes.select("sig", "n"), "sig"), "members")
    by_size = Window.partitionBy("bucket").orderBy("n")  # a bucket has as many rows here as it has sizes
    sizes = rows.groupBy("bucket", "n").agg(F.count(F.lit(1)).alias("k"))
    close = (F.col("k") > 1) | (100 * F.lag("n").over(by_size) >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.lead("n").over(by_size))
    kept = sizes.withColumn("close", F.coalesce(close, F.lit(False))).where("close").select("bucket", "n")
    return rows.join(kept, ["bucket", "n"]).select("bucket", "sig", "n")


def classes_of(rows: DataFrame) -> DataFrame:
    """``sig, first_doc, n, point`` of every non-empty class."""
    return rows.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("first_doc"), F.first("n").alias("n"), F.first("point").alias("point"))


def _searched(rows: DataFrame, deep: int, percent: int) -> DataFrame:
    """Search every ``(bucket, block)``; the rows come sorted, so one is complete when the next begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        found: list[tuple[int, int, int]] = []

        def flush() -> None:
            sig, sizes, part, half = (np.concatenate([h[k] for h in held]) for k in (2, 3, 5, 7))
            if len(sig) > 1:
                codes = [c for h in held for c in unpacked(*text_buffers(h[4]), h[3])]
                failed = [f for h in held for f in h[6]]
                found.extend((int(held[0][0]), own, other) for own, other in search_bucket(sig, sizes, codes, part, half, failed, deep, percent))

        def candidates() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
            found.clear()
            return pa.RecordBatch.from_arrays(columns, names=["bucket", "b", "a"])

        for b in batches:
            if not b.num_rows:
                continue
            bucket, block, sig, sizes, part, half = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2, 3, 5, 7))
            cut = np.flatnonzero((bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])) + 1
            for at, stop in zip([0, *cut.tolist()], [*cut.tolist(), len(bucket)], strict=True):
                if held and held[0][:2] != (bucket[at], block[at]):
                    flush()
                    held.clear()
                held.append((bucket[at], block[at], sig[at:stop].copy(), sizes[at:stop].copy(), b.column(4).slice(at, stop - at), part[at:stop].copy(), b.column(6).slice(at, stop - at).to_pylist(), half[at:stop].copy()))
            if len(found) >= 50_000:
                yield candidates()
        if held:
            flush()
        if found:
            yield candidates()

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("bucket", "block", "sig", "n", "point", "part", "failed", "half").repartition(n, "bucket", "block").sortWithinPartitions("bucket", "block", "sig")
    return dealt.mapInArrow(run, CANDIDATE)


def _blocks(rows: DataFrame, outside, first: bool) -> DataFrame:
    """Deal the rows of a large bucket over cells (``block``) of one block (``half`` 0) or two (``half`` 1 and 2).

    In the ``first`` round the cells are the blocks and rows marked ``outside`` stand in
    all. Later the rows outside the main component have blocks of their own, numbered
    after the others, and each of these makes a cell with every block.
    """
    rows = rows.withColumn("outside", outside)
    members = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.count_if("outside").alias("out")).where(F.col("members") > BLOCK)
    blocks = lambda n: F.coalesce(F.ceil(n / F.lit(BLOCK)), F.lit(1)).cast("long")
    rows = rows.join(members, "bucket", "left")
    if first:
        rows = rows.withColumns({"inner": blocks(F.col("members")), "all": blocks(F.col("members"))})
        own = F.pmod(F.xxhash64("sig"), F.col("all"))
        dealt = F.when(F.col("outside"), F.sequence(F.lit(0).cast("long"), F.col("all") - 1)).otherwise(F.array(own))
        cells = F.transform(dealt, lambda x: F.struct(x.alias("block"), F.lit(0).alias("half")))
    else:
        rows = rows.withColumns({"inner": blocks(F.col("members") - F.col("out")), "outer": blocks(F.col("out"))}).withColumn("all", F.col("inner") + F.col("outer"))
        own = F.when(F.col("outside"), F.col("inner") + F.pmod(F.xxhash64("sig"), F.col("outer"))).otherwise(F.pmod(F.xxhash64("sig"), F.col("inner")))
        least = F.when(F.col("outside"), F.lit(0).cast("long")).otherwise(F.col("inner"))
        half = lambda y: F.when(y == own, 0).when(own < y, 1).otherwise(2)
        cells = F.transform(F.sequence(least, F.col("all") - 1), lambda y: F.struct((F.least(own, y) * F.col("all") + F.greatest(own, y)).alias("block"), half(y).alias("half")))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("block"), F.lit(0).alias("half")))
    return rows.withColumn("cell", F.explode(F.when(F.col("members").isNull(), whole).otherwise(cells))).select(*rows.columns, "cell.block", "cell.half")


def candidates(buckets: DataFrame, classes: DataFrame, labels: DataFrame | None = None, failed: DataFrame | None = None, first: bool = False, deep: int = 1, percent: int = PERCENT) -> DataFrame:
    """``bucket, a, b``: the pairs that make ``deep`` spanning forests of each bucket (of each cell of a large one).

    Without ``labels`` every class is a component. ``failed`` has the pairs that were verified in vain.
    """
    if labels is None:
        parts = buckets.withColumn("part", F.col("sig"))
    else:
        parts = buckets.join(labels.withColumnsRenamed({"v": "sig", "label": "part"}), "sig", "left").withColumn("part", F.coalesce("part", "sig"))
    if first:
        marked, outside = parts, F.col("sig") == F.col("bucket")
    else:
        several = (
            parts.groupBy("bucket", "part")
            .agg(F.count(F.lit(1)).alias("k"))
            .groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("parts"), F.max_by("part", F.struct("k", "part")).alias("main"))
            .where("parts > 1")
            .select("bucket", "main")
        )
        marked, outside = parts.join(several, "bucket"), F.col("part") != F.col("main")
    rows = _blocks(marked, outside, first).join(classes.select("sig", "point"), "sig")
    none = F.array().cast("array<bigint>")
    if failed is None:
        rows = rows.withColumn("failed", none)
    else:
        vain = failed.groupBy(F.col("b").alias("sig")).agg(F.collect_set("a").alias("failed"))
        rows = rows.join(vain, "sig", "left").withColumn("failed", F.coalesce("failed", none))
    return _searched(rows, deep, percent)


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose shingle sets reach the similarity (``pairs`` is read more than once).

    One text of each class travels, not its set: compressed it is a fraction of it.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    # written first: where its size is small, the planner then broadcasts it and no text is shuffled
    wanted = materialise(classes.select("sig", "first_doc").join(ends, "sig").select("first_doc").distinct(), "wanted")

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([signature(s) for s in batch_sets(b.column(0))], pa.int64()), b.column(0)], names=["sig", "text"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(batch_sets(b.column(2)), batch_sets(b.column(3)), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append((100 + percent) * both >= needed(len(x), len(y), percent))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    texts = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["first_doc"]), "left_semi").where("text IS NOT NULL")
    found = materialise(texts.select("text").mapInArrow(named, "sig long, text string"), "texts")
    left, right = (found.withColumnsRenamed({"sig": s, "text": f"text_{s}"}) for s in ("a", "b"))
    # an id that stands for several rows may give a class several texts of one set
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(compared, PAIR).distinct()


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``v, label``: the least name that links lead to, for every end of a link; ``labels`` are those of the links before.

    Only links between different labels are followed: labels take the least of their neighbours'
    and then their label's label, until nothing changes; every round is written, so the
    lineage stays short.
    """
    if labels is not None:
        for end in ("a", "b"):
            named = labels.select(F.col("v").alias(end), F.col("label").alias(f"{end}_label"))
            links = links.join(named, end, "left").withColumn(end, F.coalesce(f"{end}_label", end)).drop(f"{end}_label")
    links = links.where("a <> b")
    edges = materialise(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    now = materialise(edges.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    changed = True
    while changed:
        near = edges.join(now.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        stepped = now.join(near, "v").select("v", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = now.select(F.col("v").alias("label"), F.col("label").alias("further"))
        moved = materialise(stepped.join(jump, "label", "left").select("v", "was", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        changed = not moved.where("was <> label").limit(1).isEmpty()
        now = moved.select("v", "label")
    if labels is None:
        return now
    further = now.select(F.col("v").alias("label"), F.col("label").alias("further"))
    old = labels.join(further, "label", "left").select("v", F.coalesce("further", "label").alias("label"))
    return materialise(old.unionByName(now.join(labels.select("v"), "v", "left_anti")), "labels")


def link_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The contract's columns: set size and component of every document."""
    rows = materialise(described(docs), "described")
    classes = materialise(classes_of(rows), "classes")
    buckets = materialise(buckets_of(prefix_keys(docs, frequency_levels(rows), percent), classes, percent), "buckets")
    # the first round compares large buckets only block by block, so they are searched again
    large = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > BLOCK).select("bucket")
    failed = labels = None
    pending, first, deep = buckets, True, 1
    while True:
        found = materialise(candidates(pending, classes, labels, failed, first, deep, percent), "found")
        pairs = materialise(found.select("a", "b").distinct(), "pairs")
        good = materialise(verified(pairs, classes, docs, percent), "links")
        bad = found.join(good, ["a", "b"], "left_anti")
        if not good.isEmpty():
            labels = components(good, labels)
        again = bad.select("bucket").union(large).distinct() if first else bad.select("bucket").distinct()
        pending = materialise(buckets.join(again, "bucket", "left_semi"), "pending")
        if pending.isEmpty():
            break
        lost = bad.select("a", "b").distinct()
        failed = materialise(lost if failed is None else failed.union(lost), "failed")
        first, deep = False, min(deep * MORE, MOST_FORESTS)
    if labels is None:
        labels = classes.select(F.col("sig").alias("v"), F.col("sig").alias("label")).where("false")
    return named_groups(rows, classes, labels)


def named_groups(rows: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` from the classes' labels."""
    firsts = classes.select("sig", "first_doc")
    joined = labels.join(firsts, labels["v"] == firsts["sig"])
    least = joined.groupBy("label").agg(F.min("first_doc").alias("least_doc"))
    renamed = labels.join(least, "label").select(F.col("v").alias("sig"), "least_doc")
    named = firsts.join(renamed, "sig", "left").select("sig", F.coalesce("least_doc", "first_doc").alias("component_id"))
    own = rows.where("chunk IS NULL").select("doc_id", "n", "sig")
    return own.join(named, "sig", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))

