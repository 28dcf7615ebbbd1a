"""Helpers shared by the operators: table access, shared scratch tables, Arrow text, word hashes.

Words are maximal runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``; all of these
separators are ASCII, so cutting UTF-8 bytes at them is the same as cutting the
text. :func:`word_hashes` gives one 64-bit hash per word for a whole Arrow text
column with array operations only, working through the bytes in bounded pieces.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statforge.session import scratch_path

#: Bytes of text whose temporaries are in memory at once (a longer word makes a longer piece).
PIECE_BYTES = 1 << 20
#: Rows, at most, of an Arrow batch.
BATCH_ROWS = 1000
#: Shingle length in words for everything that compares texts by word shingles.
SHINGLE_WORDS = 5


# --------------------------------------------------------------------------- Spark side
def package_root() -> str:
    return os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    A cluster submit ships the package with ``--py-files``; on one machine, or
    on a shared folder, the driver's own path is enough.
    """
    # texts reach the workers in batches of a few megabytes, not of ten thousand documents
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    env = spark.sparkContext.environment
    root = package_root()
    have = env.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, have) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_bucket(id_col, modulus: int):
    """``crc32`` of an id's decimal text modulo ``modulus`` (the fold rule of the contracts)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


#: Arrays that one task of a tree sum adds up.
TREE_FANIN = 64
#: Pieces, about, in which an array that comes to the driver is summed.
FEW_CHUNKS = 16


def tree_summed(rows: DataFrame, kind: str, finish: Callable[[np.ndarray], np.ndarray] | None = None, fanin: int = TREE_FANIN, chunks: int | None = None) -> DataFrame:
    """``chunk, counts``: sums of the pieces of arrays that tasks emitted (``chunk, part, counts``).

    ``part`` numbers the tasks (a task may emit a piece again). The pieces of ``fanin`` tasks
    are added up first, then ``fanin`` of these sums, and so on, so the load of a summing task
    does not grow with the number of tasks; each array is added as it comes. Sums are long
    integers, or doubles if the pieces are; ``finish`` makes of them what is returned.
    ``chunks``, if known, is the number of different chunks: no more summing tasks are started than there are sums.
    """
    wide = np.dtype(np.float64 if np.dtype(kind).kind == "f" else np.int64)

    def summed(dtype: np.dtype, last):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for b in batches:
                for chunk, part, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                    own = np.frombuffer(counts.as_buffer(), dtype)
                    if (chunk, part) in total:
                        total[chunk, part] += own
                    else:
                        total[chunk, part] = own.astype(wide)
            if total:
                sums = [last(x) if last else x for x in total.values()]
                columns = [pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()), pa.array([x.tobytes() for x in sums], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "part", "counts"])

        return run

    pieces = rows.where("chunk IS NOT NULL").select("chunk", "part", "counts")
    tasks, dtype = max(rows.rdd.getNumPartitions(), 1), np.dtype(kind)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        tasks = -(-tasks // fanin)
        parts = n if chunks is None else min(n, chunks * tasks)
        pieces = pieces.withColumn("part", F.pmod("part", F.lit(tasks)).cast("int")).repartition(parts, "chunk", "part").mapInArrow(summed(dtype, finish if tasks == 1 else None), "chunk int, part int, counts binary")
        dtype = wide
        if tasks == 1:
            return pieces.select("chunk", "counts")


def summed_chunks(rows: DataFrame, kind: str) -> np.ndarray:
    """The sum of arrays that tasks emitted in pieces (see :func:`tree_summed`); it is of fixed size and comes to the driver."""
    wide = np.float64 if np.dtype(kind).kind == "f" else np.int64
    got = {r["chunk"]: np.frombuffer(r["counts"], wide) for r in tree_summed(rows, kind, chunks=FEW_CHUNKS).collect()}
    return np.concatenate([got[k] for k in sorted(got)]) if got else np.zeros(0, wide)


# --------------------------------------------------------------------------- Arrow side
def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of an Arrow string column, nulls as empty texts; no copy of the text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        column = column.cast(pa.string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(offsets) else raw, offsets - (offsets[0] if len(offsets) else 0)


def texts_of(column: pa.Array) -> Iterator[str]:
    """The texts one by one (null: empty)."""
    for x in column:
        yield x.as_py() or ""


def encoded_of(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of the texts one by one (null: empty)."""
    raw, offsets = text_buffers(column)
    for i in range(len(offsets) - 1):
        yield raw[offsets[i] : offsets[i + 1]].tobytes()


# --------------------------------------------------------------------------- word hashes
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
#: For comparing prose: every ASCII character but letters and digits separates.
PLAIN_WORDS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 0x20


def _odd(n: int, seed: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(0, 2**64, size=n, dtype=np.uint64) | np.uint64(1)


_BYTE = _odd(256, 1)
_BYTE_LOWER = _BYTE[_LOWER]
_STEP = int(_odd(1, 2)[0])
_STEP_BACK = pow(_STEP, -1, 2**64)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse modulo 2**64, at least ``n`` of each."""
    if "up" not in _powers or len(_powers["up"]) < n:
        for key, base in (("up", _STEP), ("down", _STEP_BACK)):
            steps = np.full(max(n, PIECE_BYTES + 1), base, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pieces(raw: np.ndarray, cuts: np.ndarray, sep: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``PIECE_BYTES`` that end at a text's end or at a separator."""
    at, end = 0, len(raw)
    while at < end:
        stop = min(at + PIECE_BYTES, end)
        while stop < end:
            k = np.searchsorted(cuts, stop, side="right") - 1
            back = np.flatnonzero(sep[raw[max(at, stop - 65536) : stop]])
            if len(back):
                stop = max(at, stop - 65536) + int(back[-1]) + 1
                break
            if k >= 0 and cuts[k] > at:
                stop = int(cuts[k])
                break
            stop = min(stop + PIECE_BYTES, end)
        yield at, stop
        at = stop


def word_spans(raw: np.ndarray, offsets: np.ndarray, sep: np.ndarray = _SEP) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word of a small text buffer."""
    word = ~sep[raw]
    first = word.copy()
    first[1:] &= ~word[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(raw))]
    first[cuts] |= word[cuts]
    starts = np.flatnonzero(first)
    # a word ends before the next separator or text start
    stop = ~word
    stop[cuts] = True
    stops = np.append(np.flatnonzero(stop), len(raw))
    ends = stops[np.searchsorted(stops, starts, side="right")] if len(starts) else starts
    return starts, ends


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = True, sep: np.ndarray = _SEP) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the range of its words.

    Returns ``(hashes, bounds)``; the words of text ``i`` are
    ``hashes[bounds[i]:bounds[i + 1]]``. ``lower`` hashes ``A-Z`` as ``a-z``.
    """
    values = _BYTE_LOWER if lower else _BYTE
    parts, positions = [], []
    for at, stop in _pieces(raw, offsets, sep):
        piece = raw[at:stop]
        starts, ends = word_spans(piece, offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, stop, side="right")] - at, sep)
        if not len(starts):
            continue
        up, down = _power_tables(len(piece) + 1)
        total = np.empty(len(piece) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(values[piece] * up[: len(piece)], out=total[1:])
        h = (total[ends] - total[starts]) * down[starts]
        parts.append(mix(h + (ends - starts).astype(np.uint64)))
        positions.append(starts + at)
    hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    where = np.concatenate(positions) if positions else np.zeros(0, np.int64)
    return hashes, np.searchsorted(where, offsets)


_GRAM = _odd(64, 3)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words (order matters), one for each start."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[: len(words) - n + 1] * _GRAM[0]
    for k in range(1, n):
        out += words[k : len(words) - n + 1 + k] * _GRAM[k]
    return mix(out)


def whole_hash(words: np.ndarray) -> np.ndarray:
    """One hash for a sequence shorter than a shingle; its length is part of it."""
    total = np.array([(words * _GRAM[: len(words)]).sum(dtype=np.uint64)], dtype=np.uint64)
    return mix(total + np.uint64(0x9E3779B97F4A7C15 * len(words) % 2**64))


def shingle_set(words: np.ndarray, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer than ``n`` words make one shingle, no words none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(gram_hashes(words, n)) if len(words) >= n else whole_hash(words)
