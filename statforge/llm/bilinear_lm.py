"""Language-model scoring with a log-bilinear neural model trained by noise contrast.

Corpus counts come first: every training text's tokens are counted in Spark. From
them the model takes its classes: the most frequent words (and the text's end) stand
alone, the more of them the more distinct words the corpus has (``own_classes``), every other word falls into one of ``SHARED`` classes by a hash,
where its probability is its smoothed share of the class (one count is kept for
words never seen). Over classes a log-bilinear model predicts the next class from
the two before it: context vectors, weighted per place and dimension, are added up
and multiplied with the class vectors.

Training runs in numpy inside Spark tasks over all training texts. A hash of the row
deals the texts, once and as class numbers, to parts of about ``PART`` tokens, so the
model does not hang on how the table is laid out in files. In each round parts
descend the noise-contrastive loss from the shared start; the results (and the sums
that set the step sizes) are averaged by their numbers of tokens, and the next round
starts there. The first round takes an eighth of the parts, each further one twice as
many, until one has taken all; from then on rounds take all parts, until the averaged
loss falls by less than ``LEAST_GAIN`` of it. So every training text is learnt from.
Then matrix products over all pairs of context classes give the normaliser of
every context, so each token's log probability is exact and normalised.

Scoring reads every text once. The ``HEAD`` most frequent words are at hand in each
worker; only the other words travel, as one row per document and word, to be
joined with their counts.

A null or empty text is the end token alone. Repeated rows are scored each. With
no training text every count is zero: base scores use ``N = V = 0`` and the model
falls back on uniform classes. An empty table gives an empty result; extra columns
are passed over.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.common import crc_bucket, materialise, summed_chunks, text_buffers

#: The fold rule: rows whose id hashes to ``HELD_OUT`` of ``FOLDS`` are never learnt from.
FOLDS, HELD_OUT = 7, 2
#: Words with a class of their own (the end included), least and most, and classes that the others share.
OWN, MOST_OWN, SHARED = 960, 1984, 64
#: The first round takes one part in so many.
FIRST_SHARE = 8
#: Words, at most, that every worker has at hand.
HEAD = 150_000
#: Vector length, tokens a step, noise samples a step, step size.
DIM, STEP, NOISE, RATE = 16, 2048, 48, 0.15
#: Tokens, about, that one descent of a round sees; of so many steps, and of so many tokens in them, one's loss is taken.
PART, LOSS_STEPS = 1 << 21, 8
#: Rows that are scaled at once.
ROWS = 64
#: Share of the loss that a round must gain for another one.
LEAST_GAIN = 0.002
#: The end of a text as a word (no word holds a separator).
END = b"\n"
#: Words, about, that a task counts at a time.
FLUSH = 1 << 21
#: Bytes of text, about, whose words are looked up at a time, and tokens that a descent works on at a time.
GROUP_BYTES, GROUP = 1 << 22, 1 << 17
PARAMETER_CHUNKS = 16

COUNTED = "word string, n long"
SCORED = "rid long, word string, n long, doc struct<doc_id:long,held_out:boolean,n_tokens:long,known:long,base:double,score:double>"


# --------------------------------------------------------------------------- counts and vocabulary
def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased (``A-Z`` only) words of all texts in order, and how many each text has (null: none).

    Arrow's ASCII white space is exactly the separators of a word; what is empty between them is left out.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts if pa.types.is_string(texts.type) else texts.cast(pa.string())))
    words, sizes = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    filled = pc.greater(pc.binary_length(words), 0)
    owner = np.repeat(np.arange(len(texts)), sizes)[filled.to_numpy(zero_copy_only=False)]
    return words.filter(filled), np.bincount(owner, minlength=len(texts))


def grouped(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in stretches of about ``GROUP_BYTES`` (of one text at least)."""
    offsets, at = text_buffers(texts)[1], 0
    while at < len(texts):
        stop = max(int(np.searchsorted(offsets, offsets[at] + GROUP_BYTES, side="right")) - 1, at + 1)
        yield texts.slice(at, stop - at)
        at = stop


def training(docs: DataFrame) -> DataFrame:
    return docs.where(crc_bucket(F.col("doc_id"), FOLDS) != HELD_OUT)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, c`` over the training texts, the end of a text included."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def rows() -> pa.RecordBatch:
            found = pa.chunked_array(held, pa.string()).value_counts()
            held.clear()
            return pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "n"])

        tokens = ends = 0
        for b in batches:
            for texts in grouped(b.column(0)):
                held.append(words_of(texts)[0])
                tokens, ends = tokens + len(held[-1]), ends + len(texts)
                if tokens >= FLUSH:
                    yield rows()
                    tokens = 0
        if ends:
            held.append(pa.array([END.decode()] * ends, pa.string()))
            yield rows()

    texts = training(docs).select(F.col("text").alias("text"))
    return texts.mapInArrow(counted, COUNTED).groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Vocabulary:
    """Corpus totals, the words at hand with their counts, and the classes."""

    tokens: int
    types: int
    index: dict[bytes, int]
    count: np.ndarray  # of the words at hand
    word_class: np.ndarray  # of the words at hand
    class_mass: np.ndarray  # tokens in each class
    class_log: np.ndarray  # log10 of what a shared class divides by; 0 for words that stand alone

    @property
    def classes(self) -> int:
        return len(self.class_mass)

    def words(self) -> pa.Array:
        """The words at hand, in the order of their places."""
        return pa.array(list(self.index), pa.binary()).cast(pa.string())


def own_classes(types: int) -> int:
    """Words with a class of their own: twice the square root of the distinct words, within limits (the
    normalisers of all contexts are a table of classes squared)."""
    return int(min(max(2 * np.sqrt(types), OWN), MOST_OWN))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals, head and classes from the written counts."""
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    # words by eighths of a doubling of their count: a small histogram that sets the head's limit
    step = F.floor(F.log2("c") * 8)
    histogram = sorted(((r["b"], r["count"]) for r in counts.groupBy(step.alias("b")).count().collect()), reverse=True)
    room, least = HEAD, None
    for b, k in histogram:
        if k > room:
            break
        room, least = room - k, b
    head = [] if least is None else counts.where(step >= least).select("word", "c").collect()  # at most HEAD rows, by the histogram
    head = sorted(((r["word"].encode(), r["c"]) for r in head), key=lambda x: (-x[1], x[0]))
    mass = {r["k"]: (r["c"], r["v"]) for r in counts.groupBy((F.crc32(F.col("word").cast("binary")) % SHARED).alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()}

    own = [END, *[w for w, _ in head if w != END][: own_classes(int(total["v"])) - 1]]
    number = {w: k for k, w in enumerate(own)}
    index = {w: k for k, (w, _) in enumerate(head)}
    count = np.array([c for _, c in head], dtype=np.int64)
    size = len(own) + SHARED
    word_class = np.array([number.get(w, len(own) + zlib.crc32(w) % SHARED) for w, _ in head], dtype=np.int32)
    class_mass = np.zeros(size)
    shared_types = np.zeros(size)
    for k, (c, v) in mass.items():
        class_mass[len(own) + k], shared_types[len(own) + k] = c, v
    for w, k in number.items():
        c = int(count[index[w]]) if w in index else 0
        class_mass[k] = c
        if c:
            class_mass[len(own) + zlib.crc32(w) % SHARED] -= c
            shared_types[len(own) + zlib.crc32(w) % SHARED] -= 1
    class_log = np.zeros(size)
    class_log[len(own) :] = np.log10(class_mass[len(own) :] + shared_types[len(own) :] + 1)
    return Vocabulary(int(total["n"] or 0), int(total["v"]), index, count, word_class, class_mass, class_log)


# --------------------------------------------------------------------------- model
@dataclass
class Bilinear:
    """Context vectors, class vectors, place weights, biases."""

    context: np.ndarray
    target: np.ndarray
    near: np.ndarray
    far: np.ndarray
    bias: np.ndarray

    @staticmethod
    def start(mass: np.ndarray, dim: int = DIM) -> Bilinear:
        rng = np.random.Generator(np.random.PCG64(17))
        k = len(mass)
        p = (mass + 1) / (mass + 1).sum()
        draw = lambda: (rng.standard_normal((k, dim)) * 0.1).astype(np.float32)
        one = np.ones(dim, np.float32)
        return Bilinear(draw(), draw(), one, one * 0.5, np.log(p).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.target, self.near, self.far, self.bias)])

    @staticmethod
    def of(flat: np.ndarray, classes: int, dim: int = DIM) -> Bilinear:
        flat = flat.astype(np.float32)
        cuts = np.cumsum([classes * dim, classes * dim, dim, dim])
        c, t, n, f, b = np.split(flat, cuts)
        return Bilinear(c.reshape(classes, dim), t.reshape(classes, dim), n, f, b)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Score of each class after each nearer class, and after each farther one."""
        return (self.context * self.near) @ self.target.T + self.bias, (self.context * self.far) @ self.target.T

    def normalisers(self) -> np.ndarray:
        """Log of the sum over all classes, for every pair (nearer, farther) of context classes.

        ``sum exp(x + y) = sum exp(x - max x) exp(y - max y)`` up to the two maxima, so
        one matrix product of the two exponentiated tables gives every context.
        """
        near, far = (t.astype(np.float64) for t in self.tables())
        top_near, top_far = near.max(axis=1), far.max(axis=1)
        product = np.exp(near - top_near[:, None]) @ np.exp(far - top_far[:, None]).T
        return np.log(np.maximum(product, 1e-300)) + top_near[:, None] + top_far[None, :]


def contexts(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearer and farther class before each token of texts that each close with class 0."""
    near = np.concatenate([[0], classes[:-1]]).astype(classes.dtype)
    far = np.concatenate([[0, 0], classes[:-2]]).astype(classes.dtype)[: len(classes)]
    return near, np.where(near == 0, 0, far)


def scaled(rows: np.ndarray, same: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Rows times one row, of which ``same`` holds copies: as many rows at a time, as short ones are slow one by one."""
    many = len(rows) // len(same) * len(same)
    np.multiply(rows[:many].reshape(-1, same.size), same.reshape(-1), out=out[:many].reshape(-1, same.size))
    if many < len(rows):
        np.multiply(rows[many:], same[0], out=out[many:])
    return out


class Trainer:
    """Noise-contrastive descent (adaptive steps) over minibatches of tokens.

    Tables have two more columns than vectors have dimensions (1 and 1 after a
    context's, the bias and minus the log of the noise after a class's), so one product gives a whole score; only the bias of these is learnt.
    Gradients are added up in double precision, two columns at a time as the parts of a complex number.
    """

    def __init__(self, model: Bilinear, square: Bilinear, mass: np.ndarray, seed: list[int], with_loss: bool = True):
        k, self.wide = len(mass), DIM + 2 + DIM % 2
        p = (mass + 1) / (mass + 1).sum()
        self.cdf = np.cumsum(p)
        self.log_noise = np.log(NOISE * p).astype(np.float32)

        def tables(y: Bilinear, rest: float) -> tuple[Bilinear, list[np.ndarray]]:
            context, target = np.full((2, k, self.wide), rest, np.float32)
            near, far = np.full((2, self.wide), rest, np.float32)
            context[:, :DIM], target[:, :DIM], target[:, DIM], near[:DIM], far[:DIM] = y.context, y.target, y.bias, y.near, y.far
            return Bilinear(context[:, :DIM], target[:, :DIM], near[:DIM], far[:DIM], target[:, DIM]), [context, target, near, far]

        self.m, self.tables = tables(model, 0)
        self.s, self.squares = tables(square, 1)
        context, target, near, _ = self.tables
        context[:, DIM : DIM + 2] = near[DIM : DIM + 2] = 1
        target[:, DIM + 1] = -self.log_noise
        self.rng = np.random.Generator(np.random.PCG64(seed))
        self.tokens = self.steps = self.loss_tokens = 0
        self.loss, self.with_loss = 0.0, with_loss
        self.room = np.empty((0, k), np.float32)
        self.same = np.empty((2, ROWS, self.wide), np.float32)
        self.seen, self.place = np.zeros(k, bool), np.zeros(k, np.intp)

    def _scatter(self, rows: np.ndarray, values: np.ndarray, columns: int, size: int) -> np.ndarray:
        pairs = values.view(np.complex64).T[: -(-columns // 2)].astype(np.complex128, order="C")
        sums = np.zeros((len(pairs), size), np.complex128)
        for total, pair in zip(sums, pairs, strict=True):
            np.add.at(total, rows, pair)
        out = np.zeros((size, self.wide), np.float32)
        out.view(np.complex64)[:, : len(pairs)] = sums.T
        out[:, columns:] = 0
        return out

    def _add_loss(self, hidden: np.ndarray, word: np.ndarray) -> None:
        """The exact loss of every so many of the tokens, over all classes."""
        hidden, word = np.ascontiguousarray(hidden[::LOSS_STEPS, : DIM + 1]), word[::LOSS_STEPS]
        if len(self.room) < len(hidden):
            self.room = np.empty((len(hidden), len(self.cdf)), np.float32)
        every = np.matmul(hidden, self.tables[1][:, : DIM + 1].T, out=self.room[: len(hidden)])
        top, taken = every.max(axis=1), every[np.arange(len(every)), word]
        every -= top[:, None]
        total = (np.exp(every, out=every) @ np.ones(len(self.cdf), np.float32)).astype(np.float64)
        self.loss += float((np.log(total) + top - taken).sum())
        self.loss_tokens += len(every)

    def noise(self, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """Noise of some steps, each one's sorted, and the number of each among the different ones of its step."""
        found = np.searchsorted(self.cdf, np.sort(self.rng.random((steps, NOISE)), axis=1))
        found = np.minimum(found, len(self.cdf) - 1)
        number = np.zeros(found.shape, np.intp)
        np.cumsum(found[:, 1:] != found[:, :-1], axis=1, out=number[:, 1:])
        return found, number

    def step(self, near: np.ndarray, far: np.ndarray, word: np.ndarray, drawn: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        """One descent on tokens that follow each other, with the contexts that :func:`contexts` gives them.

        A token is the nearer context of the next one and mostly the farther of the one after, so what it
        is due as a context is added up before it is scattered; the few other farther contexts come last.
        Only the classes that the step meets are worked on: the others' gradients are zero.
        """
        n, (context, target, by_near, by_far) = len(word), self.tables
        noise, number = drawn or (x[0] for x in self.noise(1))
        times = np.bincount(number)
        noise, times = noise[np.cumsum(times) - times], times.astype(np.float32)[:, None]

        before = np.concatenate([far[:1], near[:1], word])  # two places ahead of the words
        odd = np.flatnonzero(far != before[:n])
        every = np.concatenate([before, far[odd], noise])
        self.seen[every] = True
        met = np.flatnonzero(self.seen)
        self.seen[met] = False
        self.place[met] = np.arange(len(met))
        every = self.place[every]  # from here on classes are numbered among those met
        before, other_far, noise = np.split(every, [n + 2, n + 2 + len(odd)])
        far, near, met_word = before[:n].copy(), before[1 : n + 1], before[2:]
        far[odd] = other_far

        vectors, classes = context.take(met, axis=0), target.take(met, axis=0)
        hidden = (vectors * by_near).take(near, axis=0)
        hidden += (vectors * by_far).take(far, axis=0)
        own, other = classes.take(met_word, axis=0), classes.take(noise, axis=0)
        with np.errstate(over="ignore"):
            pull = (hidden * own) @ np.ones(self.wide, np.float32)  # 1 / (1 + exp(-(scores + bias - log noise))) - 1
            np.negative(pull, out=pull)
            pull = 1 / (1 + np.exp(pull, out=pull)) - 1
            push = hidden @ (-other).T  # 1 / (1 + exp(-(scores + bias - log noise)))
            np.exp(push, out=push)
            push += 1
            np.divide(1, push, out=push)
        if self.with_loss and self.steps % LOSS_STEPS == 0:  # of the same tokens in every round
            self._add_loss(hidden, word)
        self.steps += 1
        times /= n  # gradients are means over the tokens
        pull /= n
        back = push @ (other * times)
        own *= pull[:, None]
        back += own  # of the last places nothing is read
        against = push.T @ hidden
        against *= times
        hidden *= pull[:, None]
        to_target = self._scatter(met_word, hidden, DIM + 1, len(met))
        to_target[noise, : DIM + 1] += against[:, : DIM + 1]

        due = np.empty((n + 2 + len(odd), self.wide), np.float32)
        due[0] = due[n + 1] = 0
        self.same[0], self.same[1] = by_near, by_far
        scaled(back, self.same[0], due[1 : n + 1])
        farther = scaled(back, self.same[1], own)
        due[n + 2 :] = farther[odd]
        farther[odd] = 0
        due[:n] += farther
        to_context = self._scatter(every[: len(due)], due, DIM, len(met))

        one = np.ones(n, np.float32)
        places = [one @ (back * vectors.take(x, axis=0)) for x in (near, far)]
        for g in places:
            g[DIM:] = 0
        squares = [*(x.take(met, axis=0) for x in self.squares[:2]), *self.squares[2:]]
        for x, g, s in zip((vectors, classes, by_near, by_far), (to_context, to_target, *places), squares, strict=True):
            s += g * g
            g *= np.float32(RATE)
            g /= np.sqrt(s)
            x -= g
        for table, rows in zip((context, target, *self.squares[:2]), (vectors, classes, *squares[:2]), strict=True):
            table[met] = rows
        self.tokens += n

    def learn(self, classes: np.ndarray) -> None:
        classes = classes.astype(np.intp)  # what indexing and counting take without a copy
        near, far = contexts(classes)
        noise, number = self.noise(-(-len(classes) // STEP))
        for k, at in enumerate(range(0, len(classes), STEP)):
            self.step(near[at : at + STEP], far[at : at + STEP], classes[at : at + STEP], (noise[k], number[k]))


def class_ids(words: pa.Array, sizes: np.ndarray, at_hand: pa.Array, word_class: np.ndarray, own: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Tokens of texts, the end after each: place among the words at hand (-1: not there; the end's is ``end``)
    and class of every token, and where each text's tokens begin; text and word of every word not at hand."""
    found = pc.fill_null(pc.index_in(words, value_set=at_hand), -1).to_numpy()
    rare_at = np.flatnonzero(found < 0)
    rare = words.take(pa.array(rare_at))
    classes = word_class[found] if len(word_class) else np.zeros(len(found), np.int32)
    raw, offsets = text_buffers(rare)
    raw, cuts = memoryview(raw), offsets.tolist()
    classes[rare_at] = own + np.fromiter((zlib.crc32(raw[a:b]) % SHARED for a, b in pairwise(cuts)), np.int32, len(rare))
    text = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(found)) + text  # one end for every text before
    starts = np.cumsum(sizes + 1) - sizes - 1
    places, out = np.full(len(found) + len(sizes), end, np.int64), np.zeros(len(found) + len(sizes), np.int32)
    places[at], out[at] = found, classes
    return places, out, starts, text[rare_at], rare


def dealt(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``part, row, classes``: every training text as class numbers, in an order and parts set by hashes of the rows."""
    own, kind = vocab.classes - SHARED, np.min_scalar_type(vocab.classes)
    at_hand = docs.sparkSession.sparkContext.broadcast((vocab.words(), vocab.word_class))  # at most HEAD words
    parts = max(-(-vocab.tokens // PART), 1)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_at_hand, word_class = at_hand.value
        for b in batches:
            at = 0
            for texts in grouped(b.column(2)):
                _, classes, starts, *_ = class_ids(*words_of(texts), words_at_hand, word_class, own, -1)
                cuts = (np.append(starts, len(classes)) * kind.itemsize).astype(np.int32)
                out = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(cuts), pa.py_buffer(classes.astype(kind))])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), b.column(1).slice(at, len(texts)), out], names=["part", "row", "classes"])
                at += len(texts)

    row = F.xxhash64(F.col("doc_id").cast("string"), F.col("text"))
    rows = training(docs).select(row.alias("row"), F.col("text").alias("text")).select(F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part"), "row", "text")
    return rows.mapInArrow(encoded, "part int, row long, classes binary").repartitionById(parts, F.col("part")).sortWithinPartitions("part", "row")


def train(docs: DataFrame, vocab: Vocabulary) -> Bilinear:
    """Rounds of descent over all training texts, averaged by tokens, until the loss stops improving."""
    mass, kind = vocab.class_mass, np.min_scalar_type(vocab.classes)
    model = Bilinear.start(mass)
    square = Bilinear.of(np.full(len(model.flat()), 1e-6), len(mass))
    texts = dealt(docs, vocab).persist(StorageLevel.DISK_ONLY)
    parts = max(-(-vocab.tokens // PART), 1)
    before, k, taken = np.inf, 0, 0
    while True:
        whole = taken == parts  # the round before took all parts
        taken = min(-(-parts * 2**k // FIRST_SHARE), parts)

        def learned(batches: Iterator[pa.RecordBatch], start=(model.flat(), square.flat()), k=k, all_parts=taken == parts) -> Iterator[pa.RecordBatch]:
            trainer, at, held, size = None, None, [], 0

            def learn() -> None:
                if held:
                    trainer.learn(np.concatenate(held).astype(np.int32))
                    held.clear()

            def results() -> pa.RecordBatch:
                flat = np.concatenate([trainer.m.flat(), trainer.s.flat()]).astype(np.float64)
                weighted = np.append(np.append(flat, 1.0) * trainer.tokens, [trainer.loss, trainer.loss_tokens])
                pieces = [x.tobytes() for x in np.array_split(weighted, PARAMETER_CHUNKS)]
                return pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), pa.int32()), pa.array([at] * len(pieces), pa.int32()), pa.array(pieces, pa.binary())], names=["chunk", "part", "counts"])

            for b in batches:
                for part, classes in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    if part != at:
                        if trainer:
                            learn()
                            yield results()
                        trainer, at, size = Trainer(*(Bilinear.of(x, len(mass)) for x in start), mass, [part, k], all_parts), part, 0
                    held.append(np.frombuffer(classes.as_buffer(), kind))
                    size += len(held[-1])
                    if size >= GROUP:
                        learn()
                        size = 0
            if trainer:
                learn()
                yield results()

        total = summed_chunks(texts.where(F.col("part") < taken).select("part", "classes").mapInArrow(learned, "chunk int, part int, counts binary"), "float64")
        if not len(total):
            break
        loss = total[-2] / total[-1] if taken == parts else np.inf  # compared only after a round over all parts
        if whole and loss >= before:
            break
        flat = total[:-3] / total[-3]
        model, square = (Bilinear.of(x, len(mass)) for x in np.split(flat, 2))
        if whole and loss > (1 - LEAST_GAIN) * before:
            break
        before, k = loss, k + 1
    texts.unpersist()
    return model


# --------------------------------------------------------------------------- scores
def scores(docs: DataFrame, counts: DataFrame, vocab: Vocabulary, model: Bilinear) -> DataFrame:
    """The contract's columns for every document."""
    sc = docs.sparkSession.sparkContext
    near_table, far_table = model.tables()
    norm = model.normalisers().astype(np.float32)
    shared = sc.broadcast((vocab.words(), vocab.count, vocab.word_class, vocab.class_log, near_table, far_table, norm))  # HEAD words, three tables of classes squared
    own = vocab.classes - SHARED
    end = vocab.index.get(END, -1)
    to_log10 = 1 / np.log(10)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_hand, count, word_class, class_log, near_table, far_table, norm = shared.value
        log_count = np.append(np.log10(count + 1.0), 0.0)  # the last place: not at hand
        alone = np.append(word_class < own, False)
        kind = pa.struct([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
        for b in batches:
            row = 0
            for texts in grouped(b.column(3)):
                places, classes, starts, text, rare = class_ids(*words_of(texts), at_hand, word_class, own, end)
                near, far = contexts(classes)
                logs = (near_table[near, classes].astype(np.float64) + far_table[far, classes] - norm[near, far]) * to_log10
                inside = log_count[places]
                logs += np.where(alone[places], 0.0, inside) - class_log[classes]
                score, base, known = (np.add.reduceat(x, starts) for x in (logs, inside, (places >= 0).astype(np.int64)))
                if end < 0:  # the end is not at hand either
                    text, rare = np.append(text, np.arange(len(texts))), pa.concat_arrays([rare, pa.array([END.decode()] * len(texts), pa.string())])
                coded = rare.dictionary_encode()
                pairs, times = np.unique(text * len(coded.dictionary) + coded.indices.to_numpy(), return_counts=True)
                text, code = np.divmod(pairs, max(len(coded.dictionary), 1))

                # a row for each document, with a word that is none, so it meets no count; then its words not at hand
                n, more = len(texts), len(pairs)
                ids, doc_ids, held = (b.column(k).slice(row, n) for k in range(3))
                one = pa.array([f"\n{i}" for i in ids.to_pylist()], pa.string())
                padded = lambda x, to: pa.concat_arrays([x if isinstance(x, pa.Array) else pa.array(x), pa.nulls(more, to)])
                fields = [padded(x, f.type) for x, f in zip((doc_ids, held, np.diff(np.append(starts, len(classes))), known, base, score), kind, strict=True)]
                doc = pa.StructArray.from_arrays(fields, fields=list(kind), mask=pa.array(np.arange(n + more) >= n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(ids.to_numpy(), ids.to_numpy()[text])), pa.concat_arrays([one, coded.dictionary.take(pa.array(code))]), pa.array(np.append(np.zeros(n, np.int64), times)), doc],
                    names=["rid", "word", "n", "doc"],
                )
                row += n

    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (crc_bucket(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        F.col("text").alias("text"),
    )
    joined = rows.mapInArrow(scored, SCORED).join(counts, "word", "left")
    rare_log = F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0))
    whole = joined.groupBy("rid").agg(
        F.max("doc").alias("doc"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        rare_log.alias("rare_log"),
    )
    divide = float(np.log10(vocab.tokens + vocab.types + 1.0))
    return whole.select(
        "doc.doc_id",
        "doc.held_out",
        "doc.n_tokens",
        (F.col("doc.known") + F.col("rare_known")).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("doc.base") + F.col("rare_log") - F.col("doc.n_tokens") * F.lit(divide)).alias("base_score"),
        (F.col("doc.score") + F.col("rare_log")).alias("score"),
    )


def score_documents(docs: DataFrame) -> DataFrame:
    """Count, train and score."""
    counts = materialise(word_counts(docs), "counts")
    vocab = vocabulary(counts)
    return scores(docs, counts, vocab, train(docs, vocab))
