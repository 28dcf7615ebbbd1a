"""SentencePiece encoding (merge type) by backtracking over longest matches, and decoding.

A text is normalised as the model says (one blank in front, blanks as the blank
mark) and cut where no piece can reach across: before a run of blank marks, and
around characters that no piece holds. For each such unit the encoder walks left
to right and takes the longest piece that an Aho-Corasick pass found there. A
piece may follow another only if merging their joined text afresh gives the same
two pieces again; otherwise the next shorter one is tried. A place from which
nothing fits is marked in a bit field and never entered again, because the pieces
before a place are determined by the place. Units repeat, so each worker keeps a
bounded table of encoded units.

Pieces of one score (the runs of blank marks) have no order among themselves, and
the pair check does not settle a row of them; a run of blanks that is not part of
a word is therefore merged directly, once per length.

Nulls and empty texts encode to nothing but the end id. Characters outside the
vocabulary become byte pieces. Repeated rows each give their own result, an empty
table an empty result, and extra columns are passed over.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.common import texts_of

#: Fixed values of the format: the blank mark.
BLANK = "▁"
#: Units, and pairs of pieces, kept per worker before the table starts anew.
MEMORY = 500_000
#: Characters of one unit matched at a time.
BLOCK = 2048

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class _Any(dict):
    """At the start of a unit any piece may stand."""

    def __bool__(self) -> bool:
        return True

    def get(self, key, default=None):
        return True


class Pieces:
    """The vocabulary of a merge-type model, its encoder and its decoder."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = sp.get_piece_size()
        self.end_id, self.unknown_id = sp.eos_id(), sp.unk_id()
        self.piece = [sp.id_to_piece(i) for i in range(size)]
        self.byte_of = {i: int(self.piece[i][3:5], 16) for i in range(size) if sp.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        self.silent = {i for i in range(size) if sp.is_control(i)}
        special = self.silent | set(self.byte_of) | {self.unknown_id}
        self.id_of = {self.piece[i]: i for i in range(size) if i not in special and not sp.is_unused(i)}
        self.score = {p: sp.get_score(i) for p, i in self.id_of.items()}
        self.longest = max(map(len, self.id_of))
        self.letters = {c for p in self.id_of for c in p}
        self._same: dict[int, dict[int, bool]] = {-1: _Any()}
        self._pairs = 0
        self._units: dict[str, str] = {}
        self._older: dict[str, str] = {}
        self._odd: dict[str, str] = {}
        self._automaton = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            if self.merge(p) == [p]:  # a piece that merging never makes is never output
                self._automaton.add_word(p, (len(p) - 1, i))
        self._automaton.make_automaton()
        # for each piece, the longest shorter piece that it begins with (-1: none)
        self.length = list(map(len, self.piece))
        self.shorter = [-1] * size
        for p, i in self.id_of.items():
            self.shorter[i] = next((self.id_of[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self._automaton), -1)
        # Units: blank marks with the word after them; a line end, which no piece holds, stands alone.
        self.unit = re.compile(rf"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n+")

    # ---------------------------------------------------------------- merging
    def merge(self, text: str) -> list[str]:
        """Merge a short text by definition: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the joined text of two pieces gives the two again."""
        x, y = self.piece[a], self.piece[b]
        known = self.merge(x + y) == [x, y]
        if self._pairs >= MEMORY:
            self._same, self._pairs = {-1: _Any()}, 0
        self._same.setdefault(a, {})[b] = known
        self._pairs += 1
        return known

    # ---------------------------------------------------------------- backtracking
    def _longest(self, text: str, begin: int, stop: int) -> list[int]:
        """For each place of a range, the id of the longest piece that begins there (-1: none)."""
        out = [-1] * (min(stop + self.longest, len(text)) - begin)
        for end, (before, i) in self._automaton.iter(text, begin, begin + len(out)):
            out[end - before - begin] = i  # a later end is a longer piece
        return out

    def backtrack(self, text: str) -> list[int]:
        """The ids of a text all of whose characters are pieces."""
        n = len(text)
        near = self._longest(text, 0, min(n, BLOCK))
        blocks: dict[int, list[int]] = {}
        failed = bytearray(n // 8 + 1)
        ids: list[int] = []
        fits, shorter, length = self.fits, self.shorter, self.length
        at, last, i = 0, -1, near[0] if n else -1
        while at < n:
            row = self._same.get(last) or {}
            while i >= 0:
                follows = row.get(i)
                if follows is None:
                    follows = fits(last, i)
                if follows:
                    to = at + length[i]
                    if not failed[to >> 3] >> (to & 7) & 1:
                        break
                i = shorter[i]
            if i >= 0:
                ids.append(i)
                at, last = to, i
                if at >= n:
                    break
                if at < BLOCK:
                    i = near[at]
                    continue
                k = at // BLOCK
                if k not in blocks:
                    if len(blocks) >= 3:
                        blocks.clear()
                    blocks[k] = self._longest(text, k * BLOCK, min((k + 1) * BLOCK, n))
                i = blocks[k][at - k * BLOCK]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                if not ids:
                    raise ValueError(f"no encoding of {text[:80]!r}")
                i = ids.pop()
                at -= length[i]
                last = ids[-1] if ids else -1
                i = shorter[i]
        return ids

    def _blanks(self, n: int) -> list[str]:
        """Pieces of a run of blank marks: merged by definition, candidates held in a heap.

        A part is known by its length alone; a candidate counts only if both of its
        parts are still as long as they were when it was made.
        """
        following, before, length = list(range(1, n + 1)), list(range(-1, n - 1)), [1] * n
        heap: list[tuple[float, int, int, int]] = []

        def consider(i: int) -> None:
            j = following[i] if i >= 0 else n
            if j < n and (score := self.score.get(BLANK * (length[i] + length[j])) if length[i] + length[j] <= self.longest else None) is not None:
                heapq.heappush(heap, (-score, i, length[i], length[j]))

        for i in range(n - 1):
            consider(i)
        while heap:
            _, i, own, next_ = heapq.heappop(heap)
            j = following[i]
            if length[i] != own or j >= n or length[j] != next_:
                continue
            length[i], length[j] = own + next_, 0  # a part that is used up has no length
            following[i] = following[j]
            if following[j] < n:
                before[following[j]] = i
            consider(before[i])
            consider(i)
        return [BLANK * k for k in length if k]

    def _unit_ids(self, unit: str) -> list[int]:
        """Ids of one unit: its known stretches encoded, other characters as bytes."""
        if unit[:2] != BLANK * 2 and self.letters.issuperset(unit):
            return self.backtrack(unit)
        ids: list[int] = []
        word = unit.lstrip(BLANK)
        blanks = len(unit) - len(word)
        if blanks > 1:
            # the last mark stays with the word whenever a word follows that can take it
            keep = bool(word) and word[0] in self.letters and self._joins(word)
            ids += [self.id_of[p] for p in self._blanks(blanks - keep)]
            unit = BLANK + word if keep else word
        for stretch in self._stretches(unit):
            if stretch[0] in self.letters:
                ids += self.backtrack(stretch)
            else:
                ids += [self.id_of_byte[b] for b in stretch.encode("utf-8", "surrogatepass")]
        return ids

    def _joins(self, word: str) -> bool:
        """Whether a blank mark before ``word`` becomes part of the word's first piece."""
        first = next(self._stretches(word))
        return len(self.piece[self.backtrack(BLANK + first)[0]]) > 1

    def _stretches(self, unit: str) -> Iterator[str]:
        at = 0
        for i in range(1, len(unit) + 1):
            if i == len(unit) or (unit[i] in self.letters) != (unit[at] in self.letters):
                yield unit[at:i]
                at = i

    # ---------------------------------------------------------------- texts
    def _encoded(self, unit: str) -> str:
        """Ids of a unit not at hand, as text; what it decodes to is noted if that is not the unit."""
        known = self._older.get(unit) if len(unit) <= 64 else None
        if known is None:
            ids = self._unit_ids(unit)
            known = " ".join(map(str, ids))
            # pieces that spell the unit decode to it (byte pieces spell no character that needs them)
            spelt = "".join(map(self.piece.__getitem__, ids)) == unit
            back = unit.replace(BLANK, " ") if spelt else self.decode_marks(ids)
            if back != unit.replace(BLANK, " "):
                if len(self._odd) >= MEMORY:  # what is noted and what is at hand go together
                    self._odd, self._units, self._older = {}, {}, {}
                self._odd[unit] = back
        if len(unit) <= 64:
            if len(self._units) >= MEMORY:  # units met since the last turn stay at hand for one more
                self._older, self._units = self._units, {}
            self._units[unit] = known
        return known

    def units(self, text: str) -> tuple[list[str], str]:
        """The units of a text, and all its ids as text without the end id."""
        if not text:
            return [], ""
        units = self.unit.findall(BLANK + text.replace(" ", BLANK))
        get, encoded = self._units.get, self._encoded
        if len(self._units) >= MEMORY // 2:  # the dictionary may be exchanged on the way
            return units, " ".join([self._units.get(u) or encoded(u) for u in units])
        return units, " ".join([get(u) or encoded(u) for u in units])

    def encode(self, text: str) -> list[int]:
        """Ids of a text, the end id last."""
        return [*map(int, self.units(text)[1].split()), self.end_id]

    def decode_marks(self, ids: list[int]) -> str:
        """The text of ids, blank marks as blanks; a run of byte pieces is read as UTF-8."""
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            if i not in self.silent:
                out.append(self.piece[i].replace(BLANK, " "))
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: without the one blank that encoding puts in front."""
        return self.decode_marks(ids).removeprefix(" ")

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of the ids' text and of the decoded text."""
        units, ids = self.units(text)
        ids = f"{ids} {self.end_id}" if ids else str(self.end_id)
        marked = "".join([self._odd.get(u, u) for u in units]) if self._odd else "".join(units)
        whole = marked.replace(BLANK, " ").removeprefix(" ")
        return ids.count(" ") + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest()


@lru_cache(maxsize=1)
def load(model_file: str) -> Pieces:
    """The model, read once per worker."""
    return Pieces(model_file)


def encode_documents(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``ids`` (array of int, the end id last)."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_file)
        for b in batches:
            ids = pa.array((pieces.encode(t) for t in texts_of(b.column(1))), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(encoded, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model_file: str) -> DataFrame:
    """The reverse of :func:`encode_documents`: ``doc_id`` and ``text``."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_file)
        for b in batches:
            texts = pa.array((pieces.decode(x.as_py() or []) for x in b.column(1)), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), texts], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(decoded, "doc_id long, text string")


def digest(docs: DataFrame, model_file: str) -> DataFrame:
    """The contract's columns, encoding and decoding each text in one pass."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_file)
        for b in batches:
            rows = [pieces.digests(t) for t in texts_of(b.column(1))]
            n, ids, texts = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(digested, SCHEMA)
