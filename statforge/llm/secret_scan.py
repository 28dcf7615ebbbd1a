"""Secret scan: keyword automaton, anchored expressions at its hits, embedded checksums.

One Aho-Corasick pass over the ASCII-lowered text finds every keyword; an
expression is then matched only at those places, anchored there. Runs of
hexadecimal digits have no keyword: a run of 24 covers three neighbouring points
of the grid of every eighth character, so the grid is searched for three
hexadecimal digits in a row and the run around each find is measured.

Kinds, in the order used for ties:

* ``assign``  a secret-like name, ``=`` or ``:``, and a value of 6 or more characters
* ``access``  an access key id of 20 or more characters
* ``hex``     24 or more lower-case hexadecimal digits
* ``github``, ``npm``  prefixed tokens whose last six characters are the base-62
  CRC-32 of the 30 before them; a token whose checksum differs is dropped

The first three are found exactly as scanning left to right, non-overlapping per
kind, would find them; the checked kinds only add spans.

Nulls and empty texts give no spans. Repeated rows each give their own result, an
empty table gives an empty result, and extra columns are passed over.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.common import texts_of

KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = KINDS[:3]
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
GRID = 8

# Names, prefixes and alphabets of the secret formats.
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS_PREFIX = "AKIA"
TOKEN_PREFIXES = {"ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm"}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_GRID_HEX = re.compile(rf"[0-9a-f]{{{MIN_HEX // GRID},}}")
_HEX = re.compile(r"[0-9a-f]+")
_TOKEN = re.compile(r"[a-z]{3}_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")

SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"


def checksum62(body: str) -> str:
    """Six base-62 digits of the CRC-32 of ``body``."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word in ASSIGN_NAMES:
        a.add_word(word, (len(word), "assign"))
    a.add_word(ACCESS_PREFIX.lower(), (len(ACCESS_PREFIX), "access"))
    for word in TOKEN_PREFIXES:
        a.add_word(word, (len(word), "token"))
    a.make_automaton()
    return a


def _hex_runs(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for hit in _GRID_HEX.finditer(text[GRID - 1 :: GRID]):
        # points of several runs may stand side by side on the grid
        for start in range(GRID - 1 + hit.start() * GRID, GRID - 1 + hit.end() * GRID, GRID):
            if start < done:
                continue
            while start > 0 and text[start - 1] in "0123456789abcdef":
                start -= 1
            done = _HEX.match(text, start).end()
            if done - start >= MIN_HEX:
                yield start, done


def scan(text: str) -> list[tuple[str, int, int]]:
    """All spans of one text as ``(kind, start, end)`` in code points, by start, then kind."""
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # ASCII letters only
    hits = sorted((end - length + 1, what) for end, (length, what) in _automaton().iter(lowered))
    found = [("hex", s, e) for s, e in _hex_runs(text)]
    past_assign = past_access = 0
    for at, what in hits:
        if what == "assign":
            if at >= past_assign and (m := _ASSIGN.match(text, at)):
                past_assign = m.end()
                if len(m[1]) >= MIN_VALUE:
                    found.append(("assign", at, m.end()))
        elif what == "access":
            if at >= past_access and (m := _ACCESS.match(text, at)):
                past_access = m.end()
                if m.end() - at >= MIN_ACCESS:
                    found.append(("access", at, m.end()))
        elif text[at : at + 4] in TOKEN_PREFIXES and (at == 0 or not text[at - 1].isalnum()):
            m = _TOKEN.match(text, at)
            if m and checksum62(m[1]) == m[2]:
                found.append((TOKEN_PREFIXES[text[at : at + 4]], at, m.end()))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and its spans (an array, empty where nothing is found)."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in scan(t)] for t in texts_of(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(scanned, SCHEMA)


def span_text(spans, kinds=None):
    """``kind:start:end`` joined by commas, of all spans or of some kinds (a column)."""
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds)) if kinds else spans
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: counts of the base kinds, digest of base spans, all spans."""
    found = find_secrets(docs)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *[count(k) for k in BASE_KINDS],
        F.sha2(span_text(F.col("spans"), BASE_KINDS), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
