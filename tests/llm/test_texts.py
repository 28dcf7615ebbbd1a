"""Operators that work text by text: secrets, pieces, quality rules."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from statforge.llm import pieces, quality_rules, secret_scan
from statforge.llm.common import table, text_buffers, word_hashes
from statforge.llm.queries import QUERIES, piece_model
from tests.llm.conftest import SF

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


# --------------------------------------------------------------------------- shared word hashes
def test_words_are_cut_like_the_pattern_says(monkeypatch):
    from statforge.llm import common

    texts = ["", "a", " a  B\tb c\x85d\x1ce \n", "x" * 5000 + " y", "é日 🙂\x0bz", "tail ", " ", "A a"]
    for piece in (1 << 20, 64):  # long texts are worked through in pieces
        monkeypatch.setattr(common, "PIECE_BYTES", piece)
        h, bounds = word_hashes(*text_buffers(pa.array(texts)), lower=True)
        seen: dict[bytes, int] = {}
        for i, t in enumerate(texts):
            words = [w.lower() for w in WORD.findall(t.encode())]
            assert bounds[i + 1] - bounds[i] == len(words)
            for w, x in zip(words, h[bounds[i] : bounds[i + 1]].tolist(), strict=True):
                assert seen.setdefault(w, x) == x
        assert len(set(seen.values())) == len(seen)


def test_sliced_and_null_columns():
    column = pa.array(["skip", "a b", None, "c"])[1:]
    raw, offsets = text_buffers(column)
    assert raw.tobytes() == b"a bc" and offsets.tolist() == [0, 3, 3, 4]


# --------------------------------------------------------------------------- secrets
ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_secrets(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def test_base_secrets_equal_a_plain_scan(documents):
    r = random.Random(3)
    bits = ["password", "PassWd", "token", "api_key", "apikey", "secret", "=", ":", ' "', "'", " ", "AKIA", "AKIAAKIA", "abc123", "deadbeef" * 3, "f" * 23, "ſecret", "é🙂", "\n", "A" * 16, "tokentoken", "K"]
    made = ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(4000)]
    for t in [*documents.values(), *made, "", "secret=" * 300 + "x" * 9, "a" * 10_000]:
        assert [s for s in secret_scan.scan(t) if s[0] in secret_scan.BASE_KINDS] == brute_secrets(t)


def test_checked_tokens_need_their_checksum():
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    good = f"x ghp_{body}{secret_scan.checksum62(body)} y"
    assert [s[0] for s in secret_scan.scan(good)] == ["github"]
    assert secret_scan.scan(good.replace("ghp_A", "ghp_B")) == []


def test_secret_query_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, 'é token = "abcdef123"'), (3, 'é token = "abcdef123"')]
    got = secret_scan.digest(docs_of(rows)).collect()
    assert [r["doc_id"] for r in got] == [1, 2, 3, 3]
    assert got[2]["spans"] == "assign:2:20" and got[2] == got[3] and got[0]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert secret_scan.digest(docs_of([])).count() == 0


# --------------------------------------------------------------------------- pieces
@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


def test_pieces_equal_the_library(library, documents):
    p = pieces.Pieces(piece_model())
    r = random.Random(1)
    letters = "abcdetheion  ▁\n\té日🙂ÃÂ=-_/*#.0123\x00́"
    made = ["".join(r.choice(letters) for _ in range(r.randint(0, 25))) for _ in range(3000)]
    made += [" " * k + s for k in range(40) for s in ("", "a", "é", "\n", "日", "ł")]
    made += ["".join(r.choice("ab=-Â") for _ in range(5000)), "a" * 5000, " " * 5000, " " * 100_000 + "end", "=" * 300, "<0x0A></s><unk>"]
    for t in [*made, *documents.values()]:
        ids = library.encode(t) + [2]
        assert p.encode(t) == ids
        assert p.decode(ids) == library.decode(ids)
        assert p.digests(t) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_small_tables_of_units_change_nothing(library, documents, monkeypatch):
    monkeypatch.setattr(pieces, "MEMORY", 50)
    p = pieces.Pieces(piece_model())
    for t in list(documents.values())[:30]:
        assert p.encode(t) == library.encode(t) + [2]


def test_piece_frames(spark, docs_of):
    frame = docs_of([(1, None), (2, ""), (3, "a  b\n"), (3, "a  b\n")])
    ids = pieces.encode_documents(frame, piece_model())
    back = {(r["doc_id"], r["text"]) for r in pieces.decode_documents(ids, piece_model()).collect()}
    assert back == {(1, ""), (2, ""), (3, "a  b\n")}
    assert [r["n_tokens"] for r in pieces.digest(frame, piece_model()).orderBy("doc_id").collect()][:2] == [1, 1]
    assert pieces.digest(docs_of([]), piece_model()).count() == 0


# --------------------------------------------------------------------------- quality rules
def brute_counts(t):
    words = [w.decode() for w in WORD.findall(t.encode())]
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line.encode()):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 5))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered))


def test_counts_equal_brute_force(documents):
    r = random.Random(2)
    made = ["".join(r.choice(["a", "b", " ", "\n", "é#", "\t", "a b c d e "]) for _ in range(r.randint(0, 60))) for _ in range(500)]
    texts = [*documents.values(), *made, "", "\n\n", "a b c d e " * 2]
    got = quality_rules.count_batch(*text_buffers(pa.array(texts)))
    assert got == [brute_counts(t) for t in texts]


def test_quality_rules_without_labels(spark, docs_of):
    empty = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    frame = docs_of([(1, None), (2, "a b c d e f g h i j k"), (3, "a b c d e " * 9)])
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules.judge(frame, quality_rules.fit(frame, empty)).collect()}
    assert got == {1: (True, False), 2: (False, True), 3: (True, False)}


def test_quality_rules_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op5_quality_rules"](spark, sf).join(table(spark, sf, "labels"), "doc_id").where("NOT base_failed").collect()
    rows = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % quality_rules.FOLDS == quality_rules.HELD_OUT]  # never learnt from
    assert len(rows) > 10
    right = np.mean([r["kept"] == (r["quality"] == 1) for r in rows])
    assert right >= 0.97
