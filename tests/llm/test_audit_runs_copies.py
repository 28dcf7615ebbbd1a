"""Filter audit, periodic runs and digest merge against brute-force versions and in edge cases."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from statforge.llm import digest_merge, filter_audit, periodic_runs
from statforge.llm.queries import op11_filter_audit, op12_periodic_runs, op13_digest_merge

SF = "/root/testdata/sf0.001"
BLANK = "[\\x20\\x09-\\x0D]+"
EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (5, "one"), (6, " o n e\n"), (7, "x y " * 6), (8, "ÄÖÜ   word"), (None, "one"),
    (None, None), (9, "a b c " * 20_000), (10, "AAAA # " * 300), (11, "é" * 50), (12, "12 34 " * 5 + "56"),
]


# --------------------------------------------------------------------------- filter audit
def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
        "D": any(c in "#$%&*|" for c in text),
    }


def brute_audit(rows, labels):
    """``rows`` of ``(doc_id, text, lang)``; ``labels`` of ``(doc_id, quality, toxic)``."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    docs = []
    for i, t, lang in rows:
        f = {**fails(t or ""), "E": i is not None and i > least[t or ""]}
        docs.append((lang or "", {k for k in f if f[k]}, any(x == i and q == 1 for x, q, _ in labels if x is not None), any(x == i and o == 1 for x, _, o in labels if x is not None)))
    out, orders = {}, ["".join(p) for p in itertools.permutations("ABCDE")]
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in orders:
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                redundant = sum(f in d[1] for d in own) - len(gone)
                out[part, order, step] = [len(left), len(gone), redundant, sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for f in "ABCDE":
            total = sum(out[part, o, o.index(f) + 1][1] for o in orders)
            for o in orders:
                out[part, o, o.index(f) + 1].append(total)
    return out


def audited(frame):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in frame.collect()}


def test_audit_equals_applying_every_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = audited(op11_filter_audit(spark, SF))
    assert got == brute_audit([tuple(r) for r in docs], labels)
    assert any(v[4] for v in got.values()) and any(v[5] for v in got.values())


def test_audit_of_nulls_repeats_and_long_texts(spark, docs_of):
    rows = [(i, t, None if k % 3 else ("en" if k % 2 else "")) for k, (i, t) in enumerate(EDGES)]
    labels = [(1, 1, 0), (1, 0, 1), (5, None, None), (None, 1, 1), (6, 1, None), (9, 0, 1)]
    frame = spark.createDataFrame([(i, t, lang, 1, 2, "x", True, False) for i, t, lang in rows], "doc_id LONG, text STRING, lang STRING, cell LONG, n LONG, part STRING, good BOOLEAN, E BOOLEAN")
    marks = spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT").withColumn("part", F.lit("p"))
    assert audited(filter_audit.audit_filters(frame, marks)) == brute_audit(rows, labels)


def test_audit_of_nothing(docs_of, spark):
    labels = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    assert filter_audit.audit_filters(docs_of([]), labels).collect() == []
    one = filter_audit.audit_filters(docs_of([(1, "x")]), labels).collect()
    assert len(one) == 600 and {r["part"] for r in one} == {"en"} and {r["good_lost"] for r in one} == {0}


def test_contraction_selects_along_each_axis():
    cells = np.arange(8).reshape(1, 2, 2, 2)
    got = filter_audit.contracted(cells, [[(1, 0), (0, 1), (1, 1)], [(1, 1)] * 3, [(0, 1)] * 3])
    assert got.ravel().tolist() == [2 + 3, 28, 7]


def test_a_text_of_a_third_of_all_rows_meets_in_one_row(spark):
    rows = [(i, "same" if i % 3 == 0 else f"t {i}", "en") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")
    judged = filter_audit.judged(frame, spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT"))
    assert judged.where("E").count() == 999


# --------------------------------------------------------------------------- periodic runs
def brute_runs(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, 2 * q):
                found.setdefault((s, i + q), q)
            i = max(i, s + 1)
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, e, q in runs for i in range(s + q, e)}
    top = max(runs, key=lambda r: (r[1] - r[0], -r[0], -r[2]), default=None)
    longest = (top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2]) if top else (None,) * 4
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *longest, digest("".join(f"{s},{e - s},{q}\n" for s, e, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in dropped)))


@pytest.mark.parametrize("least", [2, 4, 12])
def test_runs_of_small_alphabets(least):
    rng = random.Random(least)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 4)):
            words = [b"%d" % rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 60))]
            if words and rng.random() < 0.5:
                a = rng.randrange(len(words))
                p = 1 + rng.randrange(max(1, (len(words) - a) // 3))
                words = words[:a] + (words[a : a + p] * len(words))[: len(words) - a]
            texts.append(words)
        assert periodic_runs.text_runs(texts, least) == [brute_runs(w, least) for w in texts]


def test_fibonacci_words_have_many_runs():
    a, b = ["a"], ["a", "b"]
    while len(b) < 1500:
        a, b = b, b + a
    assert periodic_runs.text_runs([[w.encode() for w in b]]) == [brute_runs(b)]


def test_runs_equal_brute_force_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = {r["doc_id"]: r["text"] for r in docs if len(r["text"] or "") < 9000}
    got = {r["doc_id"]: tuple(r) for r in op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    assert {i: got[i] for i in short} == {i: brute_row(i, t) for i, t in short.items()}
    assert sum(r[1] > 0 for r in got.values()) > 10


def test_runs_of_edge_cases(docs_of):
    rows = [x for x in EDGES if len(x[1] or "") < 10_000]
    rows += [(i, " ".join(f"w{k % 7}" for k in range(40 + i % 5))) for i in range(100, 160)]
    got = sorted(map(repr, (tuple(r) for r in periodic_runs.find_runs(docs_of(rows)).collect())))
    assert got == sorted(repr(brute_row(i, t)) for i, t in rows)
    assert periodic_runs.find_runs(docs_of([])).collect() == []


def test_one_long_run_and_one_long_text_without():
    assert periodic_runs.text_runs([[b"a", b"b", b"c"] * 100_000]) == [[(0, 300_000, 3)]]
    assert periodic_runs.text_runs([[b"%d" % i for i in range(300_000)]]) == [[]]


# --------------------------------------------------------------------------- digest merge
def brute_copies(rows):
    normal = lambda t: re.sub(BLANK, "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append((-len(t or ""), i is None, i))
    out = []
    for text, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(m[2], members[0][2], len(members), k == 0, digest) for k, m in enumerate(members)]
    return sorted(out, key=repr)


def copies(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_copies_equal_brute_force_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = copies(op13_digest_merge(spark, SF))
    assert got == brute_copies(rows) and any(r[2] > 1 for r in got)


@pytest.mark.parametrize("width", [1, 3])
def test_copies_of_edge_cases(docs_of, width):
    rows = EDGES + [(100 + i, "hot" + " " * (i % 4)) for i in range(300)] + [(20, "o  ne"), (19, "o ne "), (19, " one")]
    assert copies(digest_merge.duplicate_groups(docs_of(rows).repartition(7), width=width)) == brute_copies(rows)
    assert copies(digest_merge.duplicate_groups(docs_of([]))) == []


def test_deduplicated_rows_keep_their_columns(docs_of):
    docs = docs_of(EDGES)
    got = digest_merge.deduplicated(docs)
    assert got.columns == docs.columns
    want = [r for r in brute_copies(EDGES) if r[3]]
    assert sorted((r["doc_id"] for r in got.collect()), key=repr) == sorted((r[0] for r in want), key=repr)


def test_equal_digests_of_other_texts_are_not_merged(spark):
    entry = lambda node, size, check, order: (node, bytes([170] * 32), size, check, (order, False, order, order), 2)
    runs = spark.createDataFrame(
        [entry(0, 5, 1, 3), entry(1, 5, 1, 1), entry(2, 6, 1, 0), entry(3, 5, 2, 0)],
        "node LONG, digest BINARY, normal_bytes LONG, check LONG, best STRUCT<order: LONG, unnamed: BOOLEAN, doc_id: LONG, rid: LONG>, n LONG",
    )
    got = sorted((r["normal_bytes"], r["check"], r["best"]["order"], r["n"]) for r in digest_merge.merged(runs, 2, 1).collect())
    assert got == [(5, 1, 1, 4), (5, 2, 0, 2), (6, 1, 0, 2)]


def test_merge_rounds_have_one_exchange_and_no_python(spark):
    bits, runs = 3, spark.createDataFrame([], "node LONG, digest BINARY, normal_bytes LONG, check LONG, best STRUCT<order: LONG, unnamed: BOOLEAN, doc_id: LONG, rid: LONG>, n LONG")
    plan = digest_merge.merged(runs, bits, 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3 and "Arrow" not in plan and "Python" not in plan
