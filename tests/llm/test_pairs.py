"""Operators that compare texts: shingle join and decontamination."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from statforge.llm import decontaminate, shingle_join
from statforge.llm.common import table
from tests.llm.conftest import SF


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_groups(rows):
    """``doc_id -> (set size, component)`` by comparing all sets that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        common = Counter(o for g in sets[i] for o in holders[g])
        for o, n in common.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[o]) - n):
                a, b = root(i), root(o)
                parent[max(a, b)] = min(a, b)
        for g in sets[i]:
            holders[g].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def grouped(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in shingle_join.link_groups(frame).collect()}


def made_copies(seed=4):
    """A large group of near copies, chains whose ends do not link, a passage that many share, small sets, ties."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    base, passage = [word() for _ in range(120)], [word() for _ in range(30)]
    rows = []
    for _ in range(60):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = word()
        rows.append(" ".join(w))
    chain = [word() for _ in range(100)]
    for _ in range(6):
        rows.append(" ".join(chain))
        at = r.randrange(0, 90)
        chain[at : at + 6] = [word() for _ in range(6)]
    rows += [" ".join([word() for _ in range(20)] + passage + [word() for _ in range(20)]) for _ in range(40)]
    rows += ["a b", "A  b", "a", "", None, "  ", "a b c d e", "a b c d e", "a b c d e f"] + [rows[0]] * 5
    r.shuffle(rows)
    return list(enumerate(rows))


def test_groups_equal_brute_force(spark, docs_of):
    rows = made_copies()
    assert grouped(docs_of(rows)) == brute_groups(rows)


def test_blocks_of_large_buckets_lose_no_link(spark, docs_of, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK", 8)
    rows = made_copies(5)
    assert grouped(docs_of(rows)) == brute_groups(rows)


def test_later_rounds_of_large_buckets_hold_two_blocks_and_pairs_meet_once(spark, monkeypatch):
    from itertools import combinations

    monkeypatch.setattr(shingle_join, "BLOCK", 16)
    held = {}

    def noted(rows, top, percent):
        for r in rows.collect():
            held.setdefault((r["bucket"], r["block"]), []).append((r["sig"], r["half"] if "half" in r else 0))
        return spark.createDataFrame([], shingle_join.CANDIDATE)

    monkeypatch.setattr(shingle_join, "_searched", noted)
    buckets = spark.createDataFrame([(1, s, 50) for s in range(1, 161)] + [(500, s, 50) for s in range(500, 510)], "bucket long, sig long, n long")
    classes = buckets.select("sig", F.lit(b"").alias("point"))
    labels = spark.createDataFrame([(s, 1) for s in range(1, 61)], "v long, label long")
    shingle_join.candidates(buckets, classes, labels).count()
    assert max(map(len, held.values())) <= 4 * 16  # two blocks, dealt by a hash
    met = Counter(tuple(sorted((a, b))) for cell in held.values() for (a, x), (b, y) in combinations(cell, 2) if (x == 0 or x != y) and not (a <= 60 and b <= 60))
    assert set(met.values()) == {1} and len(met) == 160 * 159 // 2 - 60 * 59 // 2 + 45


def test_groups_of_the_test_documents(spark, documents):
    assert grouped(table(spark, SF, "documents")) == brute_groups(documents.items())


def test_long_texts_and_a_key_in_a_third_of_the_rows(spark, docs_of, monkeypatch):
    monkeypatch.setattr(shingle_join, "COMMON", -1)  # every shared key goes the way of common ones
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    long = [word() for _ in range(60_000)]
    edited = list(long)
    for _ in range(1000):
        edited[r.randrange(len(edited))] = word()
    line = " ".join(word() for _ in range(9))
    rows = [(1, " ".join(long)), (2, " ".join(edited)), (3, " ".join(long[:30_000]))]
    rows += [(10 + i, f"{line} {word()}" if i % 3 == 0 else " ".join(word() for _ in range(12))) for i in range(240)]
    assert grouped(docs_of(rows)) == brute_groups(rows)


def test_empty_table_and_null_ids(spark, docs_of):
    assert shingle_join.link_groups(docs_of([])).count() == 0
    got = shingle_join.link_groups(docs_of([(None, "a b c d e f"), (4, "a b c d e f"), (None, None)])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == [("4", "4"), ("None", "4"), ("None", "None")]


@pytest.mark.parametrize("seed", range(3))
def test_tree_finds_all_that_the_bound_allows(seed):
    rng = np.random.default_rng(seed)
    sets = [np.sort(rng.choice(2**20, rng.integers(150, 400), replace=False).astype(np.uint64)) for _ in range(150)]
    for k in range(150):  # relatives of various closeness
        own = sets[rng.integers(len(sets))].copy()
        own[: rng.integers(0, 60)] += np.uint64(2**21)
        sets.append(np.unique(own))
    points = np.stack([np.bincount((s % np.uint64(128)).astype(int), minlength=128) for s in sets]).astype(np.uint16)
    sizes = np.array([len(s) for s in sets])
    tree = shingle_join.CountTree(points, sizes, rng.permutation(len(sets)))
    for place in range(len(sets)):
        want = [o for o in range(len(sets)) if tree.rank[o] < tree.rank[place] and 175 * np.minimum(tree.points[o], tree.points[place]).sum(dtype=int) >= 75 * (tree.sizes[o] + tree.sizes[place])]
        assert sorted(k for leaf in tree.leaves(place) for k in leaf.tolist()) == want


def test_fine_codes_bound_the_overlap():
    rng = np.random.default_rng(3)
    for n in (1, 5, 300, 3000):
        x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        y = np.unique(np.r_[x[: n // 2], rng.integers(0, 2**64, n - n // 2, dtype=np.uint64)])
        gaps = [shingle_join.packed_codes(s) for s in (x, y)]
        raw = np.frombuffer(b"".join(gaps), np.uint8)
        a, b = shingle_join.unpacked(raw, np.cumsum([0, *map(len, gaps)]), np.array([len(x), len(y)]))
        bits = shingle_join.code_bits(len(x))
        assert (a == (x >> np.uint64(64 - bits)).astype(np.int64)).all() and len(b) == len(y)
        if shingle_join.code_bits(len(y)) == bits:
            bound = shingle_join._closer([a, b], bits, 0, np.array([1]))[0]
            both = len(np.intersect1d(x, y))
            assert both <= bound <= both + 0.06 * n + 1


def test_every_linked_pair_shares_a_prefix_shingle():
    rng = np.random.default_rng(7)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        x = np.unique(rng.integers(0, 10**6, n))
        y = np.unique(np.r_[x[rng.random(len(x)) < 0.9], rng.integers(10**6, 2 * 10**6, rng.integers(0, 6))])
        both = len(np.intersect1d(x, y))
        if len(y) and 100 * both >= 75 * (len(x) + len(y) - both):
            x, y = sorted((x, y), key=len)
            assert np.intersect1d(x[: shingle_join.short_prefix_length(len(x))], y[: shingle_join.prefix_length(len(y))]).size


# --------------------------------------------------------------------------- decontamination
def brute_align(item, text):
    h = [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a == b else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment_scores_equal_the_textbook():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = rng.integers(0, 6, rng.integers(1, 15)), rng.integers(0, 6, rng.integers(1, 30))
        score, equal, first, last = decontaminate.align(a, b)
        assert score == brute_align(a.tolist(), b.tolist())
        if score:
            assert 0 <= first <= last < len(b) and 2 * equal >= score and text_score(a, b[first : last + 1]) == score


def text_score(a, b):
    return brute_align(list(a), list(b))


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id LONG, text STRING")


def test_planted_passages_are_found_and_clean_documents_left_alone(spark, docs_of):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    items = {k: [word() for _ in range(25)] for k in range(12)}
    rows, want = [], set()
    for d in range(120):
        text = [word() for _ in range(80)]
        if d % 3 == 0:  # a third of all documents hold item 0
            text[40:40] = items[0]
            want.add((d, 0))
        if d % 10 == 1:
            k = 1 + d % 11
            copy = [w.upper() + "!!" if i % 4 == 0 else w for i, w in enumerate(items[k])]
            copy[r.randrange(25)] = word()
            del copy[r.randrange(25)]
            text[10:10] = copy
            want.add((d, k))
        rows.append((d, " ".join(text)))
    rows += [(500, None), (501, ""), (502, " ".join(items[3])), (502, " ".join(items[3]))]
    want.add((502, 3))
    bench = items_of(spark, [(k, " ".join(w)) for k, w in items.items()] + [(90, None), (91, ""), (92, "one two")])
    got = decontaminate.contaminated(docs_of(rows), bench)
    assert got.count() == len(want) + 1  # the repeated row is reported twice
    assert {(x["doc_id"], x["item_id"]) for x in got.collect()} == want


def test_short_items_in_a_third_of_all_documents_are_found(spark, docs_of):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    items = {n: [word() for _ in range(n)] for n in range(5, 10)}
    items[40] = [word() for _ in range(40)]
    rows, want = [], set()
    for d in range(90):
        text = [word() for _ in range(60)]
        if d % 3 == 0:
            for k in range(5, 10):
                text[10 * k : 10 * k] = items[k]
                want.add((d, k))
            # of the long item only its first words are whole, so one distinct seed is kept
            text += [w if k < 6 or k % 2 else word() for k, w in enumerate(items[40])]
            want.add((d, 40))
        elif d % 3 == 1:  # no more than a seed's words
            text += items[40][:4]
        rows.append((d, " ".join(text)))
    bench = items_of(spark, [(k, " ".join(w)) for k, w in items.items()])
    assert {(x["doc_id"], x["item_id"]) for x in decontaminate.contaminated(docs_of(rows), bench).collect()} == want


def test_whole_result_equals_aligning_every_document_with_every_item(spark, documents):
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    number = defaultdict(lambda: len(number) + 1)
    coded = {k: np.array([number[w] for w in words(t)]) for k, t in items}
    want = set()
    for i, t in documents.items():
        text = np.array([number[w] for w in words(t)], dtype=np.int64)
        have = Counter(text.tolist())
        for k, item in coded.items():
            if len(item) >= 3 and sum((Counter(item.tolist()) & have).values()) >= min(len(item), 8):
                score, matched, *_ = decontaminate.align(item, text)
                if decontaminate.enough(score, matched, len(item)):
                    want.add((i, k))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table(spark, SF, "documents"), table(spark, SF, "benchmark")).collect()}
    assert got == want and want


@pytest.mark.parametrize("share, least", [(0.1, 0.99), (0.2, 0.97), (0.3, 0.9)])
def test_recall_of_copies_with_changed_words(spark, share, least):
    import pyarrow as pa

    items = decontaminate.Items.of([(r["item_id"], r["text"].lower()) for r in table(spark, SF, "benchmark").collect()])
    hashes, bounds = decontaminate.plain_words(pa.array([r["text"].lower() for r in table(spark, SF, "documents").collect()]))
    hosts = [hashes[bounds[i] : bounds[i + 1]] for i in range(len(bounds) - 1)]
    frequency = np.zeros(len(items.grams), np.int64)
    for w in hosts:
        frequency[np.unique(items.hits(decontaminate.gram_hashes(w, decontaminate.SEED))[1])] += 1
    seeds, rng, found = items.seeds(frequency), np.random.default_rng(3), 0
    for _ in range(300):
        k, host = int(rng.integers(len(items.words))), hosts[rng.integers(len(hosts))]
        copy = items.words[k].copy()
        changed = rng.random(len(copy)) < share
        copy[changed] = rng.choice(hashes, int(changed.sum()))
        at = int(rng.integers(len(host) + 1))
        found += k in {x[0] for x in decontaminate.compare(np.concatenate([host[:at], copy, host[at:]]), seeds)}
    assert found >= least * 300


def test_a_long_text_that_repeats_an_item_takes_little_memory():
    import tracemalloc

    rng = np.random.default_rng(5)
    item = rng.integers(1, 2**60, 60).astype(np.uint64)
    items = decontaminate.Items.index([7], [item], [decontaminate.gram_hashes(item, 3)], [np.arange(58)])
    text = np.tile(np.concatenate([item[:40], rng.integers(1, 2**60, 20).astype(np.uint64)]), 5000)
    tracemalloc.start()
    found = list(decontaminate.compare(text, items))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(x[0], x[2]) for x in found] == [(0, 40)] and peak < 150e6


def test_many_blocks_of_items_and_empty_tables(spark, docs_of, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 40)
    items = [(k, " ".join(f"w{k}x{i}" for i in range(12))) for k in range(4)]
    frame = docs_of([(k, f"some other words here {t} and after") for k, t in items])
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame, items_of(spark, items)).collect()} == {(k, k) for k in range(4)}
    assert decontaminate.contaminated(frame, items_of(spark, [])).count() == 0
    assert decontaminate.contaminated(docs_of([]), items_of(spark, items)).count() == 0


def test_exact_passages_of_the_test_tables(spark, documents):
    bench = table(spark, SF, "benchmark")
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = {r["item_id"]: plain(r["text"]) for r in bench.collect()}
    want = {(i, k) for i, t in documents.items() for k, x in items.items() if x in plain(t)}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table(spark, SF, "documents"), bench).collect()}
    assert want <= got
