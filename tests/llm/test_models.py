"""Trained operators: quality classifier and language model."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from statforge.llm import bilinear_lm as lm
from statforge.llm import quality_rules as rules
from statforge.llm import quality_svm as svm
from statforge.llm.common import materialise, table
from statforge.llm.hashed_text import Grams, Sample, calibrate
from statforge.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


# --------------------------------------------------------------------------- support vectors
def test_dual_descent_meets_the_optimality_conditions(monkeypatch):
    monkeypatch.setattr(svm, "PASSES", 400)
    rng = np.random.default_rng(0)
    label = rng.integers(0, 2, 60)
    rows = [np.unique(np.r_[rng.choice(20, 5), 20 + rng.choice(10, 3) + 10 * y * (rng.random() < 0.8)]).astype(np.int32) for y in label]
    sample = Sample(np.concatenate(rows), np.cumsum([0, *map(len, rows)]), label)
    model = svm.fit_margin(sample, 64)
    y = np.where(label == 1, 1, -1)
    best = lambda m: 0.5 * (np.where(m.square > 0, m.weight**2 / np.maximum(m.square, 1e-300), 0).sum() + m.intercept**2) + svm.COST * np.maximum(0, 1 - y * np.array([m.margin(r) for r in rows])).sum()
    value = best(model)
    for _ in range(30):  # no nearby model is better
        other = svm.Model(model.weight + rng.normal(0, 0.01, 64) * np.sqrt(model.square), model.square, model.intercept + rng.normal(0, 0.01))
        assert best(other) >= value - 1e-6


def test_calibration_recovers_a_sigmoid():
    rng = np.random.default_rng(1)
    margin = rng.normal(0, 2, 20_000)
    label = (rng.random(20_000) < 1 / (1 + np.exp(-(1.5 * margin - 0.7)))).astype(int)
    slope, offset = calibrate(margin, label, {0: int((1 - label).sum()), 1: int(label.sum())})
    assert abs(slope - 1.5) < 0.1 and abs(offset + 0.7) < 0.1


def test_classifier_on_held_out_labels(spark):
    rows = QUERIES["op2_quality_classifier"](spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    assert len(rows) > 50 and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.97
    assert all(r["predicted"] == 1 for r in rows if r["quality"] == 1)


def test_classifier_edges(spark, docs_of):
    frame = docs_of([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x" * 100_000)])
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (None, 1, 0), (2, None, 0)], "doc_id LONG, quality INT, toxic INT")
    got = svm.score(frame, svm.fit(frame, labels)).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert svm.filtered(frame, svm.fit(frame, labels)).columns == frame.columns
    none = svm.fit(frame, labels.where("false"))
    assert {r["score"] for r in svm.score(frame, none).collect()} == {0.5}
    assert svm.score(docs_of([]), none).count() == 0


def _features(texts):
    import pyarrow as pa

    from statforge.llm.common import text_buffers
    from statforge.llm.hashed_text import feature_sets

    return list(feature_sets(*text_buffers(pa.array(texts, pa.string())), Grams()))


def _plain_fit(module, documents, labels, folds, seed):
    """The fit on the driver, from rows and features put together one by one."""
    known = sorted((i, y) for i, y in labels.items() if y is not None and zlib.crc32(str(i).encode()) % folds[0] != folds[1] and i in documents)
    parts = _features([documents[i] for i, _ in known])
    sample = Sample(np.concatenate(parts), np.cumsum([0, *map(len, parts)]), np.array([y for _, y in known]))
    order = np.random.Generator(np.random.PCG64(seed)).permutation(np.arange(len(known)) % module.CALIBRATION_FOLDS)
    margins = np.zeros(len(known))
    for k in range(module.CALIBRATION_FOLDS):
        inner = module.fit_margin(sample.take(np.flatnonzero(order != k)), Grams().width)
        for i in np.flatnonzero(order == k):
            margins[i] = inner.margin(parts[i])
    sizes = Counter(y for _, y in known)
    model = module.fit_margin(sample, Grams().width)
    return model, calibrate(margins, sample.label, sizes)


@pytest.fixture(scope="module")
def rows_and_labels(spark):
    documents = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    return documents, {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}


def test_classifier_equals_a_plain_version(spark, rows_and_labels):
    documents, labels = rows_and_labels
    model, (slope, offset) = _plain_fit(svm, documents, labels, (5, 0), 3)
    got = {r["doc_id"]: r for r in QUERIES["op2_quality_classifier"](spark, SF).collect()}
    assert set(got) == set(documents)
    ratio = np.sqrt(model.square)
    for (i, _), slots in zip(documents.items(), _features(list(documents.values())), strict=True):
        norm = math.sqrt(sum(float(ratio[s]) ** 2 for s in slots))
        margin = model.intercept + (sum(float(model.weight[s]) for s in slots) / norm if norm else 0.0)
        p = 1 / (1 + math.exp(-(slope * margin + offset)))
        assert got[i]["score"] == pytest.approx(p, rel=1e-3, abs=1e-4) and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.3)


def test_rules_verdict_equals_a_plain_version(spark, rows_and_labels):
    documents, labels = rows_and_labels
    model, (slope, offset) = _plain_fit(rules, documents, labels, (rules.FOLDS, rules.HELD_OUT), 4)
    got = {r["doc_id"]: r for r in QUERIES["op5_quality_rules"](spark, SF).collect()}
    assert set(got) == set(documents)
    for (i, _), slots in zip(documents.items(), _features(list(documents.values())), strict=True):
        margin = model.intercept + (sum(float(model.weight[s]) for s in slots) / math.sqrt(len(slots)) if len(slots) else 0.0)
        p = 1 / (1 + math.exp(-(slope * margin + offset)))
        assert got[i]["probability"] == pytest.approx(p, rel=1e-3, abs=1e-4)
        if abs(p - rules.THRESHOLD) > 1e-3:
            assert got[i]["kept"] == (not got[i]["base_failed"] and p >= rules.THRESHOLD)


def test_rules_edges(spark, docs_of):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0), (4, 0, 0)], "doc_id LONG, quality INT, toxic INT")
    rows = [(1, "some good words stand here in a row and then more"), (2, "bad bad bad bad"), (3, None), (5, ""), (5, ""), (None, "x y " * 100_000)]
    got = rules.judge(docs_of(rows), rules.fit(docs_of(rows), labels)).collect()
    assert len(got) == 6 and sorted(r["n_words"] for r in got) == [0, 0, 0, 4, 11, 200_000]
    assert [r["base_failed"] for r in got if r["n_words"] == 200_000] == [True]
    assert rules.judge(docs_of([]), rules.fit(docs_of([]), labels)).count() == 0


def test_features_do_not_depend_on_neighbours():
    import pyarrow as pa

    from statforge.llm.common import text_buffers
    from statforge.llm.hashed_text import feature_sets

    texts = ["one two two", "", "ab", "é 日本 " * 50]
    together = list(feature_sets(*text_buffers(pa.array(texts)), Grams()))
    for t, slots in zip(texts, together, strict=True):
        assert (next(feature_sets(*text_buffers(pa.array([t])), Grams())) == slots).all()


# --------------------------------------------------------------------------- language model
@pytest.fixture(scope="module")
def trained(spark):
    docs = table(spark, SF, "documents")
    counts = materialise(lm.word_counts(docs), "counts")
    vocab = lm.vocabulary(counts)
    return docs, counts, vocab, lm.train(docs, vocab)


def test_base_scores_equal_brute_force_and_the_model_is_better(spark, trained):
    docs, counts, vocab, model = trained
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    tokens = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in texts.items()}
    count = Counter()
    for i, words in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(words)
    n, v = sum(count.values()), len(count)
    gain = size = 0
    for r in lm.scores(docs, counts, vocab, model).collect():
        words = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(count[w] > 0 for w in words), n)
        assert abs(r["base_score"] - sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words)) < 1e-6
        if r["held_out"]:
            gain += r["score"] - r["base_score"]
            size += len(words)
    assert gain / size > 0.03


def test_scores_equal_a_brute_force_sum(trained):
    """Each token by definition: softmax over all classes after its context, times its share of a shared class."""
    docs, counts, vocab, model = trained
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id < 12 OR doc_id % 100 = 0").collect()}
    count = {r["word"].encode(): r["c"] for r in counts.collect()}
    own = [w for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0])) if w != lm.END][: lm.own_classes(len(count)) - 1]
    own = {w: k for k, w in enumerate([lm.END, *own])}
    first = len(own)
    assert vocab.classes == first + lm.SHARED
    mass, types = Counter(), Counter()
    for w, c in count.items():
        if w not in own:
            mass[zlib.crc32(w) % lm.SHARED] += c
            types[zlib.crc32(w) % lm.SHARED] += 1
    share = lambda w: (count.get(w, 0) + 1) / (mass[zlib.crc32(w) % lm.SHARED] + types[zlib.crc32(w) % lm.SHARED] + 1)
    target, bias = model.target.astype(float), model.bias.astype(float)
    got = {r["doc_id"]: r["score"] for r in lm.scores(docs, counts, vocab, model).collect()}
    for i, text in texts.items():
        words = [*(text or "").encode().lower().split(), lm.END]
        classes = [own[w] if w in own else first + zlib.crc32(w) % lm.SHARED for w in words]
        total, near, far = 0.0, 0, 0
        for w, c in zip(words, classes, strict=True):
            logit = target @ (model.context[near].astype(float) * model.near + model.context[far].astype(float) * model.far) + bias
            logit -= logit.max()
            total += math.log10(np.exp(logit[c]) / np.exp(logit).sum() * (1.0 if w in own else share(w)))
            near, far = c, near
        assert got[i] == pytest.approx(total, rel=1e-4, abs=1e-3), i


def test_classes_grow_with_the_vocabulary():
    assert [lm.own_classes(n) for n in (0, 1000, 400_000, 10**9)] == [lm.OWN, lm.OWN, 1264, lm.MOST_OWN]


def test_rounds_take_growing_shares_until_all_parts_are_seen(spark, monkeypatch):
    monkeypatch.setattr(lm, "PART", 10_000)
    docs = table(spark, SF, "documents")
    vocab = lm.vocabulary(materialise(lm.word_counts(docs), "counts"))
    seen, whole = [], lm.summed_chunks

    def noted(rows, kind):
        seen.append(rows.rdd.getNumPartitions())
        out = whole(rows, kind)
        seen[-1] = (out[-3], out[-1])
        return out

    monkeypatch.setattr(lm, "summed_chunks", noted)
    lm.train(docs, vocab)
    tokens = [t for t, _ in seen]
    assert tokens[0] < 0.3 * vocab.tokens and tokens[0] < tokens[1] < tokens[2] < tokens[3]
    assert all(t == vocab.tokens for t in tokens[3:]) and len(tokens) >= 5  # the last rounds take all of them


def test_token_probabilities_are_normalised(trained):
    *_, vocab, model = trained
    near, far = (t.astype(float) for t in model.tables())
    z = model.normalisers()
    for a, b in ((0, 0), (3, 900), (vocab.classes - 1, 17)):
        assert abs(np.exp(near[a] + far[b] - z[a, b]).sum() - 1) < 1e-9
    # inside each shared class: known words and one place for unseen ones
    words = {w: c for w, c in zip(vocab.index, vocab.count, strict=True)}
    assert vocab.tokens >= sum(words.values())


def test_contexts_do_not_cross_texts():
    near, far = lm.contexts(np.array([5, 6, 0, 7, 8, 0]))
    assert near.tolist() == [0, 5, 6, 0, 7, 8] and far.tolist() == [0, 0, 5, 0, 0, 7]


def test_scores_do_not_hang_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(lm, "PART", 20_000, raising=False)
    docs = table(spark, SF, "documents")
    got = [{r["doc_id"]: (r["score"], r["n_tokens"]) for r in lm.score_documents(f).collect()} for f in (docs.coalesce(1), docs.repartition(12, "n_chars"))]
    assert all(abs(got[0][i][0] - got[1][i][0]) < 1e-3 * n for i, (_, n) in got[0].items())


def test_language_model_edges(spark, docs_of):
    frame = docs_of([(1, None), (1, ""), (9, "a a rare" * 3), (None, "b")])
    got = lm.score_documents(frame).collect()
    assert sorted(r["n_tokens"] for r in got) == [1, 1, 2, 8]
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    assert lm.score_documents(docs_of([])).count() == 0


def test_a_step_of_the_language_model_follows_the_plain_formulas():
    rng, classes = np.random.default_rng(3), 40
    mass = 1e4 / np.arange(1, classes + 1)
    start = lm.Bilinear.start(mass)
    square = lm.Bilinear.of(np.full(len(start.flat()), 1e-6), classes)
    trainer = lm.Trainer(start, square, mass, seed=[1, 2])
    word = rng.integers(0, classes, 500)
    near, far = lm.contexts(word)
    trainer.step(near, far, word)

    p = (mass + 1) / (mass + 1).sum()
    noise = np.searchsorted(np.cumsum(p), np.random.Generator(np.random.PCG64([1, 2])).random(lm.NOISE))
    c, t, bias, shift = (x.astype(np.float64) for x in (start.context, start.target, start.bias, np.log(lm.NOISE * p)))
    hidden = c[near] * start.near + c[far] * start.far
    pull = 1 / (1 + np.exp(-((hidden * t[word]).sum(axis=1) + bias[word] - shift[word]))) - 1
    push = 1 / (1 + np.exp(-(hidden @ t[noise].T + bias[noise] - shift[noise])))
    back = pull[:, None] * t[word] + push @ t[noise]
    grads = [np.zeros((classes, lm.DIM)), np.zeros((classes, lm.DIM)), (back * c[near]).sum(axis=0), (back * c[far]).sum(axis=0), np.zeros(classes)]
    np.add.at(grads[0], near, back * start.near)
    np.add.at(grads[0], far, back * start.far)
    np.add.at(grads[1], word, pull[:, None] * hidden)
    np.add.at(grads[1], noise, push.T @ hidden)
    np.add.at(grads[4], word, pull)
    np.add.at(grads[4], noise, push.sum(axis=0))
    for name, g in zip(("context", "target", "near", "far", "bias"), grads, strict=True):
        g = g / len(word)
        want = getattr(start, name) - lm.RATE * g / np.sqrt(1e-6 + g * g)
        assert np.allclose(getattr(trainer.m, name), want, rtol=1e-3, atol=1e-4), name
    some = slice(None, None, lm.LOSS_STEPS)
    every = hidden[some] @ t.T + bias
    loss = (np.log(np.exp(every).sum(axis=1)) - every[np.arange(len(every)), word[some]]).sum()
    assert trainer.loss == pytest.approx(loss, rel=1e-5) and trainer.loss_tokens == len(every)


def test_sums_of_known_chunks_start_no_empty_tasks(spark):
    from statforge.llm.common import tree_summed

    rows = spark.createDataFrame([(c, p, bytes(8)) for c in range(2) for p in range(3)], "chunk INT, part INT, counts BINARY")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert tree_summed(rows, "float64", chunks=2).rdd.getNumPartitions() == 2
        assert sorted(r["chunk"] for r in tree_summed(rows, "float64", chunks=2).collect()) == [0, 1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_words_are_cut_at_the_separators_alone():
    import pyarrow as pa

    texts = ["A b\tC\x0b\x0cd\r\ne  É x y \x1c z", None, "", "  ", "x" * 5000 + " ÀB", "\x1f\x85 İ"]
    plain = [(t or "").encode().lower().split() for t in texts]
    for part in (slice(None), slice(1, 5)):
        words, sizes = lm.words_of(pa.array(["pad me", *texts], pa.string()).slice(1)[part])
        assert [w.encode() for w in words.to_pylist()] == [w for t in plain[part] for w in t]
        assert sizes.tolist() == [len(t) for t in plain[part]]


def test_places_and_classes_equal_a_plain_version(monkeypatch):
    import pyarrow as pa

    texts = ["b a zz b", None, "yy zz", ""]
    at_hand, word_class = pa.array(["a", "\n", "b"]), np.array([2, 0, 1], np.int32)
    places, classes, starts, text, rare = lm.class_ids(*lm.words_of(pa.array(texts)), at_hand, word_class, 3, 1)
    shared = [3 + zlib.crc32(w) % lm.SHARED for w in (b"zz", b"yy", b"zz")]
    assert places.tolist() == [2, 0, -1, 2, 1, 1, -1, -1, 1, 1] and starts.tolist() == [0, 5, 6, 9]
    assert classes.tolist() == [1, 2, shared[0], 1, 0, 0, shared[1], shared[2], 0, 0]
    assert text.tolist() == [0, 2, 2] and rare.to_pylist() == ["zz", "yy", "zz"]
    monkeypatch.setattr(lm, "GROUP_BYTES", 3)
    assert [len(t) for t in lm.grouped(pa.array(texts))] == [1, 1, 1, 1]


def test_a_step_leaves_the_classes_it_does_not_meet_alone():
    """Contexts that cross a text's end are class 0; a second step starts in the middle of a text."""
    rng, classes = np.random.default_rng(5), 3000
    mass = np.append(np.full(50, 1e6), np.zeros(classes - 50))
    start, word = lm.Bilinear.start(mass), rng.integers(0, 50, 700)
    square = lm.Bilinear.of(np.full(len(start.flat()), 1e-6), classes)
    one, two = lm.Trainer(start, square, mass, [1, 2]), lm.Trainer(start, square, mass, [1, 2])
    near, far = lm.contexts(word)
    drawn = one.noise(2)
    for k, at in enumerate((0, 400)):
        some = slice(at, at + 400)
        one.step(near[some], far[some], word[some], (drawn[0][k], drawn[1][k]))
        two.step(near[some], far[some], word[some])
    assert all(np.array_equal(a, b) for a, b in ((one.m.flat(), two.m.flat()), (one.s.flat(), two.s.flat())))
    unmet = np.setdiff1d(np.arange(classes), np.r_[word, drawn[0].ravel()])
    assert len(unmet) > 2000 and not np.array_equal(one.m.context[:50], start.context[:50])
    for now, then in ((one.m, start), (one.s, square)):
        assert all(np.array_equal(getattr(now, x)[unmet], getattr(then, x)[unmet]) for x in ("context", "target", "bias"))


def test_rounds_over_a_share_of_the_parts_take_no_loss(spark, monkeypatch):
    monkeypatch.setattr(lm, "PART", 50_000)
    docs = table(spark, SF, "documents")
    vocab = lm.vocabulary(materialise(lm.word_counts(docs), "counts"))
    seen, whole = [], lm.summed_chunks

    def noted(rows, kind):
        out = whole(rows, kind)
        seen.append((out[-3], out[-1]))
        return out

    monkeypatch.setattr(lm, "summed_chunks", noted)
    lm.train(docs, vocab)
    assert len(seen) >= 4 and all((loss_tokens > 0) == (tokens == vocab.tokens) for tokens, loss_tokens in seen)
