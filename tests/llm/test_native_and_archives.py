"""Operators on DataFrame functions (personal data, reply trees), web archives, and the pipeline."""

from __future__ import annotations

import hashlib
import io
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from statforge.llm import decontaminate, pii_bootstrap, reply_trees, web_archive
from statforge.llm.common import table
from statforge.llm.oracles import oracle_sql
from statforge.llm.queries import QUERIES, piece_model
from statforge.session import scratch_path
from tests.llm.conftest import SF
from tests.llm.test_pairs import brute_groups


# --------------------------------------------------------------------------- SQL
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    result = con.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, result.fetchall()))


def test_every_operator_is_registered():
    import __spark_entry__

    numbers = {int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES}
    assert numbers == set(range(1, 14)) and {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())


# --------------------------------------------------------------------------- personal data
FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute_pii(text):
    digits = lambda v: re.sub("[^0-9]", "", v)
    fine = {"email": lambda v: True, "ip": lambda v: all(int(x) <= 255 for x in v.split(".")), "card": lambda v: 13 <= len(digits(v)) <= 19 and luhn(digits(v)), "phone": lambda v: 9 <= len(digits(v)) <= 15}
    return [f"{k}:{m.start()}:{m.end()}" for k, form in FORMS.items() for m in re.finditer(form, text) if fine[k](m[0])]


ODD = [
    "a@b.c_d@e.f a@b@c.d x@y x@y.z. +1 234 567 89 00 +1+2+3 1.2.3.4.5.6.7.8 256.1.1.1 007.08.1.1 4111-1111 1111 1111 4111 1111 1111 1112",
    None, "", "1" * 30_000, "1-" * 5000 + "1 +1" + " " * 3000 + "9" * 10, "é日🙂 x@y.zz 日🙂1.2.3.4", "0000000001.2.3.4 1.2.3.99999999999999999999", "x@y.zz" * 300,
]


def test_base_spans_equal_a_plain_scan(docs_of, documents):
    texts = dict(documents) | {-1 - i: t for i, t in enumerate(ODD)}
    for r in pii_bootstrap.digest(docs_of(list(texts.items()))).collect():
        want = brute_pii(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), r["doc_id"]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(w.startswith(k) for w in want) for k in FORMS]
        assert r["spans"].split(",")[: len(want)] == (want or [""])[: max(len(want), 0)] or not want


def test_confident_patterns_discover_unseen_identifiers(docs_of):
    rows = []
    for i in range(12):  # seeds in two wordings
        rows.append((i, f"please write to user{i}@site.org today, reach me at user{i}@site.org soon"))
    rows.append((50, "please write to agent-4711 today"))
    rows.append((51, "reach me at agent-4711 soon"))
    rows.append((52, "the part agent-4711x and model-99213 are in stock"))
    rows.append((53, "please write to 4111111111111112 today, reach me at 4111111111111112 soon"))  # a card that fails its check
    got = {r["doc_id"]: r["spans"] for r in pii_bootstrap.digest(docs_of(rows)).collect()}
    assert got[50] == "id:16:26" and got[51] == "id:12:22"
    assert got[52] == "" and got[53] == ""


def test_planted_identifiers_are_found_and_parts_numbers_left_alone(docs_of):
    """Unseen identifiers in the wordings of seeds: recall and precision of what is discovered."""
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    wordings = [("please write to", "today or"), ("reach me at", "very soon"), ("contact address is", "for all"), ("account holder", "signed below")]
    plant = lambda x: " ".join([*[word() for _ in range(8)], *(w := r.choice(wordings))[:1], x, w[1], *[word() for _ in range(8)]])
    rows = [(i, plant(f"user{i}@site.org")) for i in range(300)]
    wanted = set()
    for i in range(300, 330):
        token = f"member-{i}{r.randrange(1000)}"
        rows += [(i, plant(token)), (i + 1000, plant(token))]
        wanted.add(token)
    rows += [(3000 + i, f"{word()} part {word()}-{i}77 {word()} stock {word()}") for i in range(200)]
    got = {x["doc_id"]: x["spans"] for x in pii_bootstrap.digest(docs_of(rows)).collect()}
    texts = dict(rows)
    found = {texts[i][int(a) : int(b)] for i, spans in got.items() for kind, a, b in (s.split(":") for s in spans.split(",") if s) if kind == "id"}
    assert found <= wanted and len(found) >= 0.9 * len(wanted)


def test_discovery_goes_on_until_nothing_is_added(docs_of):
    """Each step's identifiers make the wording of the next step's confident."""
    rows, counts = [(k, f"aa bb user{k}@site.org cc dd") for k in range(300)], (100, 33, 11, 3)
    steps = [("aa bb {} cc dd", "ee ff {} gg hh"), ("ee ff {} gg hh", "ii jj {} kk ll"), ("ii jj {} kk ll", "mm nn {} oo pp"), ("mm nn {} oo pp", "qq rr {} ss tt")]
    for s, (known, new) in enumerate(steps):
        for k in range(counts[s]):
            rows += [(1000 * (s + 1) + k, known.format(f"name-{s}-{k}")), (1000 * (s + 1) + 500 + k, new.format(f"name-{s}-{k}"))]
    got = {x["doc_id"]: x["spans"] for x in pii_bootstrap.digest(docs_of(rows)).collect()}
    assert all(got[1000 * (s + 1) + k].startswith("id:") for s in range(4) for k in range(counts[s]))


def test_contexts_are_those_of_the_text(docs_of):
    """Words that are matches themselves, or digits, belong to the context as well."""
    rows = pii_bootstrap.numbered(docs_of([(1, "pay 2019 card 4111111111111111 now 12 34 then x1y2z3, k9k9k9 end")]))
    seen = pii_bootstrap.mentions(pii_bootstrap.located(rows))
    patterns = {(x["value"], x["pattern"]) for x in pii_bootstrap.edges(seen).collect()}
    assert ("4111111111111111", "left 2019 card") in patterns and ("4111111111111111", "right now 12") in patterns
    assert ("x1y2z3", "left 34 then") in patterns and ("k9k9k9", "left then x1y2z3,") in patterns and ("x1y2z3", "around then _ k9k9k9") in patterns


def test_a_text_of_many_mentions_takes_linear_time(docs_of):
    import time

    text = " ".join(f"a{i}@b.cd" for i in range(100_000))
    started = time.time()
    got = {x["doc_id"]: (x["n_email"], x["spans"]) for x in pii_bootstrap.digest(docs_of([(1, text), (2, "x")])).collect()}
    clean = {x["doc_id"]: x["text"] for x in pii_bootstrap.redacted(docs_of([(1, text), (2, "x")])).collect()}
    assert got[1][0] == 100_000 and got[1][1].startswith("email:0:7,email:8:15") and got[2] == (0, "")
    assert clean == {1: " ".join(["<EMAIL>"] * 100_000), 2: "x"}
    assert time.time() - started < 120


def test_redaction_of_overlaps_and_long_texts(docs_of):
    pad = "é" * 3000
    frame = docs_of([(1, f"{pad} 1.2.3.4@mail.org {pad}+1 234 567 8901{pad}"), (2, "4111111111111111@x.yz"), (3, "a@b.cd" + pad)])
    got = {r["doc_id"]: r["text"] for r in pii_bootstrap.redacted(frame).collect()}
    # the address begins where the shorter number in it begins, which is the first of both
    assert got == {1: f"{pad} <IP> {pad}<PHONE>{pad}", 2: "<CARD>", 3: f"<EMAIL>{pad}"}


def test_redaction(docs_of):
    frame = docs_of([(1, "mail a@b.cd or +1 234 567 8901 é"), (2, None), (3, "none")])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii_bootstrap.redacted(frame).collect()}
    assert got == {1: ("mail <EMAIL> or <PHONE> é", 25), 2: (None, 0), 3: ("none", 4)}
    assert pii_bootstrap.digest(docs_of([])).count() == 0


# --------------------------------------------------------------------------- reply trees
def test_best_branch_of_a_tree(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 2.0), (1, 4, 3, "user", "more", 1.0),
        (1, 5, 4, "assistant", "end a", 1.0), (1, 6, 4, "assistant", "end b", 1.0), (2, 7, 99, "user", "lost parent", None),
        (3, 8, 9, "user", "ring", 1.0), (3, 9, 8, "user", "ring", 1.0), (None, 1, None, "user", "no tree id", 1.0),
    ]
    messages = spark.createDataFrame(rows, "tree LONG, node LONG, parent LONG, role STRING, text STRING, score DOUBLE")
    out = reply_trees.format_trees(messages)
    turns = {r["tree"]: [tuple(t) for t in r["turns"]] for r in out.select("tree", reply_trees.turns_of(F.col("conversation")).alias("turns")).collect()}
    assert turns == {1: [("user", "q"), ("assistant", "good"), ("user", "more"), ("assistant", "end a")], 2: [("user", "lost parent")], None: [("user", "no tree id")]}
    assert reply_trees.format_trees(messages, top=3).where("tree = 1").count() == 3


def test_template_is_reversible(spark):
    texts = ["", "### Assistant: hi", r"\### x \\### y", "####  ### ", "</turn>", r"<\/turn><\\/turn>", "a</turn>\n### user\nb", "\\", "<", "/turn>", "é🙂\n\n"]
    rows = [(i, 0, role, t) for i, t in enumerate(texts) for role in ("assistant",)] + [(100, 0, "odd\nro\\le</turn>### ", "x"), (101, 0, None, None), (101, 0, "assistant", "tie")]
    frame = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING").withColumn("node", F.lit(1)).withColumn("place", F.lit(2))
    got = {r["conv_id"]: r for r in reply_trees.format_conversations(frame).collect()}
    for i, _, role, t in rows[: len(texts) + 1]:
        assert got[i]["turns_sha256"] == hashlib.sha256(f"{role}\n{t}\n".encode()).hexdigest(), t
        learned = t if role == "assistant" else ""
        assert (got[i]["loss_chars"], got[i]["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert got[101]["n_turns"] == 2
    assert reply_trees.format_conversations(frame.where("false")).count() == 0


def test_reply_tree_plan_has_no_python(spark):
    plan = QUERIES["op8_reply_trees"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --------------------------------------------------------------------------- archives
PAGES = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "http://c\r\nX: y", ""), (5, "u", "é" * 9000), (5, "u", "é" * 9000), (None, "v", "<p>x</p>"), (None, "w", "only")]


def test_round_trip_and_revisits(spark):
    frame = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id LONG, url STRING, html STRING, salt STRING, keeper INT")
    got = sorted((tuple(r) for r in web_archive.round_trip(frame).collect()), key=repr)
    keep = {"<p>x</p>": 2, "": 4, "é" * 9000: 5, "only": None}
    want = []
    for page_id, _, html in PAGES:
        body = (html or "").encode()
        to = keep[html or ""]
        same = to == page_id
        want.append((page_id, len(body), web_archive.payload_digest(body), "response" if same else "revisit", None if same else to))
    assert got == sorted(want, key=repr)
    large = {r["page_id"]: r["refers_to"] for r in web_archive.with_references(frame, min_revisit_bytes=9).collect()}
    assert large == {1: None, 2: None, 3: None, 4: None, 5: None, None: None}
    assert web_archive.round_trip(frame.where("false")).count() == 0


@pytest.mark.parametrize("common", [1, 20, 1000])
def test_a_payload_of_a_third_of_all_pages(spark, monkeypatch, common):
    monkeypatch.setattr(web_archive, "COMMON", common)
    pages = [(i, f"http://p{i}", "same" if i % 3 == 0 else f"pair {i // 10}" if i % 10 in (1, 2) else f"own {i}") for i in range(900)]
    frame = spark.createDataFrame(pages, "page_id LONG, url STRING, html STRING").repartition(6)
    keeper = {}
    for i, _, html in pages:
        keeper[html] = max(i, keeper.get(html, i))
    rows = web_archive.with_references(frame).collect()
    assert {r["page_id"]: r["refers_to"] for r in rows} == {i: keeper[h] if keeper[h] != i else None for i, _, h in pages} and len(rows) == 900


def test_payloads_come_back_and_packages_are_plain_zip(spark, workdir, monkeypatch):
    monkeypatch.setattr(web_archive, "RANGE_BYTES", 300)
    frame = spark.createDataFrame(PAGES, "page_id LONG, url STRING, html STRING")
    manifest = web_archive.write_archives(frame, scratch_path(spark, "pk"))
    rows = web_archive.read_archives(manifest).collect()
    assert {bytes(r["payload"]).decode() for r in rows if r["record_type"] == "response"} == {"<p>x</p>", "", "é" * 9000, "only"}
    assert {r["url"] for r in rows} >= {"http://c%0D%0AX: y"}
    for r in manifest.collect():
        path = web_archive.filesystem(r["package"])[1]
        with zipfile.ZipFile(path) as z, open(path, "rb") as f:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
            f.size = lambda: 0
            places = web_archive.directory(f, z.fp.seek(0, 2))
            for name in z.namelist():
                at, n = web_archive.member_range(f, places[name])
                assert web_archive._at(f, at, n) == z.read(name)


def test_zip64_directories(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        for k in range(5):
            z.writestr(f"m{k}", bytes([k]) * (50 + k))
        z.comment = b"PK\x05\x06 no end"
    data = raw.getvalue()
    assert b"PK\x06\x06" in data
    places = web_archive.directory(io.BytesIO(data), len(data))
    for k in range(5):
        at, n = web_archive.member_range(io.BytesIO(data), places[f"m{k}"])
        assert data[at : at + n] == bytes([k]) * (50 + k)
    with pytest.raises(ValueError, match="end of a central directory"):
        web_archive.directory(io.BytesIO(b"nothing"), 7)


# --------------------------------------------------------------------------- pipeline
def test_pipeline_equals_brute_force(spark, documents):
    import sentencepiece

    kept = {r["doc_id"] for r in QUERIES["op2_quality_classifier"](spark, SF).where("predicted = 1").collect()}
    groups = brute_groups([(i, documents[i]) for i in sorted(kept)])
    firsts = {i for i in kept if groups[i][1] == i}
    rest = table(spark, SF, "documents").where(F.col("doc_id").isin(*firsts))
    leaks = {r["doc_id"] for r in decontaminate.contaminated(rest, table(spark, SF, "benchmark")).collect()}
    assert leaks and kept - firsts
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    want = {}
    for i in firsts - leaks:
        spans = sorted((int(s.split(":")[1]), int(s.split(":")[2]), s.split(":")[0]) for s in brute_pii(documents[i]))
        at, out = 0, []
        for start, end, kind in spans:
            if start >= at:
                out += [documents[i][at:start], f"<{kind.upper()}>"]
            at = max(at, end)
        ids = [*sp.encode("".join([*out, documents[i][at:]])), 2]
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_keep_columns_and_take_empty_tables(spark, docs_of):
    empty, odd = docs_of([]), docs_of([(1, None), (2, ""), (None, "some words that stand here")])
    for name, stage in corpus_pipeline.STAGES:
        for frame in (empty, odd):
            out = stage(spark, frame, SF)
            rows = out.collect()
            if name != "pieces":
                assert tuple(out.columns) == corpus_pipeline.COLUMNS
            assert len(rows) == 0 if frame is empty else name == "quality" or len(rows) == 3
