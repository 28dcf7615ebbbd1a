"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Base spans (e-mail addresses, IPv4 addresses, card and phone numbers) are found with
expressions and checks, leftmost and non-overlapping per kind. They are the seeds of
the bootstrapping:

* every mention of a seed, and of any other token that looks like an identifier (it
  holds a digit), has contexts in its text: the two words before it, the two words after
  it, and the word on each side; these are the lexical patterns;
* distinct (pattern, identifier) pairs are the edges of a graph, which is scored in
  rounds of joins: a pattern's confidence is the summed score of its
  identifiers over their number plus one, an unseen identifier's score is the
  probability that not all of its confident patterns are wrong. Seeds stay at one;
  tokens that have the form of a base kind but fail its check stay at zero, which
  holds back patterns that say nothing;
* an identifier that several confident patterns vouch for is discovered: it counts as
  a seed from then on, so its own contexts may become confident. Rounds go on until one
  discovers nothing. All mentions of the discovered become spans of kind ``id``.

Edges are distinct before they are joined, so an identifier or a line that a third
of all documents repeat is one edge; rounds read only the unseen identifiers that are
left. Positions are code points, ends exclusive.

All work is linear in the text: runs are matched possessively and only from their
beginning (or from the end of the match before), mentions become rows whose places are
running sums, and overlaps are found by running maxima in the order of the places, so
one text may hold any number of mentions. Null and empty
texts have no spans. Repeated rows each give their own result. An empty table gives
an empty result; extra columns are passed over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statforge.llm.common import materialise

BASE_KINDS = ("email", "ip", "card", "phone")
KIND = "id"
#: Least confidence of a pattern; distinct trusted identifiers it needs.
PATTERN_CONFIDENCE, PATTERN_SUPPORT = 0.7, 3
#: Least score of a discovered identifier, and confident patterns it needs.
IDENTIFIER_SCORE, IDENTIFIER_PATTERNS = 0.9, 2
#: Characters around a mention in which its context words are sought.
CONTEXT = 64
#: Characters of a text that are cut out of a piece of it at once.
CHUNK = 1024

# The forms of the base kinds. Possessive runs give the same matches as
# greedy ones here, because what follows a run is never one of its characters.
_LOCAL = "A-Za-z0-9._%+-"
FORMS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP_CHECK = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"
#: Tokens that look like identifiers: 5 to 64 letters, digits, ``_`` or ``-``, a digit among them.
TOKEN = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]{0,63}[0-9])[A-Za-z0-9][A-Za-z0-9_-]{4,63}+(?![A-Za-z0-9_-])"


def _matches(form: str, may: Column) -> Column:
    return F.when(may, F.regexp_extract_all("text", F.lit(form), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _gaps(form: str, matches: str) -> Column:
    return F.when(F.size(matches) > 0, F.split("text", form, -1)).otherwise(F.array().cast("array<string>"))


def _pieces(kind: str, matches: str, gaps: str) -> Column:
    """One struct for each match: its number, the length of the gap before it, and the text around it.

    The text around is put together from the neighbouring gaps and matches, so it is that of
    the document, whatever stands there.
    """
    tail, head = (lambda x: F.right(F.coalesce(x, F.lit("")), F.lit(CONTEXT))), (lambda x: F.left(F.coalesce(x, F.lit("")), F.lit(CONTEXT)))
    match, gap = (lambda k: F.get(matches, k)), (lambda k: F.get(gaps, k))

    def piece(k: Column) -> Column:
        # two matches back and forth hold the two words of a pattern, or the gaps between do
        before = F.concat(tail(gap(k - 2)), tail(match(k - 2)), tail(gap(k - 1)), tail(match(k - 1)), tail(gap(k)))
        after = F.concat(head(gap(k + 1)), head(match(k + 1)), head(gap(k + 2)), head(match(k + 2)), head(gap(k + 3)))
        return F.struct(
            F.lit(kind).alias("kind"), k.alias("k"), F.length(gap(k)).cast("long").alias("gap"), match(k).alias("value"),
            F.right(before, F.lit(CONTEXT)).alias("before"), F.left(after, F.lit(CONTEXT)).alias("after"),
        )

    return F.transform(F.when(F.size(matches) > 0, F.sequence(F.lit(0), F.size(matches) - 1)).otherwise(F.array().cast("array<int>")), piece)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    """Whether a match of a base kind's form passes its check."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(IP_CHECK)
    if kind == "card":
        return F.when(F.length(_digits(value)).between(13, 19), F.call_function("luhn_check", _digits(value))).otherwise(F.lit(False))
    return F.length(_digits(value)).between(9, 15)


def numbered(docs: DataFrame, keep: bool = False) -> DataFrame:
    """``rid, doc_id, text`` of every row, and its other columns under ``row`` if asked; written, so that a row keeps its number."""
    kept = [F.struct(*[c for c in docs.columns if c != "text"]).alias("row")] if keep else []
    return materialise(docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text", *kept), "numbered")


def located(rows: DataFrame) -> DataFrame:
    """``rid, kind, start, end, value, before, after, ok``: all matches of the base forms, and identifier-like tokens.

    ``ok`` says whether a match of a base form passes its check.
    """
    digit = F.col("text").rlike("[0-9]")
    may = {
        "email": F.contains("text", F.lit("@")),
        "ip": F.col("text").rlike(r"[0-9]\.[0-9]"),
        "card": digit,
        "phone": F.contains("text", F.lit("+")),
        "token": digit,
    }
    forms = {**FORMS, "token": TOKEN}
    rows = rows.where(F.contains("text", F.lit("@")) | digit)
    rows = rows.select("rid", "text", *[_matches(forms[k], may[k]).alias(f"m_{k}") for k in forms])
    rows = rows.select("rid", *[f"m_{k}" for k in forms], *[_gaps(forms[k], f"m_{k}").alias(f"g_{k}") for k in forms])
    rows = rows.select("rid", F.inline(F.concat(*[_pieces(k, f"m_{k}", f"g_{k}") for k in forms])))
    so_far = Window.partitionBy("rid", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(so_far))
    check = F.lit(True)
    for kind in BASE_KINDS[1:]:
        check = F.when(F.col("kind") == kind, valid(kind, F.col("value"))).otherwise(check)
    return rows.select("rid", "kind", (F.col("end") - F.length("value")).alias("start"), "end", "value", "before", "after", check.alias("ok"))


# --------------------------------------------------------------------------- the graph
def mentions(found: DataFrame) -> DataFrame:
    """``rid, value, seed, failed, start, end, before, after``: seeds, and tokens that no base mention touches.

    A token inside a match of a base kind that fails its check is marked ``failed``.
    """
    up = Window.partitionBy("rid").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("rid").orderBy("back").rangeBetween(Window.unboundedPreceding, 0)
    token = F.col("kind") == "token"
    base, bad = ~token & F.col("ok"), ~token & ~F.col("ok")
    rows = found.withColumns({"back": -F.col("start"), "base_end": F.max(F.when(base, F.col("end"))).over(up), "bad_end": F.max(F.when(bad, F.col("end"))).over(up)})
    rows = rows.withColumn("base_start", F.min(F.when(base, F.col("start"))).over(down))
    touched = F.coalesce(F.col("base_end") > F.col("start"), F.lit(False)) | F.coalesce(F.col("base_start") < F.col("end"), F.lit(False))
    rows = rows.where(base | (token & ~touched))
    return rows.select("rid", F.lower("value").alias("value"), (~token).alias("seed"), (token & F.coalesce(F.col("bad_end") >= F.col("end"), F.lit(False))).alias("failed"), "start", "end", "before", "after")


def edges(seen: DataFrame) -> DataFrame:
    """Distinct ``pattern, value, seed, failed``."""
    blank, word, mark = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]+", r"[^A-Za-z0-9\x20\x09-\x0D]*"
    before, after = F.lower("before"), F.lower("after")
    one_line = lambda x: F.regexp_replace(x, rf"{blank}+", " ")
    two = F.regexp_extract(before, rf"({word}{blank}+{word}){blank}*{mark}$", 1)
    one = F.regexp_extract(before, rf"({word}){blank}*{mark}$", 1)
    nxt = F.regexp_extract(after, rf"^{mark}{blank}+({word})", 1)
    then = F.regexp_extract(after, rf"^{mark}{blank}+({word}{blank}+{word})", 1)
    left = F.when(two != "", F.concat(F.lit("left "), one_line(two)))
    right = F.when(then != "", F.concat(F.lit("right "), one_line(then)))
    around = F.when((one != "") & (nxt != ""), F.concat_ws(" ", F.lit("around"), one, F.lit("_"), nxt))
    rows = seen.select("value", "seed", "failed", F.explode(F.filter(F.array(left, right, around), lambda p: p.isNotNull())).alias("pattern"))
    return rows.groupBy("pattern", "value").agg(F.max("seed").alias("seed"), F.max("failed").alias("failed"))


def confident_patterns(scored: DataFrame) -> DataFrame:
    """``pattern, confidence`` of the patterns of scored edges (``pattern, value, s``) that are confident."""
    patterns = scored.groupBy("pattern").agg((F.sum("s") / (F.count(F.lit(1)) + 1)).alias("confidence"), F.sum((F.col("s") >= IDENTIFIER_SCORE).cast("int")).alias("trusted"))
    return patterns.where((F.col("confidence") >= PATTERN_CONFIDENCE) & (F.col("trusted") >= PATTERN_SUPPORT))


def discovered(graph: DataFrame) -> DataFrame:
    """``value, score`` of the unseen identifiers that confident patterns vouch for (``graph`` is read each round).

    Scores never fall from round to round: what is discovered stays so, and the others
    keep their partial scores as evidence for patterns. Each round but the last
    discovers an identifier, and as a rule there are few.
    """
    fixed = F.when(F.col("seed"), 1.0).when(F.col("failed"), 0.0)
    scores, known = None, -1
    while True:
        if scores is None:
            scored = graph.withColumn("s", F.coalesce(fixed, F.lit(0.0)))
        else:
            scored = graph.join(scores, "value", "left").withColumn("s", F.coalesce(fixed, F.when(F.col("found"), F.lit(1.0)), F.col("score"), F.lit(0.0))).drop("score", "found")
        unseen = graph.where("NOT seed AND NOT failed").select("pattern", "value").join(confident_patterns(scored), "pattern")
        doubt = F.exp(F.sum(F.log(1 - F.col("confidence"))))  # confidence is below one by its smoothing
        now = unseen.groupBy("value").agg((1 - doubt).alias("score"), F.count(F.lit(1)).alias("patterns"))
        now = now.select("value", "score", ((F.col("score") >= IDENTIFIER_SCORE) & (F.col("patterns") >= IDENTIFIER_PATTERNS)).alias("found"))
        if scores is not None:
            now = now.unionByName(scores).groupBy("value").agg(F.max("score").alias("score"), F.max("found").alias("found"))
        scores = materialise(now, "identifiers")
        count = scores.where("found").count()
        if count <= max(known, 0):
            return scores.where("found").select("value", "score")
        known = count


def span_rows(rows: DataFrame) -> DataFrame:
    """``rid, place, start, end, kind`` of all spans of numbered rows; ``place`` orders the kinds (the base kinds, then ``id``)."""
    found = materialise(located(rows), "located")
    seen = materialise(mentions(found), "mentions")
    new = seen.where("NOT seed AND NOT failed").join(discovered(materialise(edges(seen), "edges")), "value")
    order = F.array_position(F.array(*map(F.lit, BASE_KINDS)), F.col("kind")).cast("int")
    spans = found.where("kind <> 'token' AND ok").select("rid", order.alias("place"), "start", "end", "kind")
    return spans.unionByName(new.select("rid", F.lit(len(BASE_KINDS) + 1).alias("place"), "start", "end", F.lit(KIND).alias("kind")))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``rid, doc_id, spans``: all spans by kind (the base kinds, then ``id``), then start."""
    rows = numbered(docs)
    whole = span_rows(rows).groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("place", "start", "end", "kind"))).alias("spans"))
    named = F.transform(F.coalesce("spans", F.array().cast("array<struct<place:int,start:bigint,end:bigint,kind:string>>")), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return rows.select("rid", "doc_id").join(whole, "rid", "left").select("rid", "doc_id", named.alias("spans"))


def _cut(begin: Column, end: Column) -> Column:
    """``text[begin:end]`` from its chunks (``chunks``): the first, those between, and the last."""
    first, last = F.floor(begin / CHUNK).cast("int"), F.floor(end / CHUNK).cast("int")
    within = lambda x: F.pmod(x, F.lit(CHUNK)).cast("int")
    chunk = lambda k: F.coalesce(F.get("chunks", k), F.lit(""))
    same = F.substring(chunk(first), within(begin) + 1, (end - begin).cast("int"))
    across = F.concat(F.substring(chunk(first), within(begin) + 1, F.lit(CHUNK)), F.array_join(F.slice("chunks", first + 2, F.greatest(last - first - 1, F.lit(0))), ""), F.substring(chunk(last), F.lit(1), within(end)))
    return F.when(begin >= end, F.lit("")).when(first == last, same).otherwise(across)


def redacted(docs: DataFrame) -> DataFrame:
    """The documents, with ``<EMAIL>`` and the like in place of spans and ``n_chars`` of the new text.

    Spans that overlap are replaced as one, under the name of the first of them.
    """
    rows = numbered(docs, keep=True)
    # each span with the end of all spans before it: where that is beyond its start, it is part of them
    before = Window.partitionBy("rid").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    each = span_rows(rows).withColumn("at", F.coalesce(F.max("end").over(before), F.lit(0).cast("long")))
    cuts = each.groupBy("rid").agg(F.sort_array(F.collect_list(F.when(F.col("start") >= F.col("at"), F.struct("start", "at", "kind")))).alias("cuts"), F.max("end").alias("rest"))
    # the texts are exchanged once, for this join
    held = rows.join(cuts, "rid", "left").select("row", "text", "cuts", "rest", F.when(F.col("cuts").isNotNull(), F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))).alias("chunks"))
    parts = F.transform("cuts", lambda c: F.concat(_cut(c["at"], c["start"]), F.lit("<"), F.upper(c["kind"]), F.lit(">")))
    clean = F.concat(F.array_join(parts, ""), _cut(F.col("rest"), F.length("text").cast("long")))
    out = held.select("row", F.when(F.col("cuts").isNotNull(), clean).otherwise(F.col("text")).alias("clean"))
    new = {"text": F.col("clean"), "n_chars": F.length(F.coalesce("clean", F.lit(""))).cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: counts and digest of the base spans, and all spans."""
    spans = find_personal_data(docs)
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return spans.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(span_text(of(*BASE_KINDS)), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
