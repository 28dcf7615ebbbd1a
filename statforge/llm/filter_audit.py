"""Interaction audit of a sequence of filters, by contractions of contingency tensors.

Each filter passes or fails a document whatever the other filters do. So everything an
audit asks about any order of the filters follows from how many documents of a part have
each combination of failures: a tensor with an axis of length two (pass, fail) for each
filter. Spark counts the combinations: at most ``2 ** filters`` rows a part, whatever the
corpus, combined in the map tasks. The tensors of a part are then contracted along every
axis with a selector, ``pass``, ``fail`` or ``all``, for each step of each order; one
``einsum`` does so for all steps at once. Parts are contracted in separate tasks, and no
count passes through the driver.

The filters of the query (``words``: maximal runs outside ``[\\x20\\x09-\\x0D]``, case-sensitive):

* ``A`` fewer than 200 words
* ``B`` fewer than half of the words are distinct
* ``C`` more than three of a hundred code points are ``A-Z``
* ``D`` any of ``#$%&*|``
* ``E`` identical to the text of a smaller id, table-wide, whether that stays or not

Equal texts are found by SHA-256 and length. Only digests that several ids share are
joined back, one row a digest, so a text that a third of all rows repeat is one row of
the smaller side, and the larger side may be split.

A null text counts as empty: it fails ``A`` only, and ``E`` if a smaller id has an empty
text. Null ids are never smaller nor larger than any; rows that repeat id and text do not
fail ``E`` by each other. A null ``lang`` is the part of the empty string. A document
counts as good or toxic if any of its label rows says so. An empty table has no parts
and gives no rows; extra columns are passed over.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTERS = "ABCDE"
#: Limits of the filters: words; distinct words and capitals of a hundred.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3

STEPS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def text_failures(text: Column) -> dict[str, Column]:
    """Failures that a text alone decides."""
    words = words_of(text)
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > MOST_CAPITALS * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def repeats(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """``rows`` with ``E``: whether a smaller ``doc_id`` has the same ``key``."""
    shared = rows.groupBy(*key).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("largest")).where("least < largest")
    return rows.join(shared.select(*key, "least"), list(key), "left").withColumn("E", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, a boolean for each filter, ``good`` and ``toxic`` of every document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        *[c.alias(k) for k, c in text_failures(text).items()],
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).alias("size"),
    )
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    known = repeats(rows, ("digest", "size")).join(marks, "doc_id", "left")
    return known.select("part", *LETTERS, F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def combinations(rows: DataFrame, letters: str = LETTERS) -> DataFrame:
    """``part, cell, n, good, toxic``: documents of each combination of failures (bit ``i`` from the left: filter ``i`` fails)."""
    cell = sum((F.col(x).cast("int") * F.lit(1 << (len(letters) - 1 - i)) for i, x in enumerate(letters)), F.lit(0))
    return rows.groupBy("part", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def contracted(tensors: np.ndarray, selectors: list[list[tuple[int, int]]]) -> np.ndarray:
    """For each row of selectors, one an axis, the selected sums of all tensors (the first axis numbers the tensors)."""
    axes = tensors.ndim - 1
    chosen = np.array(selectors, dtype=np.int64).reshape(-1, axes, 2)
    operands: list = [tensors, list(range(axes + 1))]
    for i in range(axes):
        operands += [chosen[:, i], [axes + 1, i + 1]]
    return np.einsum(*operands, [axes + 1, 0], optimize="greedy")


def audited(tensors: np.ndarray, letters: str = LETTERS) -> list[tuple]:
    """One row a step of every order of the filters, from the part's tensors (all, good and toxic documents)."""
    orders = list(permutations(range(len(letters))))
    own, past = [], []
    for order in orders:
        for k, f in enumerate(order):
            before = order[:k]
            line = [PASS if x in before else ALL for x in range(len(letters))]
            own.append([FAIL if x == f else s for x, s in enumerate(line)])
            past.append([PASS if x == f else s for x, s in enumerate(line)])
    one = [[FAIL if x == f else ALL for x in range(len(letters))] for f in range(len(letters))]
    only = [[FAIL if x == f else PASS for x in range(len(letters))] for f in range(len(letters))]
    removed, kept = contracted(tensors, own), contracted(tensors, past)[:, 0]
    failing, unique = contracted(tensors, one)[:, 0], contracted(tensors, only)[:, 0]
    step = [(order, k, f) for order in orders for k, f in enumerate(order)]
    shapley = np.zeros(len(letters), dtype=np.int64)
    np.add.at(shapley, [f for _, _, f in step], removed[:, 0])
    return [
        ("".join(letters[x] for x in order), k + 1, int(kept[i]), int(removed[i, 0]), int(failing[f] - removed[i, 0]), int(unique[f]), int(removed[i, 1]), int(removed[i, 2]), int(shapley[f]))
        for i, (order, k, f) in enumerate(step)
    ]


def audit(rows: DataFrame, letters: str = LETTERS) -> DataFrame:
    """The contract's columns for documents whose failures are known (see :func:`judged`)."""
    shape = (2,) * len(letters)

    def steps(key: tuple[str], cells: pd.DataFrame) -> pd.DataFrame:
        tensors = np.zeros((3, 1 << len(letters)), dtype=np.int64)
        tensors[:, cells["cell"].to_numpy()] = cells[["n", "good", "toxic"]].to_numpy().T
        return pd.DataFrame([(key[0], *row) for row in audited(tensors.reshape(3, *shape), letters)], columns=[c.split()[0] for c in STEPS.split(", ")])

    return combinations(rows, letters).groupBy("part").applyInPandas(steps, STEPS)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(judged(docs, labels))
