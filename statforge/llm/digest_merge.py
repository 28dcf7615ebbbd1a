"""Exact duplicates by a tree-merge of sorted digest runs, with DataFrame functions only.

Texts are equal if they are identical after every character of ``[\\x20\\x09-\\x0D]`` is
deleted. Of equal texts the row with the most code points in its original text stays,
then the one with the smallest id.

* *Runs.* Every input partition belongs to one of ``N`` nodes (a power of two, at least
  the number of shuffle partitions). A node's run has one entry for each distinct
  digest: the best row, and how many rows there are. Map-side combining makes it, so a
  text that a third of all rows repeat is one entry a node before anything is exchanged.
* *Rounds.* Nodes and digests are numbered with the same ``log2 N`` bits. A round settles
  up to ``ROUND_BITS`` of them: the nodes that differ in these bits only exchange their
  runs, each taking the part of the digests whose bits are its own, and merge the runs
  that they get, sorted by digest, into one. Entries of equal digests become one and
  keep the better row. After the last round a node holds the slice of the digests that
  is its number, each digest once. No node ever holds more than its slice of the digests
  of the nodes merged so far, so there is no root through which all of them pass.
* *Verification.* Digests are SHA-256. An entry also carries the length and an
  independent 64-bit hash of its normalised text, and these are part of the key at every
  level: entries that agree in the digest alone are never merged.
* *Back.* The result meets the nodes' first runs (a digest is there at most once a node)
  and these meet the rows of their node, so the rows of one text are joined node by node.

A null text counts as empty; empty and all-blank texts are equal to each other. Null
ids come after all others. Rows that repeat id and text are rows of one group, of which
exactly one is kept (ids and lengths being equal, which one cannot be seen). An empty
table gives an empty result; extra columns are passed over unless asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statforge.llm.common import materialise

#: Bits that a round settles: runs of ``2 ** ROUND_BITS`` nodes are merged at once.
ROUND_BITS = 3
#: What must agree for texts to be equal.
KEY = ("digest", "normal_bytes", "check")


def node_bits(docs: DataFrame) -> int:
    """``log2 N``: as many nodes as shuffle partitions, or up to twice as many."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(parts - 1, 1).bit_length()


def rounds_of(bits: int, width: int = ROUND_BITS) -> list[tuple[int, int]]:
    """``(lowest bit, number of bits)`` that each round settles."""
    return [(at, min(width, bits - at)) for at in range(0, bits, width)]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def slice_of(digest: Column, bits: int) -> Column:
    """The node that holds a digest in the end: its first ``bits`` bits."""
    return F.shiftright(F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long"), 32 - bits)


def digested(docs: DataFrame, bits: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """``node, rid, doc_id, chars`` and the key of every row; ``keep`` names columns carried along under ``row``."""
    kept = [F.struct(*keep).alias("row")] if keep else []
    rows = docs.select(
        F.pmod(F.spark_partition_id(), F.lit(1 << bits)).cast("long").alias("node"),
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"),
        normalised(F.col("text")).alias("normal"),
        *kept,
    )
    return rows.select(
        "node", "rid", "doc_id", "chars", F.unhex(F.sha2("normal", 256)).alias("digest"), F.octet_length("normal").cast("long").alias("normal_bytes"), F.xxhash64("normal").alias("check"), *(["row"] if keep else [])
    )


def first_runs(rows: DataFrame) -> DataFrame:
    """One entry a node and digest: ``best`` (least is best) and ``n`` rows."""
    best = F.struct((-F.col("chars")).alias("order"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid")
    return rows.groupBy("node", *KEY).agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("n"))


def exchanged(runs: DataFrame, bits: int, at: int, width: int) -> DataFrame:
    """One round: entries move to the node whose bits ``at .. at + width`` are those of their digest, and are merged there."""
    mask = ((1 << width) - 1) << at
    to = F.col("node").bitwiseAND(F.lit(~mask)).bitwiseOR(slice_of(F.col("digest"), bits).bitwiseAND(F.lit(mask)))
    sent = runs.withColumn("node", to).repartition(1 << bits, "node").sortWithinPartitions("node", *KEY)
    return sent.groupBy("node", *KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def merged(runs: DataFrame, bits: int, width: int = ROUND_BITS) -> DataFrame:
    """Every digest once, with the best row and the number of rows of all nodes."""
    for at, step in rounds_of(bits, width):
        runs = exchanged(runs, bits, at, step)
    return runs


def duplicate_groups(docs: DataFrame, keep: tuple[str, ...] = (), width: int = ROUND_BITS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, and ``row`` if asked, of every row."""
    bits = node_bits(docs)
    rows = materialise(digested(docs, bits, keep), "digested")  # written: a node is a place that must not move
    runs = materialise(first_runs(rows), "runs")
    whole = merged(runs, bits, width).select(*KEY, "best", "n")
    told = runs.select("node", *KEY).join(whole, list(KEY))
    return rows.join(told, ["node", *KEY]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("rid") == F.col("best.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *(["row"] if keep else []),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    return duplicate_groups(docs, tuple(docs.columns)).where("kept").select("row.*")
