"""Chat formatting from reply trees, with DataFrame functions only.

A conversation is a tree of messages. Iterative self-joins double, in each round,
how far every message can see towards its root; after as many rounds as the depth
has binary digits every message knows its depth and the summed score of its path.
Leaves are ranked by that score (then depth, then the smaller node id), the best
branches of each tree are kept, and the doubling tables, used from the longest jump
to the shortest, list all messages of each kept branch. Each branch is formatted as
one conversation.

The template marks a turn as ``### role``, a line end, the text and ``</turn>``.
Texts that hold ``### `` or ``</turn>`` get one backslash more inside these strings
than they had, so the marks stay unique and the texts come back exactly; roles also
have their backslashes and line ends spelled out. The loss mask lists the spans (code
points of the formatted conversation) of the assistant's texts.

Null texts and roles are empty. A null tree id is a tree like others. Rows with the
same conversation and turn are ordered by role, then text. A parent that does not
exist makes its reply a root; messages on or below a ring of parents are on no path
from a root and are left out. An empty table gives an empty result; extra columns
are passed over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statforge.llm.common import materialise

# Fixed values of the template.
OPEN, CLOSE = "### ", "</turn>"
ASSISTANT = "assistant"


# --------------------------------------------------------------------------- template
def escape(text: Column) -> Column:
    """One backslash more in every control string."""
    return F.regexp_replace(F.regexp_replace(text, r"(\\*)### ", r"\\$1### "), r"<(\\*)/turn>", r"<\\$1/turn>")


def unescape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"<\\(\\*)/turn>", "<$1/turn>"), r"\\(\\*)### ", "$1### ")


def escape_role(role: Column) -> Column:
    """A role on one line: backslashes and line ends spelled out, control strings escaped."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


# --------------------------------------------------------------------------- trees
def chains(conversations: DataFrame) -> DataFrame:
    """A table of turns as trees: each turn replies to the one before; every turn scores one."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    numbered = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return numbered.select(
        F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(1.0).alias("score")
    )


def _on(left: DataFrame, right: DataFrame, up: str, node: str):
    return left["tree"].eqNullSafe(right["tree_r"]) & (left[up] == right[node])


def doubled(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Doubling tables and what they add up to.

    The first result has, for each round ``k``, ``tree, node, up``: the message
    ``2**k`` above every message that has one. The second has ``tree, node, depth,
    total``: number and summed score of the messages from the node to its root. A
    round only joins the messages that do not yet see their root, and is written, so
    no round's plan holds the ones before.
    """
    size = messages.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    ids = messages.select(F.col("tree").alias("tree_r"), F.col("node").alias("id"))
    own = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("total"))
    state = materialise(own.join(ids, _on(own, ids, "parent", "id"), "left").select("tree", "node", F.col("id").alias("up"), F.lit(1).cast("long").alias("depth"), "total"), "replies")
    levels, done, active = [state], state.where("up IS NULL"), state.where("up IS NOT NULL")
    while (1 << (len(levels) - 1)) < size and not active.isEmpty():
        known = done.unionByName(active)
        b = known.select(F.col("tree").alias("tree_r"), F.col("node").alias("id"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("total").alias("gain"))
        step = active.join(b, _on(active, b, "up", "id"), "left").select(
            "tree", "node", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), (F.col("total") + F.coalesce("gain", F.lit(0.0))).alias("total")
        )
        state = materialise(step, "replies")
        levels.append(state)
        done, active = done.unionByName(state.where("up IS NULL")), state.where("up IS NOT NULL")
    return [x.where("up IS NOT NULL").select("tree", "node", "up") for x in levels], done.select("tree", "node", "depth", "total")


def best_branches(levels: list[DataFrame], rooted: DataFrame, top: int = 1) -> DataFrame:
    """``tree, leaf, depth, rank``: the ``top`` branches of every tree."""
    parents = levels[0].select(F.col("tree").alias("tree_r"), F.col("up").alias("id")).distinct()
    leaves = rooted.join(parents, _on(rooted, parents, "node", "id"), "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("depth"), "node")
    return leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("tree", F.col("node").alias("leaf"), "depth", "rank")


def branch_messages(messages: DataFrame, levels: list[DataFrame], branches: DataFrame) -> DataFrame:
    """``tree, leaf, place, role, text``: every message of the kept branches, place 1 at the root."""
    path = branches.select("tree", "leaf", F.col("leaf").alias("node"), F.col("depth").alias("place"))
    for k in reversed(range(len(levels))):
        jump = levels[k].select(F.col("tree").alias("tree_r"), F.col("node").alias("id"), "up")
        wide = path.join(jump, _on(path, jump, "node", "id"), "left")
        here = F.struct("node", "place")
        above = F.struct(F.col("up").alias("node"), (F.col("place") - F.lit(1 << k)).alias("place"))
        each = F.explode(F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, above))).alias("at")
        path = wide.select("tree", "leaf", each).select("tree", "leaf", "at.node", "at.place")
    texts = messages.select(F.col("tree").alias("tree_r"), F.col("node").alias("id"), "role", "text")
    return path.join(texts, _on(path, texts, "node", "id")).select("tree", "leaf", "place", "role", "text")


# --------------------------------------------------------------------------- conversations
def formatted(turns: DataFrame) -> DataFrame:
    """``tree, leaf, conversation, loss``: one formatted conversation for each branch."""
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    pieces = turns.select("tree", "leaf", "place", head.alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == ASSISTANT).alias("learn"))
    end = F.lit(CLOSE + "\n")
    so_far = Window.partitionBy("tree", "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("head") + F.length("body") + len(CLOSE) + 1
    placed = pieces.withColumn("stop", F.sum(size.cast("long")).over(so_far) - (len(CLOSE) + 1))
    turn = F.struct("place", F.concat("head", "body", end).alias("turn"), "learn", (F.col("stop") - F.length("body")).alias("start"), "stop")
    listed = placed.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return listed.select(
        "tree",
        "leaf",
        F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("conversation"),
        F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop"))).alias("loss"),
    )


def turns_of(conversation: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    parts = F.split(conversation, f"{CLOSE}\n", -1)
    inner = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.substring(p, len(OPEN) + 1, 2**31 - 1))
    role = lambda p: F.substring_index(p, "\n", 1)
    text = lambda p: F.substring(p, F.length(role(p)) + 2, F.lit(2**31 - 1))
    return F.transform(inner, lambda p: F.struct(unescape_role(role(p)).alias("role"), unescape(text(p)).alias("text")))


def learned_text(conversation: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    cut = lambda s: unescape(F.substring(conversation, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))
    return F.array_join(F.transform(loss, cut), "")


def format_trees(messages: DataFrame, top: int = 1) -> DataFrame:
    """The best branches of every tree, formatted."""
    levels, rooted = doubled(messages)
    return formatted(branch_messages(messages, levels, best_branches(levels, rooted, top)))


def digest(output: DataFrame) -> DataFrame:
    """The contract's columns, read back from formatted conversations."""
    back = output.select(F.col("tree").alias("conv_id"), "conversation", turns_of(F.col("conversation")).alias("turns"), learned_text(F.col("conversation"), F.col("loss")).alias("learned"))
    plain = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(plain, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("conversation").cast("long").alias("formatted_chars"),
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """The contract's columns for a table of turns; trees and output are written and read again."""
    messages = materialise(chains(conversations), "messages")
    return digest(materialise(format_trees(messages), "formatted"))
