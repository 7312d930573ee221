"""Chat formatting of reply trees, in DataFrame functions only.

Messages name the message they answer. Iterative self-joins with doubling steps
lead every message to its root (depth and score of the branch on the way) and then
lay out the path of each chosen leaf, in as many rounds as the depth has binary
digits. Branches of a tree are ranked by score; each chosen path becomes one text.

Template: ``<turn>ROLE<turn:text>TEXT</turn>`` and a newline per message. Inside
roles and texts a backslash is doubled and ``<turn`` or ``</turn`` gets a backslash
after the ``<``, so no text can look like a mark, and taking one backslash from
each pair restores it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaero.llm.common import materialize

OPEN, SAYS, CLOSE = "<turn>", "<turn:text>", "</turn>\n"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), r"<(/?turn)", r"<\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(step tables, arrived) of nodes(tree, node, parent, score).

    Table k names for each message its ancestor 2^k steps up, if there is one
    (``up``), with the messages and scores passed on the way. Messages that are
    through to their root leave the rounds for ``arrived``, where ``hops`` is the
    depth and ``gain`` the score of the branch.
    """
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    first = nodes.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("hops"),
        F.coalesce("score", F.lit(0.0)).alias("gain"),
    )
    first = materialize(first, "steps")
    steps, arrived = [first.where("up IS NOT NULL")], first.where("up IS NULL")
    open_before = None
    while True:
        live = steps[-1]
        still = live.count()
        # on a cycle pointers stay for ever: then a round changes nothing but the cycle's own
        if not still or still == open_before:
            return steps, arrived
        open_before = still
        above = live.unionByName(arrived).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("hops").alias("hops2"),
            F.col("gain").alias("gain2"),
        )
        joined = materialize(
            live.join(above, ["tree", "up"]).select(
                "tree", "node", F.col("up2").alias("up"), (F.col("hops") + F.col("hops2")).alias("hops"),
                (F.col("gain") + F.col("gain2")).alias("gain"),
            ), "steps",
        )
        steps.append(joined.where("up IS NOT NULL"))
        arrived = arrived.unionByName(joined.where("up IS NULL"))


def branch_paths(nodes: DataFrame, branches: int) -> DataFrame:
    """(tree, leaf, branch, score, node, place): the messages of each tree's best branches.

    ``branch`` counts from 1 by falling score, ties by the smaller leaf; ``place``
    counts from 1 at the root.
    """
    steps, arrived = climb(nodes)
    parents = steps[0].select("tree", F.col("up").alias("node")).distinct()
    leaves = arrived.join(parents, ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree").orderBy(F.col("gain").desc(), "node")
    chosen = leaves.withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= branches)
    rows = chosen.select(
        "tree", F.col("node").alias("leaf"), "branch", F.col("gain").alias("score"), "node", F.col("hops").alias("place")
    )
    for k in range(len(steps) - 1, -1, -1):
        higher = steps[k].select("tree", "node", "up")
        both = F.array(
            F.struct("node", "place"),
            F.when(F.col("up").isNotNull(), F.struct(F.col("up").alias("node"), (F.col("place") - 2**k).alias("place"))),
        )
        rows = rows.join(higher, ["tree", "node"], "left").select(
            "tree", "leaf", "branch", "score", F.explode(F.filter(both, lambda x: x.isNotNull())).alias("at")
        ).select("tree", "leaf", "branch", "score", "at.node", "at.place")
    return rows


def format_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One row per chosen branch: tree, leaf, branch, score, formatted, loss_spans.

    ``messages`` has tree, node, parent, role, text and score; (tree, node) is unique
    and tree is not null. ``loss_spans`` are (start, length) in code points of the
    escaped texts of ``LEARNED_ROLE``, the part a model learns from. A null role or
    text counts as empty and a null score as 0. A parent that is null or not there
    makes a root. Messages on a cycle have no root and so no branch. An empty table
    gives no rows; other columns are ignored.
    """
    paths = branch_paths(messages.select("tree", "node", "parent", F.col("score").cast("double").alias("score")), branches)
    said = messages.select(
        "tree", "node", escape(F.coalesce("role", F.lit(""))).alias("role"),
        escape(F.coalesce("text", F.lit(""))).alias("text"),
        (F.coalesce("role", F.lit("")) == LEARNED_ROLE).alias("learned"),
    )
    turns = paths.join(said, ["tree", "node"]).groupBy("tree", "leaf", "branch", "score").agg(
        F.array_sort(F.collect_list(F.struct("place", "role", "text", "learned"))).alias("turns")
    )
    text = F.array_join(
        F.transform("turns", lambda t: F.concat(F.lit(OPEN), t.role, F.lit(SAYS), t.text, F.lit(CLOSE))), ""
    )
    marks = len(OPEN) + len(SAYS) + len(CLOSE)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        begin = state.at + len(OPEN) + F.char_length(t.role) + len(SAYS)
        span = F.struct(begin.cast("long").alias("start"), F.char_length(t.text).cast("long").alias("length"))
        after = state.at + marks + F.char_length(t.role) + F.char_length(t.text)
        return F.struct(
            after.cast("long").alias("at"),
            F.when(t.learned, F.concat(state.spans, F.array(span))).otherwise(state.spans).alias("spans"),
        )

    spans = F.aggregate("turns", start, step, lambda s: s.spans)
    return turns.select("tree", "leaf", "branch", "score", text.alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) of each turn of a formatted text."""
    parts = F.filter(F.split(formatted, r"</turn>\n"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), SAYS, 1)).alias("role"),
        unescape(F.substring_index(p, SAYS, -1)).alias("text"),
    ))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, restored, one piece after the other."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s.start + 1, s.length))), "")


def linear_messages(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees with one branch: each row answers the one before.

    Equal turns are ordered by role and text, null turns come first; rows without
    a conversation id form one conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.withColumn("node", F.row_number().over(order).cast("long")).select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"), "node",
        (F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"),
    )
