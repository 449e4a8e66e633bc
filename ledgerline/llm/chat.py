"""Reply trees formatted as conversations (native: DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Marks of the template; all control strings begin with ``<`` or ``[``, which texts carry escaped.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: Parts a tree's leaves are dealt to before its best branches are chosen.
RANK_PARTS = 64


def escape(text: Column) -> Column:
    """A backslash after each ``<`` and ``[``, and each backslash doubled: no control string is left."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), r"([<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\|\\(\\)", "$1$2")


def linear_replies(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) as a reply tree in which each row answers the one before.

    Rows are ordered by turn (null first), then role and text; repeated rows follow each other.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "turn", "role", "text").withColumn("message_id", F.row_number().over(order).cast("long"))
    return rows.withColumn("parent_id", F.when(F.col("message_id") > 1, F.col("message_id") - 1))


def _runs(messages: DataFrame) -> DataFrame:
    """(tree, node, parent, head, offset): each message with the first message of its unbranched run.

    A message that is its parent's only child continues the parent's run. Heads
    are found by pointer doubling: a self-join of the messages not yet there per
    doubling of the run length. A run is no longer than its tree, so what has no head
    after as many doublings goes round in a cycle and is left out.
    """
    nodes = messages.select("tree", "node", "parent")
    longest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    counted = nodes.groupBy("tree", "parent").agg(F.count("*").alias("n"))
    alone = counted.where("n = 1 and parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("p"), F.lit(True).alias("only"))
    known = nodes.select(F.col("tree").alias("kt"), F.col("node").alias("kn"))
    follows = F.col("only") & F.col("kn").isNotNull()
    at = (nodes.join(alone, (F.col("tree") == F.col("t")) & (F.col("parent") == F.col("p")), "left")
          .join(known, (F.col("tree") == F.col("kt")) & (F.col("parent") == F.col("kn")), "left")
          .select("tree", "node", F.col("kn").alias("parent"), F.when(follows, F.col("parent")).otherwise(F.col("node")).alias("head"),
                  F.when(follows, 1).otherwise(0).cast("long").alias("offset"), (~F.coalesce(follows, F.lit(False))).alias("settled")))
    at = materialise(at, "chat_runs")
    for _ in range(longest.bit_length() + 1):
        if (moving := at.where("not settled")).isEmpty():
            break
        ahead = at.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("head").alias("h"), F.col("offset").alias("o"), F.col("settled").alias("s"))
        moved = (moving.join(ahead, (F.col("tree") == F.col("t")) & (F.col("head") == F.col("n")))
                 .select("tree", "node", "parent", F.col("h").alias("head"), (F.col("offset") + F.col("o")).alias("offset"), F.col("s").alias("settled")))
        at = at.where("settled").unionByName(materialise(moved, "chat_moved"))
    return at.where("settled").drop("settled")


def best_branches(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """(tree, leaf, node, pos) of the messages on each chosen root-to-leaf path.

    ``messages`` has (tree, node, parent, score), none null but parent and score.
    Paths are enumerated by self-joins of the tree's unbranched runs, level by
    level; a branch's score is the sum along its path. Each tree keeps its
    ``branches`` best (null: all), ties to the smaller leaf.
    """
    runs = _runs(messages)
    scored = runs.join(messages.select("tree", "node", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")), ["tree", "node"])
    ends = scored.groupBy("tree", "head").agg(F.sum("score").alias("score"), F.count("*").alias("length"),
                                              F.max_by("node", "offset").alias("tail"), F.min_by("parent", "offset").alias("parent"))
    ends = materialise(ends, "chat_ends")
    of_tail = ends.select(F.col("tree").alias("t"), F.col("tail").alias("up_tail"), F.col("head").alias("up"))
    tree = materialise(ends.join(of_tail, (F.col("tree") == F.col("t")) & (F.col("parent") == F.col("up_tail")), "left")
                       .select("tree", "head", "up", "score", "length", "tail"), "chat_tree")

    # Down: score and first position of every run, level by level.
    level = tree.where("up is null").select("tree", "head", "up", "tail", F.col("score").alias("total"), F.lit(0).cast("long").alias("first"),
                                            F.col("length").alias("after"))
    done = None
    while True:
        level = materialise(level, "chat_level")
        if level.isEmpty():
            break
        done = level if done is None else done.unionByName(level)
        above = level.select(F.col("tree").alias("t"), F.col("head").alias("h"), F.col("total").alias("above"), F.col("after").alias("first"))
        level = (tree.join(above, (F.col("tree") == F.col("t")) & (F.col("up") == F.col("h")))
                 .select("tree", "head", "up", "tail", (F.col("above") + F.col("score")).alias("total"), "first", (F.col("first") + F.col("length")).alias("after")))
    if done is None:
        done = level
    inner = done.select(F.col("tree").alias("t"), F.col("up").alias("h")).where("h is not null").distinct()
    leaves = done.join(inner, (F.col("tree") == F.col("t")) & (F.col("head") == F.col("h")), "left_anti")
    if branches is not None:
        best = [F.col("total").desc(), F.col("tail")]
        leaves = leaves.withColumn("part", F.pmod(F.xxhash64("tail"), F.lit(RANK_PARTS)))
        for by in (["tree", "part"], ["tree"]):
            leaves = leaves.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*best))).where(F.col("rank") <= branches)

    # Up: the runs on each chosen path.
    step = leaves.select("tree", F.col("tail").alias("leaf"), "head", "up", "first")
    path = None
    links = done.select(F.col("tree").alias("t"), F.col("head").alias("h"), F.col("up").alias("u"), F.col("first").alias("f"))
    while True:
        step = materialise(step, "chat_path")
        if path is not None and step.isEmpty():
            break
        path = step if path is None else path.unionByName(step)
        step = step.join(links, (F.col("tree") == F.col("t")) & (F.col("up") == F.col("h"))).select("tree", "leaf", F.col("h").alias("head"), F.col("u").alias("up"), F.col("f").alias("first"))
    return (runs.select("tree", "node", "head", "offset").join(path.select("tree", "leaf", "head", "first"), ["tree", "head"])
            .select("tree", "leaf", "node", (F.col("first") + F.col("offset")).alias("pos")))


def format_reply_trees(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """One row per chosen branch: conv_id, leaf_id, formatted, loss_spans.

    ``messages`` has conv_id, message_id, parent_id, role, text and optionally
    score (default 1 each, so that longer branches rank first). A turn is
    ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a newline, role and text
    escaped. ``loss_spans`` holds (start, length) in code points of each
    assistant text in ``formatted``.

    Defined cases: null text or role is empty; null conv_id is one tree;
    a parent that is not in the tree makes its message a root, and each root
    starts branches of the same tree; messages without an id, with an id that another of
    the tree has, in a cycle, or below one are left out (answers to a repeated id are roots, as
    their parent is not there); an empty table gives no rows; extra
    columns are not carried. A branch is one row of output, so its text must fit
    a row; everything before that is spread by message.
    """
    score = F.col("score") if "score" in messages.columns else F.lit(1.0)
    tree = F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("null"))
    rows = materialise(messages.select("conv_id", tree.alias("tree"), F.col("message_id").alias("node"), F.col("parent_id").alias("parent"),
                                       F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), score.alias("score")), "chat_rows")
    twice = rows.groupBy(F.col("tree").alias("t"), F.col("node").alias("n")).count().where("count > 1")
    rows = rows.where("node is not null").join(twice, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("n")), "left_anti")
    chosen = best_branches(rows.select("tree", "node", "parent", "score"), branches)
    said = rows.select("conv_id", "tree", "node", (F.col("role") == "assistant").alias("learn"),
                       F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP)).alias("before"), escape(F.col("text")).alias("body"))
    said = said.withColumn("piece", F.concat("before", "body", F.lit(END)))
    order = Window.partitionBy("tree", "leaf").orderBy("pos")
    placed = chosen.join(said, ["tree", "node"]).withColumn(
        "start", F.sum(F.char_length("piece")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.char_length("piece") + F.char_length("before"))
    turns = F.array_sort(F.collect_list(F.struct("pos", "piece", "learn", "start", F.char_length("body").cast("long").alias("length"))))
    grouped = placed.groupBy("tree", "leaf").agg(F.first("conv_id").alias("conv_id"), turns.alias("turns"))
    return grouped.select("conv_id", F.col("leaf").alias("leaf_id"), F.array_join(F.col("turns.piece"), "").alias("formatted"),
                          F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as array of (role, text)."""
    parts = F.split(formatted, r"<\|im_start\|>")
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.struct(
        unescape(F.split(p, r"<\|im_sep\|>")[0]).alias("role"),
        unescape(F.regexp_replace(F.split(p, r"<\|im_sep\|>")[1], "<\\|im_end\\|>\n\\z", "")).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
