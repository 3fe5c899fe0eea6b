"""Reply trees to formatted conversations, with DataFrame and SQL functions only.

A message points at the one it replies to.  Self-joins double the reach of those
pointers and sum up scores and depths on the way, so a tree of depth d takes
log2(d) rounds.  A leaf's sums rank its branch; the messages of chosen branches
are then enumerated from the same pointers, longest reach first, which meets
each message of a path once.

Each turn is ``<|im_start|>role``, a line end, the text and ``<|im_end|>`` with a
line end.  In roles and texts a backslash is doubled, and one is put behind the
first character of every control string, so none is left in them; a line end in a
role gets one before it.  Reading takes the backslashes away again.

Cases: a null text or role is an empty one; a reply to a message that is not
there starts a tree of its own branch; messages in a loop have no root and take
no part; of messages that repeat an id in a tree the first by role and text
counts; a null tree id is a tree; an empty table gives no rows; other columns
are not read.  One conversation is one row, so its text has to fit a string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nodepulse.llm.common import kept

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# The places in a text where a control string of a known chat template begins.
CONTROL = r"(<)(?=\||/?s>|</?SYS>>)|(\[)(?=/?INST\])"


def escape(text: Column) -> Column:
    """``text`` without control strings; :func:`unescape` gives it back."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def role_line(role: Column) -> Column:
    return F.regexp_replace(escape(role), "\n", "\\\\\n")


def _beside(left: DataFrame, right: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    return left.alias("a").join(right.alias("b"), F.expr("a.tree <=> b.tree") & on, how)


def branches(messages: DataFrame, keep: int = 1) -> DataFrame:
    """(tree, branch, node, depth) of the ``keep`` best root-to-leaf paths of each tree, depth from 1 at the root.

    ``messages`` has tree, node, parent and score.  Branches rank by the sum of
    their scores, then by the smaller leaf.
    """
    first = messages.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    there = _beside(first, first.select("tree", "node"), F.expr("a.parent = b.node"), "left")
    up = kept(there.selectExpr("a.tree", "a.node", "b.node as parent", "score", "1L as depth"), "replies")
    reach, open_ = [up], up.where("parent is not null").count()
    while open_:
        # Only messages whose pointer has not passed the root yet go on.
        step = _beside(up.where("parent is not null"), up, F.expr("a.parent = b.node"), "left")
        step = step.selectExpr(
            "a.tree", "a.node", "b.parent", "a.score + coalesce(b.score, 0) as score", "a.depth + coalesce(b.depth, 0) as depth"
        )
        up = kept(step.unionByName(up.where("parent is null")), "replies")
        now = up.where("parent is not null").count()
        if now == open_:  # only loops are left
            break
        reach.append(up)
        open_ = now
    sums = up.where("parent is null")
    leaves = _beside(sums, reach[0].select("tree", "parent"), F.expr("a.node = b.parent"), "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
    chosen = leaves.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= keep)
    path = kept(chosen.select("tree", "branch", "node", "depth"), "paths")
    for k in reversed(range(len(reach))):
        step = _beside(path, reach[k].where("parent is not null"), F.expr("a.node = b.node"))
        step = step.selectExpr("a.tree", "a.branch", "b.parent as node", f"a.depth - {1 << k}L as depth")
        path = kept(path.unionByName(step), "paths")
    return path


def conversations(messages: DataFrame, keep: int = 1, train_on: str = "assistant", unique: bool = False) -> DataFrame:
    """(tree, branch, formatted, loss): one conversation for each chosen branch.

    ``messages`` has tree, node, parent, role, text and score.  ``loss`` holds
    (start, length) in code points of the texts whose role is ``train_on``.
    ``unique`` says that no id repeats in a tree; then paths are found without
    moving any text.
    """
    said = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    one = messages.select("tree", "node", "parent", "score", *said)
    if not unique:
        least = F.min(F.struct("role", "text", "parent", "score")).alias("m")
        one = one.groupBy("tree", "node").agg(least).select("tree", "node", "m.*")
    path = branches(one, keep)
    rows = _beside(path, one, F.expr("a.node = b.node")).selectExpr("a.tree", "a.branch", "a.depth", "b.role", "b.text")
    rows = rows.withColumn("head", F.concat(F.lit(OPEN), role_line(F.col("role")), F.lit("\n"))).withColumn("body", escape(F.col("text")))
    before = Window.partitionBy("tree", "branch").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    size = F.char_length("head") + F.char_length("body") + len(CLOSE)
    rows = rows.withColumn("start", F.coalesce(F.sum(size.cast("long")).over(before), F.lit(0)) + F.char_length("head"))
    span = F.when(
        F.col("role") == train_on, F.struct(F.col("start").alias("start"), F.char_length("body").cast("long").alias("length"))
    )
    turns = F.array_sort(F.collect_list(F.struct("depth", F.concat("head", "body", F.lit(CLOSE)).alias("turn"), span.alias("span"))))
    grouped = rows.groupBy("tree", "branch").agg(turns.alias("t"))
    return grouped.select(
        "tree",
        "branch",
        F.array_join("t.turn", "").alias("formatted"),
        F.filter("t.span", lambda s: s.isNotNull()).alias("loss"),
    )


def turns_of(formatted: Column) -> Column:
    """The (role, text) of each turn, read back from a formatted conversation."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    head = r"^<\|im_start\|>((?:[^\\\n]++|\\[\s\S])*+)\n([\s\S]*)$"
    return F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda p: F.struct(
            unescape(F.regexp_extract(p, head, 1)).alias("role"), unescape(F.regexp_extract(p, head, 2)).alias("text")
        ),
    )


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )


def linear(rows: DataFrame) -> DataFrame:
    """Messages of ``conversations`` rows: each turn replies to the one before it; a turn's score is its length.

    Rows of one turn follow each other by role and a hash of the text.
    """
    rows = rows.select(
        F.col("conv_id").alias("tree"), "turn", "role", "text", F.coalesce(F.char_length("text"), F.lit(0)).alias("score"),
        F.xxhash64("text").alias("tie"),
    )
    node = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "tie")).cast("long")
    return rows.select("tree", node.alias("node"), F.nullif(node - 1, F.lit(0)).alias("parent"), "role", "text", "score")
