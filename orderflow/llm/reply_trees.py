"""Reply trees as conversations: root-to-leaf paths by self-joins, ranked, formatted, read back.

Every message points to the one it answers. Pointers are doubled: a join of the table with itself
turns pointers over 1, 2, 4 … messages into pointers over twice as many, together with the sum of
scores on the way, until all have passed their roots. The same tables, taken from the widest down
to the narrowest, then enumerate the messages of each chosen branch, each exactly once. Everything
is DataFrame code over built-in functions.

A turn is written as <|im_start|>role<|im_sep|>text<|im_end|>. Inside roles and texts a backslash
is doubled and every "<|" becomes "<\\|", so that no marker can occur there; both are undone on
reading. The loss mask lists, per assistant turn, where its text lies within the turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .cuts import Cuts

# The marks of the template.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
ASSISTANT = "assistant"


def branches(
    messages: DataFrame, *, tree: str = "tree_id", msg: str = "msg_id", parent: str = "parent_id",
    score: str = "score", role: str = "role", text: str = "text", top: int | None = 1,
) -> DataFrame:
    """tree_id, branch, score, place, role, text of the `top` best branches of every tree.

    A branch is the way from a root to a leaf, its score the sum over its messages; branch 1 is
    the best, ties go to the smaller leaf, `top=None` keeps all. Cases: a null parent, or one that
    is not in the tree, makes a root; a null score counts 0; null roles and texts are empty; a
    null tree is a tree of its own; of rows with the same tree and message the least stays;
    messages in or below a circle have no root and are on no branch; an empty table gives no rows.
    """
    cuts = Cuts(messages.sparkSession)
    clean = messages.select(
        F.struct(F.col(tree).alias("tree"), F.col(msg).alias("msg")).alias("node"),
        F.struct(
            F.when(
                F.col(parent).isNotNull(), F.struct(F.col(tree).alias("tree"), F.col(parent).alias("msg"))
            ).alias("up"),
            F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("score"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("body"),
    )
    nodes = cuts.cut(clean.groupBy("node").agg(F.min("body").alias("body")).select("node", "body.*"))
    keys = nodes.select(F.col("node").alias("is"), F.lit(True).alias("there"))
    level = cuts.cut(
        nodes.select("node", "up", "score")
        .join(keys, F.col("up") == F.col("is"), "left")
        .select("node", F.when(F.col("there"), F.col("up")).alias("up"), F.col("score").alias("total"), F.lit(1).cast("bigint").alias("depth"))
    )
    leaves = level.join(
        level.filter("up is not null").select(F.col("up").alias("node")).distinct(), "node", "left_anti"
    ).select("node")
    # Only messages whose pointer has not passed the root go on; the others are final.
    active, final = level.filter("up is not null"), level.filter("up is null")
    levels, span, size = [], 1, nodes.count()
    while not cuts.empty(active) and span <= size:
        levels.append(active)
        on = final.unionByName(active).select(
            F.col("node").alias("via"), F.col("up").alias("far"), F.col("total").alias("more"), F.col("depth").alias("further")
        )
        moved = cuts.cut(
            active.join(on, F.col("up") == F.col("via")).select(
                "node",
                F.col("far").alias("up"),
                (F.col("total") + F.col("more")).alias("total"),
                (F.col("depth") + F.col("further")).alias("depth"),
            )
        )
        active, final = moved.filter("up is not null"), final.unionByName(moved.filter("up is null"))
        span *= 2
    ends = final.join(leaves, "node")
    order = Window.partitionBy("node.tree").orderBy(F.desc("total"), "node.msg")
    ranked = ends.withColumn("branch", F.row_number().over(order))
    if top is not None:
        ranked = ranked.filter(F.col("branch") <= top)
    ways = cuts.cut(
        ranked.select("branch", F.col("total").alias("branch_score"), "depth", "node", F.lit(0).cast("bigint").alias("back"))
    )
    for k in reversed(range(len(levels))):
        jump = levels[k].select(F.col("node").alias("via"), "up")
        # The tree of a way is the tree of its leaf, so the node alone is the key.
        onward = ways.join(jump, F.col("node") == F.col("via")).select(
            "branch", "branch_score", "depth", F.col("up").alias("node"), (F.col("back") + 2**k).alias("back")
        )
        ways = cuts.cut(ways.union(onward))
    return ways.join(nodes.select("node", "role", "text"), "node").select(
        F.col("node.tree").alias("tree_id"),
        "branch",
        F.col("branch_score").alias("score"),
        (F.col("depth") - 1 - F.col("back")).alias("place"),
        "role",
        "text",
    )


def escape(column: Column) -> Column:
    doubled = F.replace(column, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(column: Column) -> Column:
    opened = F.replace(column, F.lit("<\\|"), F.lit("<|"))
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def format_branches(paths: DataFrame) -> DataFrame:
    """tree_id, branch, score, formatted, loss_spans: each branch as one conversation.

    loss_spans lists (turn, start, length) for assistant turns: the turn's number from 0, and
    where its escaped text begins within the turn, from 1, in code points. A conversation is one
    value, so all its turns meet in the task that writes it.
    """
    turns = F.sort_array(F.collect_list(F.struct("place", F.col("role"), F.col("text"))))
    grouped = paths.groupBy("tree_id", "branch", "score").agg(turns.alias("turns"))
    written = F.transform(
        "turns",
        lambda t: F.concat(F.lit(START), escape(t["role"]), F.lit(SEP), escape(t["text"]), F.lit(END)),
    )
    spans = F.transform(
        "turns",
        lambda t, k: F.struct(
            k.alias("turn"),
            (F.length(escape(t["role"])) + len(START) + len(SEP) + 1).alias("start"),
            F.length(escape(t["text"])).alias("length"),
            (t["role"] == ASSISTANT).alias("loss"),
        ),
    )
    return grouped.select(
        "tree_id",
        "branch",
        "score",
        F.array_join(written, "").alias("formatted"),
        F.transform(
            F.filter(spans, lambda s: s["loss"]),
            lambda s: F.struct(s["turn"].alias("turn"), s["start"].alias("start"), s["length"].alias("length")),
        ).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The formatted conversations with turns (role, text) and loss_text parsed from them."""
    pieces = F.split("formatted", START.replace("|", "\\|"), -1)
    pieces = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    marked = formatted.withColumn("pieces", pieces)
    turns = F.transform(
        "pieces",
        lambda p: F.struct(
            unescape(F.substring_index(p, SEP, 1)).alias("role"),
            unescape(F.substring_index(F.substring_index(p, SEP, -1), END, 1)).alias("text"),
        ),
    )
    lost = F.transform(
        "loss_spans",
        lambda s: unescape(
            F.substring(F.get("pieces", s["turn"]), s["start"] - len(START), s["length"])
        ),
    )
    return marked.withColumn("turns", turns).withColumn("loss_text", F.array_join(lost, "")).drop("pieces")


def chains(rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Linear conversations as reply trees: each row answers the one before it by turn.

    Rows of the same turn are ordered by role and text; all rows stay, repeated ones too.
    """
    order = Window.partitionBy(conv_id).orderBy(turn, role, text)
    place = F.row_number().over(order).cast("bigint")
    return rows.select(
        F.col(conv_id).alias("tree_id"),
        place.alias("msg_id"),
        F.nullif(place - 1, F.lit(0)).alias("parent_id"),
        F.lit(0.0).alias("score"),
        F.col(role).alias("role"),
        F.col(text).alias("text"),
    )
