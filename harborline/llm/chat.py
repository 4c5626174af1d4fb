"""Chat formatting of reply trees, with DataFrame functions only.

A message names the message it answers. Repeated self-joins double the distance
of every message's known ancestor until all have met their root, then walk back
down the powers of two, so that each leaf gets all messages of its path in a
number of joins that is logarithmic in the longest path. Paths are ranked within
their tree by score, and each chosen path is formatted as one conversation.

Template: every turn is `<|role|>\\n`, the text, `<|end|>\\n`. In roles and texts
`&` becomes `&amp;` and `<` becomes `&lt;`, so that nothing in a text can be a
control string, and unescaping gives it back exactly (`>` in roles becomes `&gt;`). The loss mask covers the
escaped texts of the assistant's turns: spans of (start, length) in characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm.common import prepare_llm, stored

END = "<|end|>\n"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def paths(messages: DataFrame) -> DataFrame:
    """(tree_id, leaf, msg_id, depth) of every message on every path from a root to a leaf.

    messages: tree_id, msg_id (unique in its tree), parent_id (null: a root; a parent that isn't there
    makes a root too). depth: 0 at the leaf. A message on a circle of parents has no root and no path.
    """
    ids = messages.select("tree_id", "msg_id", "parent_id").where("tree_id is not null and msg_id is not null")
    known = ids.select("tree_id", F.col("msg_id").alias("parent_id"))
    linked = ids.where("parent_id is not null").join(known, ["tree_id", "parent_id"], "left_semi")
    levels = [stored(linked.select("tree_id", "msg_id", F.col("parent_id").alias("up")), "jumps")]
    size = ids.count()
    while not levels[-1].isEmpty() and 1 << (len(levels) - 1) < size:
        last = levels[-1]
        levels.append(stored(last.join(last.select("tree_id", F.col("msg_id").alias("up"), F.col("up").alias("far")), ["tree_id", "up"]).select("tree_id", "msg_id", F.col("far").alias("up")), "jumps"))
    leaves = ids.select("tree_id", F.col("msg_id").alias("leaf")).join(linked.select("tree_id", F.col("parent_id").alias("leaf")), ["tree_id", "leaf"], "left_anti")
    found = leaves.select("tree_id", "leaf", F.col("leaf").alias("msg_id"), F.lit(0).cast("long").alias("depth"))
    for power in reversed(range(len(levels))):
        up = levels[power]
        found = stored(found, "paths")
        found = found.union(found.join(up, ["tree_id", "msg_id"]).select("tree_id", "leaf", F.col("up").alias("msg_id"), (F.col("depth") + (1 << power)).alias("depth")))
    return found


def format_trees(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """One row for each chosen path: tree_id, leaf, branch (1 is best), score, n_turns, formatted, loss.

    messages: tree_id, msg_id, parent_id, role, text, score (null counts as 0). A branch's score is the
    mean of its messages' scores; ties go to the smaller leaf. branches: how many of a tree are kept
    (null: all). Null roles and texts are empty; rows without tree_id or msg_id are left out.
    """
    prepare_llm(messages.sparkSession)
    lines = paths(messages).join(messages.select("tree_id", "msg_id", "role", "text", "score"), ["tree_id", "msg_id"])
    role, text = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit(">"), F.lit("&gt;")), escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit("<|"), role, F.lit("|>\n"))
    turn = F.struct(
        (-F.col("depth")).alias("at"), F.concat(head, text, F.lit(END)).alias("line"), F.length(head).alias("skip"), F.length(text).alias("size"),
        (F.coalesce("role", F.lit("")) == LOSS_ROLE).alias("learned"),
    )
    whole = lines.groupBy("tree_id", "leaf").agg(F.avg(F.coalesce("score", F.lit(0.0))).alias("score"), F.count("*").alias("n_turns"), F.sort_array(F.collect_list(turn)).alias("turns"))
    if branches is not None:
        best = Window.partitionBy("tree_id").orderBy(F.desc("score"), "leaf")
        ranked = whole.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= branches)
    else:
        ranked = whole.withColumn("branch", F.lit(None).cast("int"))
    # the spans' starts are the running sum of the lines' lengths
    spans = F.aggregate(
        "turns", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda a, t: F.struct(
            (a["at"] + F.length(t["line"])).alias("at"),
            F.when(t["learned"], F.concat(a["spans"], F.array(F.struct((a["at"] + t["skip"]).alias("start"), t["size"].cast("long").alias("length"))))).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return ranked.select("tree_id", "leaf", "branch", "score", "n_turns", F.array_join(F.transform("turns", lambda t: t["line"]), "").alias("formatted"), spans.alias("loss"))


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text), unescaped."""
    lines = F.filter(F.split(formatted, "<\\|end\\|>\\n"), lambda x: x.startswith("<|"))
    return F.transform(lines, lambda x: F.struct(unescape(F.replace(F.substring_index(x, "|>\n", 1).substr(F.lit(3), F.lit(1 << 30)), F.lit("&gt;"), F.lit(">"))).alias("role"), unescape(x.substr(F.instr(x, "|>\n") + 3, F.lit(1 << 30))).alias("text")))


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between the spans."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def conversation_messages(rows: DataFrame) -> DataFrame:
    """Messages of linear conversations (conv_id, turn, role, text): each answers the one before it.

    Rows are taken by turn, null first; rows of one turn by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = rows.where("conv_id is not null").withColumn("msg_id", F.row_number().over(order).cast("long"))
    return placed.select(F.col("conv_id").cast("long").alias("tree_id"), "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"), "role", "text", F.lit(None).cast("double").alias("score"))
