"""Chat formatting over reply trees, DataFrame functions only.

Messages form trees: each has a parent or is a root. Iterative self-joins double
the reach of every message's pointer (to its 1st, 2nd, 4th, ... ancestor) and add
up scores and depths along it, so trees of any depth take a logarithmic number
of joins. A conversation's leaves are ranked by the score of their root-to-leaf
path, the best ``branches`` are chosen, and the same pointers list the chosen
paths' messages. Each path is formatted as one conversation.

The template: ``### role: text</turn>`` and a newline per turn. In texts and roles
``\\`` becomes ``\\\\``, ``###`` becomes ``\\h`` and ``</turn>`` becomes ``\\t``; in roles
``:`` also becomes ``\\c``. A formatted text thus holds control strings only where
the template put them, and ``parse`` restores every turn exactly. The loss mask
lists the code point ranges of the escaped assistant texts.

Defined results: null texts and roles are empty; null conversation ids are one
conversation; a parent that does not exist makes a root; messages on a cycle of
parents or hanging from one are on no path; repeated rows are messages of their
own if their ids differ; ties of scores go to the smaller leaf; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

# --- fixed values of the template ---
OPEN = "### "
AFTER_ROLE = ": "
CLOSE = "</turn>\n"
ESCAPES = [("###", "\\h"), ("</turn>", "\\t")]
ROLE_ESCAPES = [*ESCAPES, (":", "\\c")]
LOSS_ROLE = "assistant"
# --- end of fixed values ---

#: stands for a null conversation id in joins
_NULL_CONV = "null"


def escape(text: Column, pairs: list[tuple[str, str]] = ESCAPES) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, coded in pairs:
        out = F.replace(out, F.lit(plain), F.lit(coded))
    return out


def unescape(text: Column, pairs: list[tuple[str, str]] = ESCAPES) -> Column:
    def plain(part: Column) -> Column:
        for raw, coded in pairs:
            part = F.replace(part, F.lit(coded), F.lit(raw))
        return part

    # escaped backslashes first: what is between them holds only other escapes
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def turn_tree(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """Linear conversations as trees: every row replies to the row before it, in
    order of turn, then role and text (null turns first)."""
    rows = conversations.select(F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"),
                                F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return rows.withColumn("node", at.cast("bigint")).select(
        "conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(1.0).alias("score"))


def _pointers(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Staged pointer tables, the k-th to the ``2**k``-th ancestor; the last table
    has each node's path score and depth, and ``up`` null if it reaches a root."""
    ids = nodes.select("conv", "node")
    parents = nodes.join(ids.withColumnRenamed("node", "parent"), ["conv", "parent"], "left_semi").select("conv", "node", F.col("parent").alias("up"))
    now = stage(nodes.select("conv", "node", "score").join(parents, ["conv", "node"], "left")
                .select("conv", "node", "up", "score", F.lit(1).cast("bigint").alias("depth")), "chat-pointers")
    most = nodes.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    tables, reach = [now], 1
    while reach < most and not now.where("up is not null").isEmpty():
        # pointers that have passed a root rest; only the others join on
        above = now.select("conv", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("score").alias("score2"), F.col("depth").alias("depth2"))
        moved = now.where("up is not null").join(above, ["conv", "up"]).select(
            "conv", "node", F.col("up2").alias("up"), (F.col("score") + F.col("score2")).alias("score"),
            (F.col("depth") + F.col("depth2")).alias("depth"))
        now = stage(now.where("up is null").unionByName(moved), "chat-pointers")
        tables.append(now)
        reach *= 2
    return tables, now


def best_paths(tree: DataFrame, branches: int = 1) -> DataFrame:
    """``conv, leaf, branch, path_score, node, depth`` of the chosen paths'
    messages. ``tree``: staged ``conv, node, parent, score``."""
    tables, totals = _pointers(tree)
    leaves = totals.join(tree.select("conv", F.col("parent").alias("node")), ["conv", "node"], "left_anti")
    order = Window.partitionBy("conv").orderBy(F.desc("score"), "node")
    chosen = (leaves.where("up is null").withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= branches)
              .select("conv", F.col("node").alias("leaf"), "branch", F.col("score").alias("path_score"), "node"))
    path = stage(chosen, "chat-paths")
    for k, table in enumerate(tables):
        up = table.where("up is not null").select("conv", "node", "up")
        more = path.join(up, ["conv", "node"]).select("conv", "leaf", "branch", "path_score", F.col("up").alias("node"))
        path = path.unionByName(more)
        if k % 4 == 3:
            path = stage(path, "chat-paths")
    return path.join(totals.select("conv", "node", "depth"), ["conv", "node"])


def format_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One row per chosen path: ``conv_id, branch, path_score, n_turns, formatted``
    and ``loss``, the code point ranges of assistant texts. ``messages``:
    ``conv_id, node, parent, role, text, score``."""
    keyed = messages.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(_NULL_CONV)).alias("conv"), "node", "parent",
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = stage(keyed, "chat-messages")
    path = best_paths(keyed.select("conv", "node", "parent", "score"), branches)
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit(AFTER_ROLE))
    turns = path.join(keyed.select("conv", "node", "role", "text"), ["conv", "node"]).select(
        "conv", "leaf", "branch", "path_score", "depth", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    ends = F.sum(F.char_length("head") + F.char_length("body") + len(CLOSE)).over(
        Window.partitionBy("conv", "leaf").orderBy("depth"))
    turns = turns.withColumn("end", (ends - len(CLOSE)).cast("bigint"))
    turn = F.struct("depth", F.concat("head", "body", F.lit(CLOSE)).alias("turn"))
    mask = F.when(F.col("role") == LOSS_ROLE, F.struct((F.col("end") - F.char_length("body")).alias("start"), "end"))
    done = turns.groupBy("conv", "leaf").agg(
        F.first("branch").alias("branch"), F.first("path_score").alias("path_score"), F.count(F.lit(1)).alias("n_turns"),
        F.array_sort(F.collect_list(turn)).alias("turns"), F.array_sort(F.collect_list(mask)).alias("loss"))
    return done.select(F.when(F.col("conv") != _NULL_CONV, F.col("conv")).cast("bigint").alias("conv_id"), "branch", "path_score",
                       "n_turns", F.array_join("turns.turn", "").alias("formatted"), "loss")


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of ``role, text``."""
    def turn(part: Column) -> Column:
        rest = F.substr(part, F.lit(len(OPEN) + 1))
        role = F.substring_index(rest, AFTER_ROLE, 1)
        text = F.substr(rest, F.char_length(role) + len(AFTER_ROLE) + 1)
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(text).alias("text"))

    parts = F.split(formatted, CLOSE, -1)
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def loss_texts(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(loss, lambda x: unescape(F.substr(formatted, (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))))
