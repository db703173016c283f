"""Reply trees as training conversations, in DataFrame functions alone.

A message names the message it replies to, so the messages of a tree form branches. Self-joins that double their stride
enumerate every path from a leaf up to its root, in a number of rounds that grows with the logarithm of the depth.
Branches are ranked by score, and each chosen path becomes one conversation with its loss mask.

Each turn is ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line feed. Inside roles and texts ``\\`` becomes ``\\\\``
and ``<|`` becomes ``<\\|``, so no text can hold a mark, and undoing it gives the text back.

Null roles and texts are empty. Rows with a null tree id form one tree. A message whose parent is null or missing is a
root; messages on a cycle have no leaf and no path. Message ids must be unique within a tree: ``turns_as_trees`` makes
them so for plain lists of turns, where repeated rows and ties are turns one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.base import settled

BEGIN, BETWEEN, FINISH = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def turns_as_trees(turns: DataFrame, tree: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (tree, node, parent, role, text, score): each turn replies to the one before it."""
    place = F.row_number().over(Window.partitionBy(tree).orderBy(order, role, text)).cast("bigint")
    rows = turns.select(F.col(tree).alias("tree"), place.alias("node"), F.col(role).alias("role"), F.col(text).alias("text"))
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def branches(nodes: DataFrame) -> DataFrame:
    """Rows (key, leaf, node, up): for each leaf all messages on its path, ``up`` steps above it."""
    links = nodes.select("key", "node", "parent")
    known = links.select("key", F.col("node").alias("parent"))
    jump = settled(links.join(known, ["key", "parent"]).select("key", F.col("node").alias("from"), F.col("parent").alias("to")))
    inner = jump.select("key", F.col("to").alias("node")).distinct()
    paths = links.join(inner, ["key", "node"], "left_anti").select("key", F.col("node").alias("leaf"), "node", F.lit(0).alias("up"))
    paths, step = settled(paths), 1
    while not jump.isEmpty():
        # A path's first messages are known; those ``step`` further up follow in one join.
        further = paths.join(jump, (paths["key"] == jump["key"]) & (paths["node"] == jump["from"])).select(
            paths["key"], "leaf", F.col("to").alias("node"), (F.col("up") + step).alias("up")
        )
        if step > 1 and further.isEmpty():
            break
        paths = settled(paths.unionByName(further))
        ahead = jump.select("key", F.col("from").alias("to"), F.col("to").alias("next"))
        jump = settled(jump.join(ahead, ["key", "to"]).select("key", "from", F.col("next").alias("to")))
        step *= 2
    return paths


def format_trees(nodes: DataFrame, best: int | None = None, trained: str = "assistant") -> DataFrame:
    """One row per chosen path: tree, leaf, rank, score, n_turns, formatted, loss (spans of characters, from 1).

    ``nodes`` has (tree, node, parent, role, text, score). A path's score is the sum of its messages' scores; paths of a
    tree are ranked by it, higher first, then by leaf. ``best`` keeps that many of each tree; None keeps all.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit(""))
    kept = settled(nodes.withColumn("key", key))
    paths = branches(kept)
    turns = paths.join(kept.drop("parent"), ["key", "node"])
    turn = F.concat(
        F.lit(BEGIN), escaped(F.coalesce("role", F.lit(""))), F.lit(BETWEEN), escaped(F.coalesce("text", F.lit(""))), F.lit(FINISH)
    )
    written = turns.withColumn("turn", turn).withColumn("head", F.length(F.concat(F.lit(BEGIN + BETWEEN), escaped(F.coalesce("role", F.lit(""))))))
    before = Window.partitionBy("key", "leaf").orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, -1)
    placed = written.withColumn("start", F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0)))
    span = F.when(
        F.col("role") == trained,
        F.struct(
            (F.col("start") + F.col("head") + 1).alias("start"),
            (F.length("turn") - F.col("head") - len(FINISH)).cast("bigint").alias("length"),
        ),
    )
    whole = placed.groupBy("key", "leaf").agg(
        F.any_value("tree").alias("tree"),
        F.sum("score").alias("score"),
        F.count(F.lit(1)).alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("start", "turn"))).alias("parts"),
        F.array_sort(F.collect_list(span)).alias("loss"),
    )
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "leaf"))
    ranked = whole.withColumn("rank", rank)
    if best is not None:
        ranked = ranked.filter(F.col("rank") <= best)
    return ranked.select("tree", "leaf", "rank", "score", "n_turns", F.array_join("parts.turn", "").alias("formatted"), "loss")


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and trained text read from the output: adds ``turns`` (role, text) and ``loss_text``."""
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    each = F.transform(
        F.slice(pieces, 1, F.size(pieces) - 1),
        lambda p: F.struct(
            unescaped(F.substring_index(F.substr(p, F.lit(len(BEGIN) + 1)), BETWEEN, 1)).alias("role"),
            unescaped(F.substr(p, F.length(F.substring_index(p, BETWEEN, 1)) + len(BETWEEN) + 1)).alias("text"),
        ),
    )
    under = F.transform("loss", lambda s: unescaped(F.substr("formatted", s["start"].cast("int"), s["length"].cast("int"))))
    return formatted.withColumns({"turns": each, "loss_text": F.array_join(under, "")})
