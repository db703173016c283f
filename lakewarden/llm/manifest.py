"""A Merkle tree over a dataset: one digest per row, one per group of rows, one for all.

Rows become leaves. Leaves of a group, in order of their key, are folded ``ARITY`` at a time until one node, the group's
subroot, is left; the subroots, in order of the group (null first, then by UTF-8 bytes), are folded likewise into the root.

The trees are cut into superblocks, complete subtrees of ``ARITY ** height`` consecutive nodes. A first pass folds every
superblock to its top node, and again those tops, until each group has one node: few rounds, whatever the size, and no
task sees more than one superblock. A proof needs the nodes beside a leaf's way to the root. Those outside a superblock
are the same for all its leaves, so the leaves and their outer nodes meet in a cogroup by superblock, where the local
folding, the joining of proofs and the refolding of each row's proof happen together.

Leaves are placed by a distributed sort: rows are range-partitioned by (group, key), and counts of the stretches give each
row its place, so that a group may span any number of tasks.

Null values are encoded as ``-``; a null group is a group of its own, before all others. Null keys come first. Rows with
the same key are placed in order of their digests; equal rows are leaves of their own, which follow each other. Empty and
very long texts are values like others (a row is hashed where it is read, only digests travel). Columns beyond the fields
are ignored. An empty table has no leaves and gives no rows.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.base import settled, ship_package

ARITY = 3
#: Levels of a superblock: 729 leaves.
HEIGHT = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

STEP = "array<struct<left: string, right: string>>"


def digest(*inputs: str) -> str:
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf_digest(values: list[Column]) -> Column:
    """Digest of the values in order, each as its length in bytes, a colon and itself, or ``-`` where it is null."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def group_name(column: Column) -> Column:
    """A group's name that is never null and sorts null first."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0, in order within the group) and ``n`` (rows of the group)."""
    # Rows with equal order values may be very many: a number of the row lets them, too, span several tasks.
    sort = [group, *order, "__row"]
    ranged = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*sort).sortWithinPartitions(*sort)
    ranged = settled(ranged.withColumn("__at", F.monotonically_increasing_id()).withColumn("__stretch", F.spark_partition_id()))
    counts = ranged.groupBy(group, "__stretch").agg(F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__first"))
    # One row per group and stretch.
    whole = Window.partitionBy(group)
    before = whole.orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        group,
        "__stretch",
        (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(whole).alias("n"),
    )
    joined = ranged.join(starts, [group, "__stretch"])
    return joined.select(*rows.columns, (F.col("__at") + F.col("__shift")).alias("pos"), "n")


def folded_levels(nodes: list[str], n: int, arity: int, height: int) -> list[list[str]]:
    """The nodes of a superblock level by level up to its top; ``n`` is the number of the whole group's nodes."""
    levels = [nodes]
    while n > 1 and len(levels) <= height:
        low = levels[-1]
        levels.append([digest(*low[i : i + arity]) for i in range(0, len(low), arity)])
        n = -(-n // arity)
    return levels


def way_up(levels: list[list[str]], place: int, arity: int) -> list[tuple[str, str]]:
    """What stands left and right of a node's way to the top, level by level."""
    steps = []
    for level in levels[:-1]:
        start = place - place % arity
        steps.append(("".join(level[start:place]), "".join(level[place + 1 : start + arity])))
        place //= arity
    return steps


def refolded(node: str, steps: list[tuple[str, str]]) -> str:
    for left, right in steps:
        node = digest(left, node, right)
    return node


def by_block(nodes: DataFrame, arity: int, height: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {arity**height}"))


def block_tops(nodes: DataFrame, arity: int, height: int) -> DataFrame:
    """The top node of every superblock: (grp, pos, n, node), numbered like the superblocks."""
    schema = "grp string, pos bigint, n bigint, node string"

    def run(block: pd.DataFrame) -> pd.DataFrame:
        first = block.iloc[0]
        levels = folded_levels(block.sort_values("pos")["node"].tolist(), int(first.n), arity, height)
        return pd.DataFrame({"grp": [first.grp], "pos": [first.block], "n": [-(-int(first.n) // arity**height)], "node": [levels[-1][0]]})

    columns = by_block(nodes.select("grp", "pos", "n", "node"), arity, height)
    return columns.groupBy("grp", "block").applyInPandas(run, schema)


def with_ways(nodes: DataFrame, outer: DataFrame, arity: int, height: int) -> DataFrame:
    """Each node's way to the root: its own superblock's nodes, then the outer nodes of that superblock.

    ``outer`` has one row per superblock: grp, block, subroot, root and the way from its top upwards.
    """

    def run(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        over = above.iloc[0]
        outer_steps = [(s["left"], s["right"]) for s in over["way"]]
        levels = folded_levels(block["node"].tolist(), int(block["n"].iloc[0]), arity, height)
        ways = [way_up(levels, place, arity) + outer_steps for place in range(len(block))]
        return pd.DataFrame(
            {
                "grp": block["grp"],
                "block": block["pos"],
                "subroot": over["subroot"],
                "root": over["root"],
                "way": pd.Series([[{"left": a, "right": b} for a, b in way] for way in ways], index=block.index, dtype=object),
            }
        )

    left = by_block(nodes, arity, height).groupBy("grp", "block")
    schema = f"grp string, block bigint, subroot string, root string, way {STEP}"
    return left.cogroup(outer.groupBy("grp", "block")).applyInPandas(run, schema)


def proven_leaves(leaves: DataFrame, outer: DataFrame, arity: int, height: int) -> DataFrame:
    """Per leaf: its key and digests, the digest of its proof, and the root as folded again from ``present``."""
    schema = "key string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"

    def run(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        over = above.iloc[0]
        outer_steps = [(s["left"], s["right"]) for s in over["way"]]
        nodes, present = block["node"].tolist(), block["present"].tolist()
        levels = folded_levels(nodes, int(block["n"].iloc[0]), arity, height)
        proofs, folded = [], []
        for place, node in enumerate(present):
            steps = way_up(levels, place, arity) + outer_steps
            proofs.append(digest(*(side for step in steps for side in step)))
            folded.append(refolded(node, steps))
        return pd.DataFrame(
            {"key": block["key"], "leaf": nodes, "subroot": over["subroot"], "root": over["root"], "proof_sha256": proofs, "folded_root": folded}
        )

    left = by_block(leaves, arity, height).groupBy("grp", "block")
    return left.cogroup(outer.groupBy("grp", "block")).applyInPandas(run, schema)


def rounds_of(nodes: DataFrame, arity: int, height: int) -> list[DataFrame]:
    """The nodes, the tops of their superblocks, the tops of those, and so on, until every group has one."""
    rounds = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        rounds.append(settled(block_tops(rounds[-1], arity, height)))
        most = -(-most // arity**height)
    return rounds


def manifest(
    rows: DataFrame,
    fields: list[str],
    key: str,
    group: str,
    present: dict[str, Column] | None = None,
    arity: int = ARITY,
    height: int = HEIGHT,
) -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``fields`` are hashed in that order. ``present`` gives the values that some fields have now; from these and the proof
    the root is folded again, and a row is verified if that equals the root. ``proof_sha256`` is the digest of the nodes
    beside the row's way to the root, level by level, left to right.
    """
    ship_package(rows.sparkSession)
    now = present or {}
    node = leaf_digest([F.col(f) for f in fields])
    seen = leaf_digest([now.get(f, F.col(f)) for f in fields])
    leaves = settled(rows.select(F.col(key).alias("key"), group_name(F.col(group)).alias("grp"), node.alias("node"), seen.alias("present")))
    # The key goes through Python as text, as pandas has no whole numbers beside nulls.
    leaves = settled(placed(leaves, "grp", ["key", "node"]).withColumn("key", F.col("key").cast("string")))
    rounds = rounds_of(leaves, arity, height)
    subroots = rounds[-1].select(F.col("grp").alias("name"), F.lit("").alias("grp"), "node")
    tops = settled(placed(subroots, "grp", ["name"]))
    top_rounds = rounds_of(tops.select("grp", "pos", "n", "node"), arity, height)
    root = top_rounds[-1].select("node").first()
    # From the root downwards: the way of each top is the outer way of what lies under it.
    outer = top_rounds[-1].select(
        "grp",
        F.col("pos").alias("block"),
        F.col("node").alias("subroot"),
        F.lit(root[0] if root else None).cast("string").alias("root"),
        F.array().cast(STEP).alias("way"),
    )
    for nodes in reversed(top_rounds[:-1]):
        outer = settled(with_ways(nodes, outer, arity, height))
    own = tops.join(outer.select(F.col("block").alias("pos"), "root", "way"), "pos")
    outer = own.select(F.col("name").alias("grp"), F.lit(0).cast("bigint").alias("block"), F.col("node").alias("subroot"), "root", "way")
    for nodes in reversed(rounds[1:-1]):
        outer = settled(with_ways(nodes, outer, arity, height))
    proven = proven_leaves(leaves, outer, arity, height)
    return proven.select(
        F.col("key").cast(rows.schema[key].dataType).alias(key),
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
