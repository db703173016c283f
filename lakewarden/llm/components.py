"""Connected components of a graph given by its edges, by alternating star steps on DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.base import Workspace, map_batches, settled

EDGE = "u bigint, v bigint"


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one batch replaced by an edge from each node to the smallest node it reaches there."""
    for batch in batches:
        u, v = (batch.column(i).to_numpy() for i in (0, 1))
        nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
        a, b = place[: len(u)], place[len(u) :]
        low = np.arange(len(nodes))
        while True:
            before = low.copy()
            np.minimum.at(low, a, low[b])
            np.minimum.at(low, b, low[a])
            low = low[low]
            if (low == before).all():
                break
        own = low != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[low[own]])], names=["u", "v"])


def components(edges: DataFrame, work: Workspace | None = None) -> DataFrame:
    """Rows (node, root) for every node with an edge; root is the smallest node of its component.

    Each round attaches a node's larger neighbours, then all its neighbours, to its smallest one; the number of rounds
    grows with the logarithm of the longest chain. A node with very many neighbours is pre-aggregated to one row per
    task before its minimum is taken, and the join that hands the minimum back is one that Spark can split. Loops,
    repeated edges and nulls are allowed; an empty table has no components. In a workspace, tables of past rounds go.
    """
    keep = work.settled if work else settled
    u, v = edges.columns[:2]
    pairs = edges.select(F.col(u).cast("bigint").alias("u"), F.col(v).cast("bigint").alias("v")).filter("u <> v")
    now = keep(map_batches(pairs, forest, EDGE).distinct())
    while True:
        before = now
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        now = keep(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        if work:
            work.drop(before)
        # Done when every node hangs on a root: no node is both the lower and the upper end of an edge.
        if now.join(now.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty():
            break
    roots = now.select(F.col("v").alias("u"), "v").distinct()
    return now.unionByName(roots).toDF("node", "root")
