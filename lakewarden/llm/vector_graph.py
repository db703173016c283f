"""Approximate nearest neighbours by cosine: a robust-pruned directed graph per shard, searched by beams.

Equal vectors are one node. Nodes are dealt to shards of about ``SHARD`` by the hash of the vector. In a shard every node
starts with random neighbours. Then, twice over all nodes in random order, a greedy beam search for the node proposes
neighbours, and pruning keeps diverse ones: the nearest candidate is taken, all candidates that are clearly nearer to it
than to the node go, and so on. The second time the test is relaxed by ``ALPHA``, which keeps some long edges. Edges are
also entered the other way round, and a list that grows too long is pruned again. The search starts at the shard's centre and
at one node of each part that cannot be reached from there, so every node can be found.

A query runs as a beam search over each shard; the shards' best are merged. Queries are cut into blocks, and a task holds
one shard and one block, so neither many queries nor many vectors meet in one task.

Cosines are taken in double precision from the given components. Vectors that are null, empty, zero or hold a null or
non-finite component take no part, neither as queries nor as candidates; nor do rows with a null id. Vectors are compared
with others of their length only. Of equal vectors the least ids come first, as for all ties. A row with the query's id
is never its candidate; an id there several times counts once, with its best score. Empty tables give no rows. Columns
beyond those named are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.base import settled, ship_package

#: Nodes of a shard and queries of a block.
SHARD, BLOCK = 2_000, 2_000
#: Edges from a node; width of the beam while building and while searching; how much longer a detour may be.
DEGREE, BUILD_BEAM, BEAM, ALPHA = 32, 64, 128, 1.2
#: Tasks at most in one step; shards and blocks are far smaller than partitions by bytes, and costly to work on.
TASKS = 10_000
#: Nodes expanded at once by each search, and searches run side by side.
STRIDE, SIDE = 4, 200


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Rows (vec_id, dims, x) that can be compared, x in double precision, each once."""
    x = F.transform(F.col(embedding).cast("array<double>"), lambda v: v + F.lit(0.0))  # -0.0 becomes 0.0
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))) & ~F.isnan(v))
    good = rows.filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite & F.exists("x", lambda v: v != 0))
    return good.dropDuplicates(["vec_id", "x"]).select("vec_id", F.size("x").alias("dims"), "x")


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of doubles, scaled by powers of two so that no square overflows; cosines stay the same."""
    x = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0.0))[1][:, None])


def units(x: np.ndarray) -> np.ndarray:
    return (x / np.sqrt((x * x).sum(1, keepdims=True))).astype(np.float32)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines along the last axis, exactly 1 for equal vectors."""
    return (x * y).sum(-1) / np.sqrt((x * x).sum(-1) * (y * y).sum(-1))


def beam_search(x: np.ndarray, edges: np.ndarray, starts: np.ndarray, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ``width`` best nodes found, nearest first (-1 where there are fewer), and squared distances."""
    rows = np.arange(len(queries))[:, None]
    ids = np.broadcast_to(starts, (len(queries), len(starts)))
    far = 2 - 2 * queries @ x[starts].T
    # One column more than nodes, for the places that hold none (-1).
    seen = np.zeros((len(queries), len(x) + 1), bool)
    seen[:, starts] = True
    turn = np.zeros(seen.shape, np.int32)
    done = np.zeros(ids.shape, bool)
    while True:
        order = far.argsort(1, kind="stable")[:, :width]
        ids, far, done = ids[rows, order], far[rows, order], done[rows, order]
        if ids.shape[1] < width:
            fill = ((0, 0), (0, width - ids.shape[1]))
            ids, far, done = np.pad(ids, fill, constant_values=-1), np.pad(far, fill, constant_values=np.inf), np.pad(done, fill, constant_values=True)
        if done.all():
            return ids, far
        best = np.where(done, np.inf, far).argpartition(min(STRIDE, width) - 1, axis=1)[:, :STRIDE]
        waiting = ~done[rows, best]
        done[rows, best] = True
        found = np.where(waiting[:, :, None], edges[ids[rows, best]], -1).reshape(len(queries), -1)
        # The same node found twice counts at the place written last.
        place = np.arange(found.shape[1], dtype=np.int32)
        turn[rows, found] = place
        fresh = (found >= 0) & ~seen[rows, found] & (turn[rows, found] == place)
        seen[rows, found] |= fresh
        apart = np.where(fresh, 2 - 2 * np.matmul(x[found], queries[:, :, None])[:, :, 0], np.inf)
        ids, far, done = np.hstack([ids, found]), np.hstack([far, apart]), np.hstack([done, ~fresh])


def pruned(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node at most ``degree`` diverse ones of its candidates (-1: none), nearest first."""
    candidates = np.sort(candidates, axis=1)
    fine = (candidates >= 0) & (candidates != nodes[:, None])
    fine[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    there = x[candidates]
    far = 2 - 2 * np.matmul(there, x[nodes][:, :, None])[:, :, 0]
    between = 2 - 2 * np.matmul(there, there.transpose(0, 2, 1))
    out = np.full((len(nodes), degree), -1, np.int32)
    rows = np.arange(len(nodes))
    for i in range(degree):
        if not fine.any():
            break
        best = np.where(fine, far, np.inf).argmin(1)
        out[:, i] = np.where(fine[rows, best], candidates[rows, best], -1)
        fine &= alpha * alpha * between[rows, best] > far
        fine[rows, best] = False
    return out


def entered_back(x: np.ndarray, edges: np.ndarray, nodes: np.ndarray, alpha: float) -> None:
    """Enter the edges of ``nodes`` the other way round as well, pruning lists that would grow too long."""
    degree = edges.shape[1]
    ends = edges[nodes]
    sources = np.repeat(nodes, degree)[ends.ravel() >= 0].astype(np.int32)
    ends = ends.ravel()[ends.ravel() >= 0]
    order = ends.argsort(kind="stable")
    targets, first, counts = np.unique(ends[order], return_index=True, return_counts=True)
    sources = sources[order]
    by_count = counts.argsort(kind="stable")
    start = 0
    while start < len(targets):
        # Lists of like length go together; long ones in smaller groups, for memory.
        some = by_count[start : start + SIDE]
        some = some[: max(1, SIDE * 64 // (int(counts[some[-1]]) + degree))]
        start += len(some)
        place = np.arange(counts[some].max())
        inside = place < counts[some][:, None]
        new = np.where(inside, sources[np.minimum(first[some][:, None] + place, len(sources) - 1)], -1)
        edges[targets[some]] = pruned(x, targets[some], np.hstack([edges[targets[some]], new]), degree, alpha)


def parts_start(edges: np.ndarray, centre: int) -> np.ndarray:
    """The centre, and one node of each part that can't be reached from the nodes before."""
    starts, reached, front = [centre], np.zeros(len(edges), bool), np.array([centre])
    while True:
        reached[front] = True
        while len(front):
            front = np.unique(edges[front])
            front = front[front >= 0]
            front = front[~reached[front]]
            reached[front] = True
        if reached.all():
            return np.array(starts)
        front = np.flatnonzero(~reached)[:1]
        starts.append(int(front[0]))


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """Edges (-1: none) and starting nodes of a graph over unit vectors."""
    rng = np.random.default_rng(len(x))
    degree = max(1, min(degree, len(x) - 1))
    edges = np.full((len(x), degree), -1, np.int32)
    centre = int((x @ x.mean(0)).argmax())
    if len(x) > 1:
        steps = np.stack([rng.choice(len(x) - 1, degree, replace=False) + 1 for _ in range(len(x))])
        edges[:] = (np.arange(len(x))[:, None] + steps) % len(x)
        for slack in (1.0, alpha):
            order = rng.permutation(len(x))
            for at in range(0, len(x), SIDE):
                nodes = order[at : at + SIDE]
                near, _ = beam_search(x, edges, np.array([centre]), x[nodes], min(beam, len(x)))
                edges[nodes] = pruned(x, nodes, np.hstack([near, edges[nodes]]), degree, slack)
                entered_back(x, edges, nodes, slack)
    return edges, parts_start(edges, centre)


def build_index(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: int = 6, shard: int = SHARD) -> DataFrame:
    """One row per node: dims, shard, node, ids (its ``least`` smallest), x, out (the nodes its edges lead to), start."""
    ship_package(vectors.sparkSession)
    rows = usable(vectors, vec_id, embedding)
    # Spark keeps the first ids of a vector in each task before the shuffle; larger ids can't be among the nearest.
    order = Window.partitionBy("dims", "x").orderBy("vec_id")
    few = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= least)
    nodes = settled(few.groupBy("dims", "x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    sizes = nodes.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / shard).alias("shards"))
    dealt = nodes.join(sizes, "dims").select("dims", F.pmod(F.xxhash64("x"), "shards").cast("int").alias("shard"), "ids", "x")
    tasks = min(TASKS, sizes.agg(F.sum("shards")).first()[0] or 1)

    def build(group: pa.Table) -> pa.Table:
        # In order of ids, so that the graph doesn't depend on how rows arrive.
        group = group.take(pa.array(np.argsort([ids[0] for ids in group["ids"].to_pylist()], kind="stable")))
        edges, starts = build_graph(units(matrix(group["x"], group["dims"][0].as_py())))
        start = np.zeros(len(edges), bool)
        start[starts] = True
        out = pa.ListArray.from_arrays(pa.array(np.arange(len(edges) + 1) * edges.shape[1], pa.int32()), pa.array(edges.ravel(), pa.int32()))
        columns = [group["dims"], group["shard"], pa.array(np.arange(len(edges)), pa.int32()), group["ids"], group["x"], out, pa.array(start)]
        return pa.table(columns, names=["dims", "shard", "node", "ids", "x", "out", "start"])

    schema = "dims int, shard int, node int, ids array<bigint>, x array<double>, out array<int>, start boolean"
    return settled(dealt.repartition(tasks, "dims", "shard").groupBy("dims", "shard").applyInArrow(build, schema))


def search(index: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", embedding: str = "embedding", beam: int = BEAM, block: int = BLOCK) -> DataFrame:
    """Each query's ``k`` nearest found: query_id, rank (from 1), vec_id and score, the cosine. The index must keep ``k + 1`` ids."""
    ship_package(index.sparkSession)
    asked = settled(usable(queries, vec_id, embedding).withColumnRenamed("vec_id", "query_id"))
    shards = index.groupBy("dims").agg((F.max("shard") + 1).alias("shards"))
    blocks = asked.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    counts = shards.join(blocks, "dims")
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    left = index.join(counts.select("dims", "blocks"), "dims").select("dims", "shard", each, "node", "ids", "x", "out", "start")
    own = F.pmod(F.xxhash64("query_id", "x"), "blocks").cast("int").alias("block")
    every = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")
    right = asked.join(counts, "dims").select("dims", own, every, "query_id", "x")
    schema = "query_id bigint, vec_id bigint, score double"

    def run(nodes: pa.Table, some: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if nodes.num_rows and some.num_rows:
            nodes = nodes.sort_by("node")
            dims = nodes["dims"][0].as_py()
            x, ids = matrix(nodes["x"], dims), nodes["ids"].to_pylist()
            edges = nodes["out"].combine_chunks().flatten().to_numpy().reshape(len(x), -1)
            starts = np.flatnonzero(nodes["start"].to_numpy(zero_copy_only=False))
            unit = units(x)
            asked_ids, asked_x = some["query_id"].to_pylist(), matrix(some["x"], dims)
            for at in range(0, len(asked_x), SIDE):
                part = asked_x[at : at + SIDE]
                near, _ = beam_search(unit, edges, starts, units(part), min(beam, len(x)))
                scores = np.where(near >= 0, cosines(x[near], part[:, None, :]), -np.inf)
                for row, (query, order) in enumerate(zip(asked_ids[at : at + SIDE], np.argsort(-scores, axis=1, kind="stable"), strict=True)):
                    best: dict[int, float] = {}
                    least = -np.inf
                    for j in order[near[row, order] >= 0]:
                        # An id may stand at several nodes; nodes of equal score are all looked at.
                        if len(best) >= k and scores[row, j] < least:
                            break
                        for i in ids[near[row, j]]:
                            if i != query and i not in best:
                                best[i] = least = float(scores[row, j])
                    found += [(query, i, best[i]) for i in sorted(best, key=lambda i: (-best[i], i))[:k]]
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=["query_id", "vec_id", "score"])

    keys = ["dims", "shard", "block"]
    tasks = min(TASKS, counts.agg(F.sum(F.col("shards") * F.col("blocks"))).first()[0] or 1)
    left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Each query's ``k`` nearest of all vectors, as far as the graphs lead to them."""
    return search(build_index(vectors, vec_id, embedding, k + 1), queries, k, vec_id, embedding)
