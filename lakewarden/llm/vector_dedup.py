"""Near-duplicate embeddings by an exact metric range join.

Vectors of unit length within a cosine are within a distance ``r`` of each other, so cosine links are a range join. Equal
vectors of one label are merged and counted first. Each label gets pivots from a bounded sample of its vectors; a
vector lives in the cell of its nearest pivot. It is also copied to every cell whose border it may reach across: by the
triangle inequality in the form for half-spaces, a vector at most ``r`` away can be nearer to pivot j only if the vector
itself lies within ``r`` of the plane between its own pivot and j. So each cell holds, for each of its residents, all
vectors in range, and cells are joined independently. A large cell is cut into blocks, and pairs of blocks are tasks.

Cosines are taken in double precision from the given components. A vector that is null, empty, zero or holds a null or
non-finite component, or has no label, links with nothing, as do vectors of different length. A null id takes part in
no link. Rows with the same id count as one vector: their links are joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.base import map_batches, settled, ship_package
from lakewarden.llm.components import components

#: A pivot for so many vectors of a label, and at most so many pivots for a label.
VECTORS_PER_PIVOT, MOST_PIVOTS = 4_000, 64
#: Vectors in a block.
BLOCK = 2_000
#: Slack for rounding, in favour of comparing.
SLACK = 1e-9


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """Rows (vec_id, label, x) that can have links, x in double precision."""
    x = F.transform(F.col(embedding).cast("array<double>"), lambda v: v + F.lit(0.0))  # -0.0 becomes 0.0
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))) & ~F.isnan(v))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).alias("label"), x.alias("x"))
    return rows.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite & F.exists("x", lambda v: v != 0)
    ).withColumn("dims", F.size("x"))


def units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(-1, dims)


def pivots_of(classes: DataFrame, per_pivot: int, most: int) -> DataFrame:
    """Rows (label, dims, pivots): for each label up to ``most`` of its vectors, spread by hash."""
    counted = classes.groupBy("label", "dims").agg(F.count(F.lit(1)).alias("vectors"))
    wanted = F.least(F.lit(most), F.ceil(F.col("vectors") / per_pivot))
    # Spark keeps the first ``most`` of a label in each task before the shuffle.
    order = Window.partitionBy("label", "dims").orderBy(F.xxhash64("vec"), "vec")
    sample = classes.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    chosen = sample.join(counted, ["label", "dims"]).filter(F.col("place") <= wanted)
    return chosen.groupBy("label", "dims").agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("pivots"))


def residents_and_guests(classes: DataFrame, pivots: DataFrame, radius: float) -> DataFrame:
    """Each vector once for every cell it must be in: (label, dims, cell, home, vec, n, x)."""
    joined = classes.join(pivots, ["label", "dims"]).select("label", "dims", "vec", "n", "x", F.col("pivots.x").alias("pivots"))
    schema = f"label {classes.schema['label'].dataType.simpleString()}, dims int, cell int, home boolean, vec bigint, n bigint, x array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cells, homes = [], [], []
            names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            groups: dict[tuple, list[int]] = {}
            for i, name in enumerate(names):
                groups.setdefault(name, []).append(i)
            for (_, dims), members in groups.items():
                x = units(matrix(batch.column(4).take(pa.array(members)), dims))
                p = units(np.array(batch.column(5)[members[0]].as_py()))
                dots = x @ p.T
                own = dots.argmax(1)
                # Distance from x to the plane between its own pivot and pivot j.
                apart = np.sqrt(((p[own][:, None, :] - p[None]) ** 2).sum(2))
                reach = (dots.max(1)[:, None] - dots) <= (radius + SLACK) * apart + SLACK
                reach[np.arange(len(x)), own] = True
                at, cell = np.nonzero(reach)
                rows += np.array(members)[at].tolist()
                cells += cell.tolist()
                homes += (own[at] == cell).tolist()
            taken = [batch.column(i).take(pa.array(rows, pa.int64())) for i in range(5)]
            yield pa.RecordBatch.from_arrays(
                [taken[0], taken[1], pa.array(cells, pa.int32()), pa.array(homes, pa.bool_()), *taken[2:]],
                names=["label", "dims", "cell", "home", "vec", "n", "x"],
            )

    return map_batches(joined, run, schema)


def link_vectors(
    vectors: DataFrame,
    cosine: float = 0.98,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    per_pivot: int = VECTORS_PER_PIVOT,
    most_pivots: int = MOST_PIVOTS,
    block: int = BLOCK,
) -> DataFrame:
    """Per vector: vec_id, n_links (others linked directly), component_id and kept (the least id of its component)."""
    ship_package(vectors.sparkSession)
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))
    able = settled(usable(vectors, vec_id, embedding, label))
    # Equal vectors of one label are one class: linked with each other, and all with the same others.
    keys = ["label", "dims", "x"]
    grouped = able.groupBy(*keys).agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = settled(grouped.withColumn("vec", F.xxhash64(*keys)))
    placed = residents_and_guests(classes, pivots_of(classes, per_pivot, most_pivots), radius)
    placed = settled(placed)
    sizes = placed.groupBy("label", "dims", "cell").agg(F.count(F.lit(1)).alias("size"))
    cut = placed.join(sizes, ["label", "dims", "cell"]).withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("vec", "cell"), F.col("blocks")).cast("int"))
    # Pairs of blocks (i, j), i <= j: a vector goes to the pairs its block is part of.
    spread = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = spread.select(
        "label", "dims", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "home", "vec", "n", "x"
    )

    def join(group: pa.Table) -> pa.Table:
        dims, i, j = group["dims"][0].as_py(), group["i"][0].as_py(), group["j"][0].as_py()
        own, home = group["own"].to_numpy(), group["home"].to_numpy(zero_copy_only=False)
        vec, n, x = group["vec"].to_numpy(), group["n"].to_numpy(), units(matrix(group["x"], dims))
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        links = np.zeros(len(vec), np.int64)
        edges = []
        for start in range(0, len(left), 500):
            some = left[start : start + 500]
            near = (x[some] @ x[right].T >= cosine) & (vec[some][:, None] != vec[right][None])
            # Every pair is counted for a vector in its home cell only.
            links[some] += np.where(home[some], near @ n[right], 0)
            if i != j:
                links[right] += np.where(home[right], n[some] @ near, 0)
            a, b = np.nonzero(near)
            edges.append(np.stack([some[a], right[b]]))
        a, b = np.concatenate(edges, axis=1) if edges else np.zeros((2, 0), np.int64)
        # Links inside the task shrink to one edge from each vector to the first it reaches.
        low = np.arange(len(vec))
        while True:
            before = low.copy()
            np.minimum.at(low, a, low[b])
            np.minimum.at(low, b, low[a])
            low = low[low]
            if (low == before).all():
                break
        some = np.flatnonzero((links > 0) | (low != np.arange(len(vec))))
        return pa.table([pa.array(vec[some]), pa.array(links[some]), pa.array(vec[low[some]])], names=["vec", "links", "other"])

    found = settled(tasks.groupBy("label", "dims", "cell", "i", "j").applyInArrow(join, "vec bigint, links bigint, other bigint"))
    names = classes.select("vec", "least")
    edges = found.filter("vec <> other").select("vec", "other").distinct().join(names, "vec").select("least", F.col("other").alias("vec"))
    edges = edges.withColumnRenamed("least", "u").join(names.withColumnRenamed("least", "v"), "vec").select("u", "v")
    counts = found.groupBy("vec").agg(F.sum("links").alias("links"))
    in_class = able.select("vec_id", F.xxhash64(*keys).alias("vec")).join(classes.select("vec", "n", "least"), "vec")
    rooted = components(edges.unionByName(in_class.filter("vec_id <> least").select(F.col("vec_id").alias("u"), F.col("least").alias("v"))))
    direct = (
        in_class.join(counts, "vec", "left")
        .groupBy("vec_id")
        .agg(F.sum(F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    ids = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"))
    out = ids.join(direct, "vec_id", "left").join(rooted.toDF("vec_id", "root"), "vec_id", "left")
    component = F.coalesce("root", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
