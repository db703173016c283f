"""Nearest neighbours found by the graphs against all cosines."""

import math

import numpy as np
import pytest

import __spark_entry__ as driver
from lakewarden.llm import vector_graph
from tests.llm.conftest import SF_DIR

SCHEMA = "vec_id long, embedding array<double>, rank string, x int"


def cosine(a, b):
    a, b = ([p / max(map(abs, v)) for p in v] for v in (a, b))
    return math.fsum(p * q for p, q in zip(a, b, strict=True)) / math.sqrt(math.fsum(p * p for p in a) * math.fsum(q * q for q in b))


def able(row):
    return row[0] is not None and bool(row[1]) and all(v is not None and math.isfinite(v) for v in row[1]) and any(row[1])


def all_pairs(rows, queries, k):
    """(query, rank) -> (id, score), by comparing everything."""
    out = {}
    for query in {r[0] for r in queries if able(r)}:
        best = {}
        for _, v, *_ in (r for r in queries if r[0] == query and able(r)):
            for i, w, *_ in rows:
                if i != query and able((i, w)) and len(v) == len(w):
                    best[i] = max(best.get(i, -2), cosine(v, w))
        for rank, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k], 1):
            out[query, rank] = (i, s)
    return out


def same(got, want):
    assert {(r.query_id, r["rank"]) for r in got} == set(want)
    for r in got:
        i, s = want[r.query_id, r["rank"]]
        assert r.vec_id == i and abs(r.score - s) < 1e-12


def test_small_table_is_searched_exactly(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).tolist(), "r", 1) for i in range(150)]
    rows += [(200 + i, rows[3][1], "r", 1) for i in range(30)]  # one vector very often
    rows += [(300, (np.array(rows[5][1]) * 1e200).tolist(), "r", 1), (301, rng.normal(size=3).tolist(), None, 1), (302, rng.normal(size=3).tolist(), "r", 1)]
    rows += [(400, None, "r", 1), (401, [], "r", 1), (402, [0.0] * 8, "r", 1), (403, [float("nan")] * 8, "r", 1), (404, [None] * 8, "r", 1), (None, rows[0][1], "r", 1)]
    rows += [(410, [float("inf")] * 8, "r", 1), rows[7], rows[7], (7, rows[8][1], "r", 1), (303, [5.0] * 9, "r", 1)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    asked = [r for r in rows if r[0] is None or r[0] % 2 == 0 or r[0] in (7, 301, 303)]
    want = all_pairs(rows, asked, 5)
    for options in ({}, {"shard": 20}):
        index = vector_graph.build_index(frame, shard=options.get("shard", 2000))
        got = vector_graph.search(index, spark.createDataFrame(asked, SCHEMA), 5, block=7).collect()
        same(got, want)
    assert {r.query_id for r in got}.isdisjoint({303, 400, 401, 402, 403, 404, 410, None})


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, [1.0, 2.0], "r", 1)], SCHEMA)
    assert vector_graph.nearest(none, none).count() == 0
    assert vector_graph.nearest(one, none).count() == 0
    assert vector_graph.nearest(none, one).count() == 0
    assert vector_graph.nearest(one, one).count() == 0


@pytest.mark.parametrize("spread", [None, 0.05])
def test_recall_of_one_graph(spread):
    """A beam finds nearly all nearest of 3,000 vectors, with many near copies or none, looking at a part of them."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 24))
    if spread:
        x = x[rng.integers(0, 60, 3000)] + rng.normal(size=x.shape) * spread
    unit = vector_graph.units(x)
    edges, starts = vector_graph.build_graph(unit)
    assert edges.shape == (3000, vector_graph.DEGREE) and all(len(set(e[e >= 0])) == (e >= 0).sum() for e in edges)
    asked = vector_graph.units(x[::15] + rng.normal(size=(200, 24)) * 0.1)
    found, _ = vector_graph.beam_search(unit, edges, starts, asked, 64)
    true = np.argsort(-(asked @ unit.T), axis=1)[:, :5]
    assert np.mean([len(set(a[:5]) & set(b)) / 5 for a, b in zip(found, true, strict=True)]) > 0.95


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    want = all_pairs(rows, [r for r in rows if r[0] % 50 == 0], 5)
    same(driver.queries()["op12_pruned_graph_search"](spark, SF_DIR).collect(), want)
