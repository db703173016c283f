"""Exact whitening against exact fractions and against an eigensolver in double precision."""

import math
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as driver
from lakewarden.llm import whitening
from tests.llm.conftest import SF_DIR

SCHEMA = "vec_id long, embedding array<double>, component string, w int"


def able(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def check(got, rows, count=8):
    """Every column, with the covariance from exact sums; components by size of the residual and by direction."""
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows], object)
    n, s = len(x), x.sum(0)
    scatter = n * (x.T @ x) - np.outer(s, s)
    values, vectors = np.linalg.eigh((scatter / n**2).astype(float))
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(sum(scatter.diagonal())) / n**2
    wanted = min(count, x.shape[1])
    assert len(got) == n * wanted
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    signs = {}
    for (i, _), own in zip(rows, x, strict=True):
        centred = np.array([float(Fraction(n * int(a) - int(b), n)) for a, b in zip(own, s, strict=True)])
        exact = sum((n * int(a) - int(b)) ** 2 for a, b in zip(own, s, strict=True))
        assert sorted(by_id[i]) == list(range(1, wanted + 1))
        for k, r in by_id[i].items():
            assert (r.n, r.deviation, int(r.deviation_decimal)) == (n, exact if exact < 2**63 else None, exact)
            if values[k - 1] < 1e-9 * trace:
                assert r.whitened is None and r.explained == (0.0 if trace else None)
                continue
            assert abs(r.explained / (values[k - 1] / trace) - 1) < 1e-6
            assert r.identity_error <= 1e-4
            value = centred @ vectors[:, k - 1] / math.sqrt(values[k - 1])
            if abs(value) > 1e-6:
                sign = signs.setdefault(k, np.sign(value * r.whitened))
                assert abs(value * sign - r.whitened) < 1e-6
    return got


def test_whitening(spark):
    rng = np.random.default_rng(2)
    mixed = rng.normal(size=(10, 10)) * np.array([3, 2, 1, 1, 0.5, 0.4, 0.3, 0.2, 0.1, 0.1])
    rows = [(i, (rng.normal(size=10) @ mixed).tolist()) for i in range(200)]
    odd = [(300, None), (301, [None] * 10), (302, [float("nan")] * 10), (303, [float("-inf")] * 10), (304, []), (305, [1.0] * 9 + [None])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows + odd], SCHEMA).repartition(5)
    check(whitening.whiten(frame).collect(), rows)


def test_repeated_rows_null_ids_and_lengths(spark):
    rng = np.random.default_rng(6)
    one = [(i, rng.normal(size=3).tolist()) for i in range(20)]
    two = [(100 + i, rng.normal(size=2).tolist()) for i in range(20)] + [(None, [5.0, -3.0])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in [*one, *one, *one, *two]], SCHEMA)
    got = whitening.whiten(frame).collect()
    check([r for r in got if r.vec_id is None or r.vec_id >= 100], two)
    thrice = [r for r in got if r.vec_id is not None and r.vec_id < 100]
    assert len(thrice) == 3 * 20 * 3 and {r.n for r in thrice} == {60}


def test_no_variance(spark):
    schema = "vec_id long, embedding array<double>"
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(0, None, None, None)] * 4
    flat = [(i, [float(i), 3.0, -2.0 * i]) for i in range(9)]  # one direction only
    check(whitening.whiten(spark.createDataFrame(flat, schema)).collect(), flat)
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0


def test_equal_eigenvalues(spark):
    """A space of several equal eigenvalues gets orthonormal vectors."""
    rows = [(2 * i + j, [float((2 * j - 1) * 4 * (k == i)) for k in range(5)]) for i in range(5) for j in range(2)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.identity_error < 1e-12 for r in got} == {True}
    assert {round(r.explained, 12) for r in got} == {0.2}


def test_large_entries(spark):
    rows = [(1, [2.0**40, 1.0]), (2, [-(2.0**40), 3.0]), (3, [5.0, 2.0**41])]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    check(list(got.values()), rows)
    with pytest.raises(Exception, match="beyond 2"):
        whitening.whiten(spark.createDataFrame([(1, [2.0**60])], "vec_id long, embedding array<double>")).collect()


def test_polynomial():
    """Modular polynomials put together against the recursion of Faddeev and LeVerrier in whole numbers."""
    rng = np.random.default_rng(1)
    half = rng.integers(-50, 50, (7, 4))
    matrix = (half @ half.T).astype(object)  # rank 4: zero is a root three times
    m, want = np.zeros_like(matrix), [1]
    for k in range(1, 8):
        m = matrix @ m + want[-1] * np.eye(7, dtype=int).astype(object)
        want.append(-int((matrix @ m).trace()) // k)
    primes = whitening.primes_beyond(2 * max(map(abs, want)))
    residues = [whitening.polynomial_modulo(np.array(matrix % p, np.int64), p) for p in primes]
    assert [whitening.remaindered([r[k] for r in residues], primes) for k in range(8)] == want
    assert whitening.roots_beyond(want, 0) == 4 and whitening.roots_beyond(want, -1) == 7
    true = np.linalg.eigvalsh(matrix.astype(float))[::-1]
    for number in range(1, 8):
        root, scale, _, _ = whitening.isolated_root(want, number, int(matrix.trace()))
        assert abs(root / 2**scale - true[number - 1]) < 1e-6
    assert whitening.isolated_root([1, -6, 9], 2, 6)[2:] == (1, 2)  # (x - 3) twice


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect() if able(r.embedding)]
    got = check(driver.queries()["op13_exact_whitening"](spark, SF_DIR).collect(), rows)
    assert max(r.identity_error for r in got) < 1e-9
