"""Whitening of embeddings from exact integer arithmetic.

Entries become whole numbers, ``floor(1024 * c) + 100000``. Tasks sum the entries and their products exactly; what comes
to the driver has the size of one matrix, whatever the number of rows. With n rows, sums S and products P the scatter
``n * P - S * S'`` is a whole matrix, n * n times the covariance. Its characteristic polynomial is computed modulo many
primes, one row of a small table each, by reduction to Hessenberg form, and put together by Chinese remaindering: the
primes' product exceeds twice any coefficient, so the polynomial is exact. All its roots are real, so the sign changes of
the polynomial shifted to a point count the roots beyond it exactly; bisection on them isolates each root, and signs
narrow it down to ``DIGITS`` bits of the trace. A component is the null space of the scatter less its root, by inverse
iteration in long decimals. Components, too, are rows of a small table. Then each vector is projected where it is read.

Vectors that are null or hold a null or non-finite entry are dropped; a null id is kept. Repeated rows count as often as
they are there. Vectors of different length have nothing to do with each other: each length is fitted and whitened by
itself, and empty vectors have no components. An eigenvalue that occurs several times gets any orthonormal vectors of its
space, the same for all rows. A component without variance has a null ``whitened`` and an ``explained`` of 0 (null if no
component has any), and ``identity_error`` is taken over the others. ``deviation`` is null where it exceeds a long;
``deviation_decimal`` then still holds it. An entry beyond 2 ** 52 has no exact floor of this kind and raises an error.
Columns beyond those named are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Context, Decimal, localcontext
from functools import reduce
from math import comb, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.base import map_batches

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Bits of the trace to which a root is known, and decimal digits while solving for its component.
DIGITS, PLACES = 256, 120
LIMB = 20
OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, deviation_decimal decimal(38,0)"


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Rows (vec_id, dims, x) whose vectors have finite entries only."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))) & ~F.isnan(v))
    return rows.filter(F.col("x").isNotNull() & (F.size("x") > 0) & finite).select("vec_id", F.size("x").alias("dims"), "x")


def whole(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length in a batch: the length, the places of its rows, and ``floor(1024 * c)`` of their entries."""
    dims = batch.column(1).to_numpy()
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        x = batch.column(2).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        if (np.abs(x) > 2.0**52).any():
            raise ValueError("an entry of a vector is beyond 2 ** 52")
        yield int(d), at, np.floor(SCALE * x).astype(np.int64)


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """Signed digits of ``y`` to the base 2 ** 20, as doubles; products of two, summed over 4096, are exact."""
    out = []
    while not out or y.any():
        low = ((y + (1 << LIMB - 1)) & ((1 << LIMB) - 1)) - (1 << LIMB - 1)
        out.append(low.astype(np.float64))
        y = (y - low) >> LIMB
    return out


def product_sums(y: np.ndarray) -> np.ndarray:
    """``y' y`` as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for start in range(0, len(y), 4096):
        parts = limbs(y[start : start + 4096])
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                total = total + ((a.T @ b).astype(np.int64).astype(object) << LIMB * (i + j))
    return total


def sums(rows: DataFrame) -> dict[int, tuple[int, list[int], list[list[int]]]]:
    """By length: the number of vectors, the sums of their whole entries and of these entries' products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for d, at, y in whole(batch):
                old = totals.get(d, [0, 0, 0])
                totals[d] = [old[0] + len(at), old[1] + y.astype(object).sum(0), old[2] + product_sums(y)]
        for d, (n, s, p) in totals.items():
            # A row for the number (-1, -1), each sum (i, -1) and each product (i, j) with j <= i.
            i, j = np.tril_indices(d)
            columns = [[-1, *range(d), *i.tolist()], [-1] * (d + 1) + j.tolist(), [n, *s, *p[i, j]]]
            arrays = [pa.array([d] * len(columns[0]), pa.int32()), pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32())]
            values = pa.array([Decimal(int(v)) for v in columns[2]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([*arrays, values], names=["dims", "i", "j", "value"])

    parts = map_batches(rows, run, "dims int, i int, j int, value decimal(38,0)")
    out: dict[int, tuple] = {}
    # One matrix of numbers per length, whatever the number of rows.
    for d, i, j, value in parts.groupBy("dims", "i", "j").agg(F.sum("value")).orderBy("dims", "i", "j").collect():
        value = int(value)
        if i < 0:
            out[d] = (value, [0] * d, [[0] * d for _ in range(d)])
        elif j < 0:
            out[d][1][i] = value
        else:
            out[d][2][i][j] = out[d][2][j][i] = value
    return out


def is_prime(n: int) -> bool:
    """For odd n below 2 ** 31: the strong test to the bases 2, 3, 5 and 7 is sure there."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(least: int) -> list[int]:
    """Primes below 2 ** 31, falling, whose product exceeds ``least``."""
    out, product, n = [], 1, 2**31 - 1
    while product <= least:
        if is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients modulo ``p``, highest first, of the characteristic polynomial, by reduction to Hessenberg form."""
    h, size = matrix.copy(), len(matrix)
    for m in range(1, size - 1):
        places = np.flatnonzero(h[m:, m - 1])
        if not len(places):
            continue
        pivot = m + int(places[0])
        if pivot != m:
            h[[m, pivot]] = h[[pivot, m]]
            h[:, [m, pivot]] = h[:, [pivot, m]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m][None] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u[None] % p).sum(1)) % p
    # Row m holds the polynomial of the leading m by m part, lowest power first.
    polynomials = np.zeros((size + 1, size + 1), np.int64)
    polynomials[0, 0] = 1
    below = np.zeros(0, np.int64)
    for m in range(1, size + 1):
        last = polynomials[m - 1]
        new = np.zeros(size + 1, np.int64)
        new[1:] = last[:-1]
        new = (new - int(h[m - 1, m - 1]) * last) % p
        if m > 1:
            # Products of the entries under the diagonal, from each row down to this one.
            below = np.append(below, 1) * int(h[m - 1, m - 2]) % p
            weights = below * h[: m - 1, m - 1] % p
            new = (new - (weights[:, None] * polynomials[: m - 1] % p).sum(0)) % p
        polynomials[m] = new
    return polynomials[size][::-1].tolist()


def remaindered(residues: list[int], primes: list[int]) -> int:
    """The whole number of least absolute value with these remainders."""
    whole_product = prod(primes)
    total = 0
    for r, p in zip(residues, primes, strict=True):
        rest = whole_product // p
        total += r * rest * pow(rest, -1, p)
    total %= whole_product
    return total - whole_product if 2 * total > whole_product else total


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients, highest first, of a symmetric whole matrix without negative eigenvalues; a task per few primes."""
    size, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # An elementary symmetric function of numbers that are not negative is largest when they are equal.
    most = max(comb(size, k) * (trace // size + 1) ** k for k in range(size + 1))
    primes = primes_beyond(2 * most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [polynomial_modulo(np.array([[v % p for v in row] for row in matrix], np.int64), p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["prime", "coefficients"])

    table = spark.createDataFrame([(p,) for p in primes], "prime bigint").repartition(max(1, len(primes) // 8))
    rows = map_batches(table, run, "prime bigint, coefficients array<bigint>").collect()
    return [remaindered([r.coefficients[k] for r in rows], [r.prime for r in rows]) for k in range(size + 1)]


def roots_beyond(polynomial: list[int], point: int) -> int:
    """How many roots, all of them real, are larger: the sign changes of the polynomial shifted by ``point`` (Descartes)."""
    shifted = list(polynomial)
    for last in range(len(shifted), 1, -1):
        for i in range(1, last):
            shifted[i] += shifted[i - 1] * point
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def value_at(polynomial: list[int], point: int) -> int:
    return reduce(lambda total, c: total * point + c, polynomial, 0)


def isolated_root(polynomial: list[int], number: int, trace: int, digits: int = DIGITS) -> tuple[int, int, int, int]:
    """The ``number``-th largest root (from 1) in units of 2 ** -scale: (root, scale, place in its group, size of the group).

    Roots that agree in all digits are a group. A root of 0 is exact.
    """
    if roots_beyond(polynomial, 0) < number:
        return 0, 0, 0, 1
    scale = max(0, digits - trace.bit_length())
    fine = [c << scale * k for k, c in enumerate(polynomial)]
    low, high = 0, (trace << scale) + 1
    more, fewer = roots_beyond(fine, low), 0
    while high - low > 1:
        middle = (low + high) // 2
        if more - fewer == 1:
            # Alone in the interval: the sign tells the side. From ``fewer`` roots beyond follows the sign there.
            value = value_at(fine, middle)
            beyond = fewer + (value != 0 and (value > 0) != (fewer % 2 == 0))
        else:
            beyond = roots_beyond(fine, middle)
        if beyond >= number:
            low, more = middle, beyond
        else:
            high, fewer = middle, beyond
    return high, scale, number - 1 - fewer, more - fewer


def null_vector(matrix: list[list[int]], root: Decimal, place: int, group: int) -> list[float]:
    """The ``place``-th of ``group`` orthonormal vectors of the null space of the matrix less the root, by inverse iteration."""
    size = len(matrix)
    with localcontext(Context(prec=PLACES)):
        upper = [[Decimal(v) for v in row] for row in matrix]
        for i in range(size):
            upper[i][i] -= root
        # A pivot of zero is put a little off, far below what the iteration can tell apart.
        tiny = max(row[i] for i, row in enumerate(matrix)) * Decimal(10) ** (10 - PLACES)
        order = list(range(size))
        for m in range(size):
            pivot = max(range(m, size), key=lambda i: abs(upper[i][m]))
            upper[m], upper[pivot] = upper[pivot], upper[m]
            order[m], order[pivot] = order[pivot], order[m]
            if abs(upper[m][m]) < tiny:
                upper[m][m] = tiny
            base = upper[m]
            for i in range(m + 1, size):
                row = upper[i]
                factor = row[m] / base[m]
                row[m] = factor
                if factor:
                    for j in range(m + 1, size):
                        row[j] -= factor * base[j]

        def solved(b: list[Decimal]) -> list[Decimal]:
            y: list[Decimal] = []
            for i in range(size):
                y.append(b[order[i]] - sum((upper[i][j] * y[j] for j in range(i)), Decimal(0)))
            x = [Decimal(0)] * size
            for i in reversed(range(size)):
                x[i] = (y[i] - sum((upper[i][j] * x[j] for j in range(i + 1, size)), Decimal(0))) / upper[i][i]
            return x

        rng = np.random.default_rng(size)
        basis = [[Decimal(float(v)) for v in rng.normal(size=size)] for _ in range(group)]
        for _ in range(3):
            done: list[list[Decimal]] = []
            for start in basis:
                x = solved(start)
                scale = max(abs(v) for v in x)
                x = [v / scale for v in x]
                for _ in range(2):
                    for other in done:
                        along = sum(a * b for a, b in zip(x, other, strict=True))
                        x = [a - along * b for a, b in zip(x, other, strict=True)]
                length = sum(v * v for v in x).sqrt()
                done.append([v / length for v in x])
            basis = done
        chosen = basis[place]
        return [float(v) for v in (chosen if max(chosen, key=abs) > 0 else [-v for v in chosen])]


def principal_components(spark, matrix: list[list[int]], count: int) -> list[tuple[Decimal, list[float]]]:
    """The largest eigenvalues of the scatter with their unit vectors; a task per component."""
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    polynomial = characteristic_polynomial(spark, matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, values, vectors = batch.column(0).to_pylist(), [], []
            for number in numbers:
                root, scale, place, group = isolated_root(polynomial, number, trace)
                with localcontext(Context(prec=PLACES)):
                    value = Decimal(root) / Decimal(2) ** scale
                values.append(str(value))
                vectors.append(null_vector(matrix, value, place, group) if root else [0.0] * len(matrix))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values), pa.array(vectors, pa.list_(pa.float64()))], names=["number", "value", "vector"])

    wanted = min(count, len(matrix))
    table = spark.createDataFrame([(i + 1,) for i in range(wanted)], "number int").repartition(wanted, "number")
    rows = map_batches(table, run, "number int, value string, vector array<double>").collect()
    return [(Decimal(r["value"]), r["vector"]) for r in sorted(rows, key=lambda r: r["number"])]


def squared_sums(z: np.ndarray) -> list[int]:
    """Sums of squares of each row, exactly."""
    if not z.size or int(np.abs(z).max()) ** 2 * z.shape[1] < 2**63:
        return (z * z).sum(1).tolist()
    parts = [p.astype(np.int64) for p in limbs(z)]
    total = np.zeros(len(z), object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            total = total + ((a * b).sum(1).astype(object) << LIMB * (i + j))
    return [int(t) for t in total]


def projected(rows: DataFrame, n: int, s: list[int], components: list[tuple[Decimal, list[float]]]) -> DataFrame:
    """(vec_id, exact deviation, whitened values): each vector against the mean, along the components."""
    axes = np.array([v for _, v in components]).T
    with localcontext(Context(prec=PLACES)):
        # x - S / n over the root of e is n * x - S over the root of n * n * e, which is the scatter's eigenvalue.
        sizes = np.array([float(e.sqrt()) if e else np.nan for e, _ in components])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, y in whole(batch):
                small = n * max(int(np.abs(y).max()), 1) < 2**61
                z = n * y - np.array(s) if small else n * y.astype(object) - np.array(s, object)
                squares = squared_sums(z) if small else [int(t) for t in (z * z).sum(1)]
                whitened = z.astype(np.float64) @ axes / sizes
                arrays = [
                    batch.column(0),
                    pa.array([Decimal(t) for t in squares], pa.decimal128(38, 0)),
                    pa.array(whitened.tolist(), pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "deviation", "w"])

    return map_batches(rows, run, "vec_id bigint, deviation decimal(38,0), w array<double>")


def identity_error(white: DataFrame, live: list[int]) -> float | None:
    """The largest entry, in absolute value, of the covariance of the whitened values less the identity."""
    pairs = [(i, j) for i in live for j in live if i <= j]
    if not pairs:
        return None
    found = white.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True))


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error, deviation_decimal."""
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, embedding)
    out = spark.createDataFrame([], OUT)
    for d, (n, s, products) in sums(rows).items():
        scatter = [[n * products[i][j] - s[i] * s[j] for j in range(d)] for i in range(d)]
        trace = sum(scatter[i][i] for i in range(d))
        components = principal_components(spark, scatter, count)
        white = projected(rows.filter(F.col("dims") == d), n, s, components)
        live = [k for k, (e, _) in enumerate(components) if e]
        error = identity_error(white, live)
        with localcontext(Context(prec=PLACES)):
            shares = [float(e / trace) if trace else None for e, _ in components]
        explained = F.array(*[F.lit(share).cast("double") for share in shares])
        one = white.select("vec_id", "deviation", F.posexplode("w").alias("k", "w"))
        out = out.unionByName(
            one.select(
                "vec_id",
                (F.col("k") + 1).alias("component"),
                F.lit(n).cast("bigint").alias("n"),
                F.expr("try_cast(deviation as bigint)").alias("deviation"),
                F.when(~F.isnan("w"), F.col("w")).alias("whitened"),
                explained[F.col("k")].alias("explained"),
                F.lit(error).cast("double").alias("identity_error"),
                F.col("deviation").alias("deviation_decimal"),
            )
        )
    return out
