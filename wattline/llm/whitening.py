"""Operator 13: embedding whitening from the exact characteristic polynomial.

Entries become integers, x = floor(64 c) + 1000000. The scatter of the n vectors,
n sum(x x') - S S' with S the sum of x, is an integer matrix, n**2 times their
covariance, and is computed exactly: tasks multiply their rows in pieces of 20
bits, whose sums are exact in doubles, and Spark adds the pieces up.

The polynomial det(t - scatter) has integer coefficients. Modulo each of many
primes it comes from a reduction to Hessenberg form (a row of a Spark table per
prime); the coefficients follow by Chinese remaindering (a group per
coefficient). The number of primes is proven: the scatter has no negative
eigenvalue, so a coefficient is at most a binomial times a power of the mean of
the diagonal (Maclaurin's inequality).

All roots are real, so the sign changes of the coefficients of p(t + a) count
the roots beyond a, with multiplicity (Budan's theorem, exact for such
polynomials). Bisection at multiples of 2**-f isolates the roots; a root that
is alone is refined by signs of p alone. Every root is known to ``ROOT_BITS``
bits of the largest one and of itself. Roots that aren't told apart by then are
one root of that multiplicity.

A component is the null vector of scatter - root: inverse iteration with
integers of fixed point, one factorisation per root, one task per root. Vectors
of a multiple root are orthogonalised with each other. So components are unit
eigenvectors to double precision even where roots lie close together.

Scale: tables that the driver holds, the scatter and the components, grow with
the dimension alone, never with the rows; two passes over the vectors gather
the sums, two more audit the covariance of the whitened rows.

Nulls: vectors that are null, hold null or non-finite entries, or whose length
isn't the most common one (the smaller of equally common ones) are dropped.
Entries are cut to +-2**62 before they become integers. A null or repeated
vec_id is kept as it is; repeated vectors count as often as they occur.
Components without variance have no scale and are left out, so vectors that are
all equal, or a single one, give no rows; so does an empty table. A deviation
that doesn't fit a long is null.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Entries are cut to this size before they become integers.
LARGEST = 1 << 62
#: Bits of a piece of an entry; the products of PIECE_ROWS rows of pieces add up exactly in a double.
PIECE, PIECE_ROWS = 20, 4096
#: Bits of a piece of a task's sum.
LIMB = 30
#: Correct bits of a root, and further bits of the fixed-point numbers of the inverse iteration.
ROOT_BITS, GUARD_BITS = 160, 160
#: Rounds of inverse iteration; each gains about as many bits as separate the root from its neighbours.
ROUNDS = 4


def quantised(vectors: np.ndarray) -> np.ndarray:
    """x - OFFSET of each entry, as 64-bit integers."""
    return np.clip(np.floor(vectors.astype(np.float64) * SCALE), -float(LARGEST), float(LARGEST)).astype(np.int64)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    at = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]].reshape(-1, dim)


def _pieces(y: np.ndarray) -> list[np.ndarray]:
    """Doubles whose sum, each weighted by 2**(PIECE * its place), is ``y``; the last one has its sign."""
    pieces = []
    while True:
        if np.abs(y).max(initial=0) < 1 << PIECE:
            return [*pieces, y.astype(np.float64)]
        pieces.append((y & ((1 << PIECE) - 1)).astype(np.float64))
        y = y >> PIECE


def exact_scatter(y: np.ndarray) -> np.ndarray:
    """Exact sums of (1, y) (1, y)' over the rows, as Python integers."""
    total = np.zeros((y.shape[1] + 1,) * 2, object)
    for at in range(0, len(y), PIECE_ROWS):
        rows = _pieces(np.hstack([np.ones((len(y[at:at + PIECE_ROWS]), 1), np.int64), y[at:at + PIECE_ROWS]]))
        for i, a in enumerate(rows):
            for j, b in enumerate(rows):
                total += (a.T @ b).astype(np.int64).astype(object) << (PIECE * (i + j))
    return total


def _sums(dim: int):
    """(cell, limb, value): one task's sums of products, cell by cell of the upper triangle, in pieces of LIMB bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1,) * 2, object)
        for batch in batches:
            total += exact_scatter(quantised(_matrix(batch.column(0), dim)))
        upper = total[np.triu_indices(dim + 1)]
        cells, limbs, values = [], [], []
        for cell, value in enumerate(upper):
            sign, value, limb = (1 if value >= 0 else -1), abs(value), 0
            while value:
                cells.append(cell)
                limbs.append(limb)
                values.append(sign * (value & ((1 << LIMB) - 1)))
                value, limb = value >> LIMB, limb + 1
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(limbs, pa.int32()), pa.array(values, pa.int64())],
                                         ["cell", "limb", "value"])
    return run


def product_sums(vectors: DataFrame, dim: int) -> np.ndarray:
    """Exact sums of (1, y) (1, y)' over all rows of ``vectors`` (vec), as Python integers."""
    parts = vectors.select("vec").mapInArrow(_sums(dim), "cell int, limb int, value long")
    total = [0] * ((dim + 1) * (dim + 2) // 2)
    # Bounded by the dimension: a few rows for each pair of dimensions.
    for row in parts.groupBy("cell", "limb").agg(F.sum("value").alias("value")).toLocalIterator():
        total[row["cell"]] += row["value"] << (LIMB * row["limb"])
    out = np.zeros((dim + 1,) * 2, object)
    out[np.triu_indices(dim + 1)] = total
    return np.triu(out) + np.triu(out, 1).T


def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top``."""
    found: list[int] = []
    small = [p for p in range(2, math.isqrt(top) + 1) if all(p % q for q in range(2, math.isqrt(p) + 1))]
    while len(found) < count:
        block = range(max(2, top - (1 << 16)), top)
        kept = np.ones(len(block), bool)
        for p in small:
            kept[max(-block.start % p, p * p - block.start if p * p > block.start else 0)::p] = False
        found += [block.start + int(i) for i in np.flatnonzero(kept)[::-1]]
        top = block.start
    return found[:count]


def coefficients_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(t - matrix) modulo the prime p < 2**31, the lowest first."""
    h = np.array([[int(v) % p for v in row] for row in matrix], dtype=np.int64)
    n = len(h)
    for k in range(1, n - 1):
        found = np.flatnonzero(h[k:, k - 1])
        if not len(found):
            continue
        pivot = k + int(found[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factor = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - factor[:, None] * h[k] % p) % p
        # The inverse change of the columns: column k gets the sum of the others by the same factors.
        h[:, k] = (h[:, k] + (h[:, k + 1:] * factor % p).sum(1)) % p
    polys = [np.array([1], np.int64)]
    for k in range(n):
        new = np.zeros(k + 2, np.int64)
        new[1:] = polys[k]
        new[:-1] = (new[:-1] - int(h[k, k]) * polys[k] % p) % p
        below = 1
        for i in range(k - 1, -1, -1):
            below = below * int(h[i + 1, i]) % p
            if not below:
                break
            new[:i + 1] = (new[:i + 1] - int(h[i, k]) * below % p * polys[i] % p) % p
        polys.append(new)
    return [int(c) for c in polys[n]]


def primes_needed(matrix: np.ndarray) -> int:
    """Primes of 31 bits whose product exceeds twice every coefficient of a matrix without negative eigenvalues."""
    n, trace = len(matrix), int(np.trace(matrix))
    bits = max(math.comb(n, k).bit_length() + k * (-(-trace // n)).bit_length() for k in range(n + 1))
    return (bits + 2) // 30 + 1


def characteristic_polynomial(spark, matrix: np.ndarray) -> list[int]:
    """Integer coefficients of det(t - matrix), the lowest first; a row per prime and a group per coefficient."""
    n = len(matrix)
    exact = [[int(v) for v in row] for row in matrix]

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(n + 1), pa.int32()), pa.array([p] * (n + 1), pa.int64()), pa.array(coefficients_mod(exact, p), pa.int64())],
                    ["power", "prime", "residue"])

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            for primes, remainders in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                value, product = 0, 1
                for p, r in zip(primes, remainders):
                    value += product * ((r - value) * pow(product, -1, p) % p)
                    product *= p
                values.append(str(value - product if 2 * value > product else value))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.string())], ["power", "value"])
    primes = primes_below(1 << 31, primes_needed(matrix))
    table = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(min(len(primes), 2 * spark.sparkContext.defaultParallelism))
    pairs = F.sort_array(F.collect_list(F.struct("prime", "residue")))
    groups = table.mapInArrow(residues, "power int, prime long, residue long").groupBy("power").agg(pairs.alias("pairs"))
    rows = groups.select("power", "pairs.prime", "pairs.residue").mapInArrow(combined, "power int, value string").collect()
    return [int(r["value"]) for r in sorted(rows, key=lambda r: r["power"])]


class RealRoots:
    """The roots of an integer polynomial all of whose roots are real and not negative, at multiples of 2**-places."""

    def __init__(self, coefficients: list[int], places: int):
        self.n = len(coefficients) - 1
        # p(x / 2**places) times 2**(places * n): integer again, and its roots are 2**places times those of p.
        self.p = [c << (places * (self.n - k)) for k, c in enumerate(coefficients)]

    def beyond(self, a: int) -> int:
        """Roots greater than ``a``, with multiplicity: sign changes of the coefficients of p(t + a)."""
        shifted = np.array(self.p[::-1], dtype=object)
        for i in range(self.n):
            # Synthetic division by t - a, of the part that isn't a remainder yet.
            for k in range(1, self.n + 1 - i):
                shifted[k] += a * shifted[k - 1]
        signs = [c > 0 for c in shifted if c]
        return sum(x != y for x, y in zip(signs, signs[1:]))

    def value(self, a: int) -> int:
        value = 0
        for c in reversed(self.p):
            value = value * a + c
        return value

    def largest(self, count: int, top: int, bits: int) -> list[tuple[int, int, int]]:
        """(low, high, multiplicity) of the ``count`` largest positive roots, the largest first.

        Low < root <= high; intervals are narrower than 2**-bits of low, unless
        the last place is reached first. A root that stays together with
        others is one of that multiplicity.
        """
        found: list[tuple[int, int, int]] = []
        todo = [(0, top, 0, self.beyond(0))]
        while todo and sum(m for _, _, m in found) < count:
            low, high, above, below = todo.pop()
            m = below - above
            if not m:
                continue
            narrow = high - low <= max(1, low >> bits)
            if m == 1 and not narrow:
                low, high = self._refined(low, high, above, bits)
                narrow = True
            if narrow:
                found.append((low, high, m))
                continue
            middle = self._middle(low, high)
            at = self.beyond(middle)
            todo += [(low, middle, at, below), (middle, high, above, at)]
        return found

    @staticmethod
    def _middle(low: int, high: int) -> int:
        """A point between; geometric where the ends are far apart, so that small roots take no more steps than large ones."""
        return 1 << ((low.bit_length() + high.bit_length()) // 2) if high > 4 * (low + 1) else (low + high) // 2

    def _refined(self, low: int, high: int, above: int, bits: int) -> tuple[int, int]:
        """The interval of a root that is alone in it, narrowed by the sign of p, which changes there."""
        while high - low > max(1, low >> bits):
            middle = self._middle(low, high)
            value = self.value(middle)
            if value == 0 or (value > 0) == (above % 2 == 0):
                high = middle
            else:
                low = middle
        return low, high


def null_vectors(matrix: list[list[int]], root: int, places: int, multiplicity: int) -> list[list[float]]:
    """Orthonormal eigenvectors of an integer matrix at ``root`` / 2**places, by inverse iteration.

    Numbers are integers of fixed point. The factorisation pivots by columns; a
    last pivot of zero, an exact root, is replaced by the smallest number.
    """
    n = len(matrix)
    size = max(max(abs(v) for row in matrix for v in row), root >> places).bit_length()
    point = size + ROOT_BITS + GUARD_BITS
    shift = point - places
    a = np.array([[int(v) << point for v in row] for row in matrix], dtype=object)
    for i in range(n):
        a[i, i] -= root << shift if shift >= 0 else root >> -shift
    # Entries are scaled so that the matrix is of size 2**point: fixed-point numbers around one.
    a = a >> size
    order = np.arange(n)
    for k in range(n):
        pivot = k + max(range(n - k), key=lambda i: abs(a[k + i, k]))
        if pivot != k:
            a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
        if not a[k, k]:
            a[k, k] = 1
        if k + 1 < n:
            a[k + 1:, k] = (a[k + 1:, k] << point) // a[k, k]
            a[k + 1:, k + 1:] -= (a[k + 1:, k][:, None] * a[k, k + 1:][None, :]) >> point

    def solved(b: np.ndarray) -> np.ndarray:
        x = b[order].copy()
        for i in range(1, n):
            x[i] -= (a[i, :i] * x[:i]).sum() >> point
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                x[i] -= (a[i, i + 1:] * x[i + 1:]).sum() >> point
            x[i] = (x[i] << point) // a[i, i]
        return x

    def unit(x: np.ndarray) -> np.ndarray:
        length = math.isqrt(int((x * x).sum()))
        return (x << point) // max(1, length)
    rng = np.random.default_rng(13)
    found: list[np.ndarray] = []
    for _ in range(multiplicity):
        x = unit(np.array([int(v) for v in rng.integers(-1 << 40, 1 << 40, n)], dtype=object) << (point - 40))
        for _ in range(ROUNDS):
            x = unit(solved(x))
            for _ in range(2):
                for v in found:
                    x = x - ((v * ((v * x).sum() >> point)) >> point)
            x = unit(x)
        found.append(x)
    return [[int(v) / (1 << point) for v in x] for x in found]


def eigen(spark, scatter: np.ndarray, count: int = COMPONENTS) -> tuple[list[tuple[int, int]], np.ndarray]:
    """The largest positive eigenvalues as (numerator, bits of the denominator), with their unit eigenvectors as rows."""
    dim, trace = len(scatter), int(np.trace(scatter))
    if trace <= 0:
        return [], np.zeros((0, dim))
    matrix = [[int(v) for v in row] for row in scatter]
    polynomial = characteristic_polynomial(spark, scatter)
    # The smallest positive root is at least the quotient of the two lowest coefficients: the last place lies below it.
    last = next(k for k, c in enumerate(polynomial) if c)
    places = ROOT_BITS + max(0, abs(polynomial[last + 1]).bit_length() - abs(polynomial[last]).bit_length() + 1)
    roots = RealRoots(polynomial, places)
    found = roots.largest(min(count, dim), (trace + 1) << places, ROOT_BITS)
    jobs = spark.createDataFrame([(i, str(high), m) for i, (_, high, m) in enumerate(found)], "at int, root string, m int") \
        .repartition(max(1, len(found)), "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, root, m in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([null_vectors(matrix, int(root), places, m)])],
                                                 ["at", "vectors"])
    rows = {r["at"]: r["vectors"] for r in jobs.mapInArrow(run, "at int, vectors array<array<double>>").collect()}
    vectors = [v for at in sorted(rows) for v in rows[at]][:min(count, dim)]
    values = [(high, places) for _, high, m in found for _ in range(m)][:min(count, dim)]
    return values, np.array(vectors).reshape(-1, dim)


def _whitener(n: int, sums: list[int], vectors: np.ndarray, scales: np.ndarray):
    """(deviations, whitened rows) of a matrix of entries x - OFFSET; ``sums`` are of these entries."""
    reach = max([abs(s) for s in sums], default=0)

    def whiten(y: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        most = n * int(np.abs(y).max(initial=0)) + reach
        if most < 1 << 62:
            moved = n * y - np.array(sums, np.int64)
            exact = moved.astype(object) if most >= 1 << 31 or len(sums) * most * most >= 1 << 63 else moved
        else:
            exact = moved = n * y.astype(object) - np.array(sums, object)
        squares = [int(v) for v in (exact * exact).sum(1)] if len(y) else []
        centred = np.array(moved / n, dtype=np.float64).reshape(len(y), len(sums))
        return [v if v < 1 << 63 else None for v in squares], (centred @ vectors.T) * scales
    return whiten


def whiten(table: DataFrame, key: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = table.sparkSession
    x = F.col(embedding)
    finite = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    valid = table.where(finite).select(F.col(key).alias("vec_id"), x.cast("array<double>").alias("vec"))
    kind = dict(valid.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    common = valid.groupBy(F.size("vec").alias("dim")).count().where("dim > 0").orderBy(F.desc("count"), "dim").first()
    if common is None:
        return spark.createDataFrame([], schema)
    dim = common["dim"]
    rows = valid.where(F.size("vec") == dim)
    products = product_sums(rows, dim)
    n, sums = products[0, 0], [int(s) for s in products[0, 1:]]
    scatter = n * products[1:, 1:] - np.outer(products[0, 1:], products[0, 1:])
    values, vectors = eigen(spark, scatter, components)
    if not values:
        return spark.createDataFrame([], schema)
    trace, k = int(np.trace(scatter)), len(values)
    # An eigenvalue of the covariance is that of the scatter over n**2; big integers divide exactly to the nearest double.
    explained = np.array([value / (trace << bits) for value, bits in values])
    scales = np.array([math.sqrt((n * n << bits) / value) for value, bits in values])

    def moments(mean: np.ndarray | None):
        """Sums of the whitened rows, or of the products of the centred ones."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whiten_rows, total = _whitener(n, sums, vectors, scales), 0.0
            for batch in batches:
                w = whiten_rows(quantised(_matrix(batch.column(0), dim)))[1]
                total = total + (w.sum(0) if mean is None else (w - mean).T @ (w - mean))
            total = np.ravel(total if np.ndim(total) else np.zeros(k if mean is None else k * k))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["cell", "value"])
        cells = rows.select("vec").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
        return np.array([r["value"] for r in sorted(cells.collect(), key=lambda r: r["cell"])]) / n

    covariance = moments(moments(None)).reshape(k, k)
    error = float(np.abs(covariance - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whiten_rows = _whitener(n, sums, vectors, scales)
        for batch in batches:
            deviation, w = whiten_rows(quantised(_matrix(batch.column(1), dim)))
            size, each = len(w), np.repeat(np.arange(len(w)), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()),
                 pa.array(np.full(size * k, n), pa.int64()), pa.array(deviation, pa.int64()).take(pa.array(each)),
                 pa.array(np.ravel(w)), pa.array(np.tile(explained, size)), pa.array(np.full(size * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.select("vec_id", "vec").mapInArrow(run, schema)
