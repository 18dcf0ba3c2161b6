"""Whitening of embeddings by exact eigenvalues: integer scatter, characteristic polynomial, null spaces.

Entries become integers ``floor(64 * c)``; the scatter matrix of the distinct vectors is then an exact
integer matrix, summed by Spark. Its characteristic polynomial is computed modulo many primes (each
prime a row of a Spark job, by Hessenberg reduction) and put together by Chinese remaindering. All
roots of it are real, so sign changes of its shifted coefficients count the roots above a point: that
isolates the largest ones, and bisection carries them to more digits than a double holds. Inverse
iteration in fixed-point integers solves for the null space at each root: the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal
from fractions import Fraction
from math import comb, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierflow.session import materialize

SCALE, OFFSET = 64, 1_000_000
#: Entries beyond this can't become an integer with room for exact differences.
LARGEST = float(1 << 61)
#: Binary digits behind the point of roots, and of the arithmetic that finds their null spaces.
ROOT_BITS, WORK_BITS = 96, 256
WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def _packed(batch_column: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Rows with finite vectors: their places, their integer entries as the narrowest bytes, their lengths."""
    column = batch_column.combine_chunks() if isinstance(batch_column, pa.ChunkedArray) else batch_column
    flat = column.flatten()  # of the rows that aren't null
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0)
    rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    sizes = np.asarray(column.value_lengths().drop_null(), np.int64)
    ends = np.cumsum(sizes)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(SCALE * values)
        bad = ~(np.abs(scaled) <= LARGEST)  # nulls have become NaN
    wrong = np.r_[0, np.cumsum(bad)]
    ok = np.flatnonzero(wrong[ends] == wrong[ends - sizes])
    out = []
    for k in ok:
        v = scaled[ends[k] - sizes[k] : ends[k]].astype(np.int64)
        low, high = (int(v.min()), int(v.max())) if len(v) else (0, 0)
        kind = next(w for w in WIDTHS if np.iinfo(w).min <= low and high <= np.iinfo(w).max)
        out.append(v.astype(kind).tobytes())
    return rows[ok], out, sizes[ok]


def integer_vectors(embeddings: DataFrame, vector: str, *keep: str) -> DataFrame:
    """``keep``, ``x`` (packed integers) and ``d`` (entries) of the rows with a finite vector."""
    df = embeddings.select(*keep, F.col(vector).cast("array<double>").alias("__vector"))
    schema = T.StructType([*df.schema.fields[:-1], T.StructField("x", T.BinaryType()), T.StructField("d", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, packed, sizes = _packed(batch.column(len(keep)))
            kept = [c.take(pa.array(at)) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(packed, pa.binary()), pa.array(sizes, pa.int32())], names=schema.names)

    return df.mapInArrow(run, schema)


def unpacked(column: pa.Array, d: int) -> np.ndarray:
    """Packed rows of one length as a matrix of integers."""
    rows = column.to_pylist()
    out = np.empty((len(rows), d), np.int64)
    sizes = np.array([len(r) for r in rows])
    for kind in WIDTHS:
        some = np.flatnonzero(sizes == d * kind().itemsize)
        if len(some):
            out[some] = np.frombuffer(b"".join(rows[i] for i in some), kind).reshape(len(some), d)
    return out


def _exact_gram(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` without rounding: in doubles where these hold every sum, else in wider integers."""
    most = int(np.abs(y).max(initial=0)) ** 2 * len(y)
    if most < 1 << 53:
        z = y.astype(float)
        return (z.T @ z).astype(np.int64)
    return y.T @ y if most < 1 << 63 else y.astype(object).T @ y.astype(object)


def _summed(vectors: DataFrame, d: int, shift: list[int], squares: bool) -> dict[tuple[int, int], int]:
    """Exact sums over all rows of entries (row -1) or of products of entries, after taking off ``shift``.

    Each task sends one row for each sum; Spark adds them up.
    """
    lower = [(i, j) for i in range(d) for j in range(i + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, gram, n = np.zeros(d, object), np.zeros((d, d), object), 0
        for batch in batches:
            y = unpacked(batch.column(0), d) - np.array(shift, np.int64)
            n += len(y)
            first = first + (y.sum(axis=0) if int(np.abs(y).max(initial=0)) * len(y) < 1 << 62 else y.astype(object).sum(axis=0))
            if squares:
                gram = gram + _exact_gram(y)
        if n:
            found = [(-1, -1, n), *((-1, j, int(first[j])) for j in range(d))]
            found += [(i, j, int(gram[i, j])) for i, j in lower] if squares else []
            i, j, v = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(x) for x in v], pa.decimal128(38, 0))], names=["i", "j", "v"])

    parts = vectors.select("x").mapInArrow(run, "i int, j int, v decimal(38,0)")
    return {(r.i, r.j): int(r.v) for r in parts.groupBy("i", "j").agg(F.sum("v").cast("decimal(38,0)").alias("v")).collect()}


# -- the characteristic polynomial -------------------------------------------------


def _is_prime(n: int) -> bool:
    return n > 2 and n % 2 == 1 and all(n % q for q in range(3, isqrt(n) + 1, 2))


def primes_below(limit: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``limit``."""
    found, n = [], limit - 1
    while len(found) < count:
        if _is_prime(n):
            found.append(n)
        n -= 1
    return found


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, lowest first, of det(t I - matrix) modulo a prime below 2**31."""
    a = matrix % p
    d = len(a)
    for m in range(1, d - 1):  # to Hessenberg form by similarity
        below = np.flatnonzero(a[m:, m - 1])
        if not len(below):
            continue
        i = m + int(below[0])
        a[[i, m]] = a[[m, i]]
        a[:, [i, m]] = a[:, [m, i]]
        u = a[m + 1 :, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1 :] = (a[m + 1 :] - u[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1 :] * u % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(d):  # of the leading k + 1 rows and columns
        polys[k + 1, 1:] = polys[k, :-1]
        weight, below = np.zeros(k + 1, np.int64), 1
        for i in range(k, -1, -1):
            weight[i] = int(a[i, k]) * below % p
            below = below * int(a[i, i - 1]) % p if i else 0
        polys[k + 1] = (polys[k + 1] - (weight[:, None] * polys[: k + 1] % p).sum(axis=0)) % p
    return polys[d]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients, lowest first, of det(t I - matrix) for a symmetric matrix without negative roots."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # the k-th coefficient is at most C(d, k) (trace / d)^k in size
    bound = max(comb(d, k) * trace**k // d**k for k in range(d + 1)) + 1
    primes = primes_below(1 << 31, (2 * bound).bit_length() // 30 + 1)
    exact = np.array(matrix, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                made = polynomial_mod((exact % p).astype(np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([made.tolist()], pa.list_(pa.int64()))], names=["p", "residues"])

    tasks = max(1, min(len(primes), spark.sparkContext.defaultParallelism))
    table = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(tasks)
    residues = {r.p: r.residues for r in table.mapInArrow(run, "p bigint, residues array<bigint>").collect()}
    whole = 1
    for p in primes:
        whole *= p
    parts = [whole // p * pow(whole // p % p, -1, p) for p in primes]
    out = []
    for k in range(d + 1):
        c = sum(residues[p][k] * part for p, part in zip(primes, parts)) % whole
        out.append(c - whole if 2 * c > whole else c)
    return out


# -- roots ---------------------------------------------------------------------------


def roots_above(poly: list[int], a: int) -> int:
    """Roots greater than ``a`` of a polynomial whose roots are all real, with multiplicity: the sign
    changes among the coefficients of its shift by ``a`` (Descartes' rule is exact here)."""
    c = poly[::-1]  # highest first
    d = len(c) - 1
    for top in range(d, 0, -1):
        for k in range(1, top + 1):
            c[k] += a * c[k - 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(poly: list[int], a: int) -> int:
    value = 0
    for c in reversed(poly):
        value = value * a + c
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], upper: int, count: int, bits: int = ROOT_BITS) -> list[tuple[int, int]]:
    """``(root times 2**bits, multiplicity)`` of the largest roots, at least ``count`` with
    multiplicity where there are as many above 0. Roots nearer than 2**(1 - bits) count as one."""
    d = len(poly) - 1
    fine = [c << (bits * (d - k)) for k, c in enumerate(poly)]  # its roots are the roots times 2**bits
    high = upper << bits
    found, todo = [], [(0, high, roots_above(fine, 0), roots_above(fine, high))]
    while todo and sum(m for _, m in found) < count:
        low, high, n_low, n_high = todo.pop()  # the highest interval; roots lie in (low, high]
        if n_low == n_high:
            continue
        if n_low - n_high == 1 or high - low <= 2:
            while n_low - n_high == 1 and high - low > 1:  # one root: its side shows in the sign
                middle = (low + high) // 2
                sign = _sign(fine, middle) * (-1) ** n_high
                low, high = (low, middle) if sign >= 0 else (middle, high)
            found.append((high, n_low - n_high))
            continue
        middle = (low + high) // 2
        n = roots_above(fine, middle)
        todo += [(low, middle, n_low, n), (middle, high, n, n_high)]
    return found


# -- components ----------------------------------------------------------------------


def null_space(matrix: np.ndarray, root: int, size: int, bits: int = ROOT_BITS, work: int = WORK_BITS) -> np.ndarray:
    """``size`` orthonormal vectors that ``matrix`` times 1 minus ``root`` brings nearest to 0: inverse
    iteration on fixed-point integers of ``work`` binary digits behind the point."""
    d = len(matrix)
    a = matrix * (1 << work)
    for i in range(d):
        a[i, i] -= (root << (work - bits)) + (1 << (work - bits - 2))  # a little beside the root, so that it can be solved
    order = list(range(d))
    lower = np.zeros((d, d), object)
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(a[i, k]))
        a[[k, best]], lower[[k, best]] = a[[best, k]], lower[[best, k]]
        order[k], order[best] = order[best], order[k]
        pivot = a[k, k] or 1
        for i in range(k + 1, d):
            if a[i, k]:
                f = (a[i, k] << work) // pivot
                lower[i, k] = f
                a[i, k:] = a[i, k:] - ((f * a[k, k:]) >> work)
    random = np.random.default_rng(d)
    block = [[int(x) << (work - 20) for x in random.integers(-(1 << 20), 1 << 20, d)] for _ in range(size)]
    for _ in range(4):
        solved: list[np.ndarray] = []
        for b in block:
            y = np.array([b[i] for i in order], object)
            for i in range(d):
                y[i] -= int(np.dot(lower[i, :i], y[:i]) if i else 0) >> work
            for i in range(d - 1, -1, -1):
                rest = y[i] - (int(np.dot(a[i, i + 1 :], y[i + 1 :]) if i + 1 < d else 0) >> work)
                y[i] = (rest << work) // (a[i, i] or 1)
            for _ in range(2):
                for other in solved:
                    y = y - ((int(np.dot(y, other)) >> work) * other >> work)
                norm = isqrt(int(np.dot(y, y))) or 1
                y = np.array([(int(v) << work) // norm for v in y], object)
            solved.append(y)
        block = [list(v) for v in solved]
    out = np.array([[float(Fraction(int(v), 1 << work)) for v in b] for b in block])
    for v in out:  # one sign for all rows: the largest entry is positive
        v *= np.sign(v[np.argmax(np.abs(v))]) or 1.0
    return out


@dataclass(frozen=True)
class Whitening:
    """A fitted model: ``n`` distinct vectors of ``d`` integers, their exact sums less ``shift`` each,
    and for each component its eigenvalue, its share of the trace and its unit vector."""

    d: int
    n: int
    shift: list[int]
    sums: list[int]
    eigenvalues: list[float] = field(default_factory=list)
    explained: list[float] = field(default_factory=list)
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def whiten(self, x: np.ndarray) -> np.ndarray:
        if not len(self.eigenvalues):
            return np.zeros((len(x), 0))
        rest = np.array([s / self.n for s in self.sums])
        return ((x - np.array(self.shift, np.int64)).astype(float) - rest) @ self.vectors.T / np.sqrt(self.eigenvalues)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each row, exact; None where it doesn't fit into a long."""
        y = x - np.array(self.shift, np.int64)
        most = self.n * int(np.abs(y).max(initial=0)) + max((abs(s) for s in self.sums), default=0)
        if most * most * max(1, self.d) < 1 << 62:
            z = self.n * y - np.array(self.sums, np.int64)
            return (z * z).sum(axis=1).tolist()
        z = self.n * y.astype(object) - np.array(self.sums, object)
        return [v if v < 1 << 63 else None for v in map(int, (z * z).sum(axis=1))]


def fit(vectors: DataFrame, components: int = 16) -> Whitening | None:
    """The model of the distinct rows of ``integer_vectors``, or None without any.

    Vectors of the most frequent length are fitted (the longest of equally frequent ones). There
    are as many components as ``components`` and the rank of the scatter allow.
    """
    lengths = vectors.groupBy("d").count().where("d > 0").orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return None
    d = lengths[0]["d"]
    distinct = materialize(vectors.where(F.col("d") == d).select("x").distinct(), "distinct-vectors")
    plain = _summed(distinct, d, [0] * d, squares=False)
    n = plain[-1, -1]
    shift = [round(Fraction(plain[-1, j], n)) for j in range(d)]  # the nearest integers to the mean
    made = _summed(distinct, d, shift, squares=True)
    sums = [made[-1, j] for j in range(d)]
    scatter = [[n * made[max(i, j), min(i, j)] - sums[i] * sums[j] for j in range(d)] for i in range(d)]  # n^2 times the covariance
    trace = sum(scatter[i][i] for i in range(d))
    if not trace:
        return Whitening(d, n, shift, sums)
    poly = characteristic_polynomial(vectors.sparkSession, scatter)
    roots = largest_roots(poly, trace + 1, components)
    matrix, unit, values, rows = np.array(scatter, object), 1 << ROOT_BITS, [], []
    for root, size in roots:
        rows.append(null_space(matrix, root, size))
        values += [root] * size
    values, found = values[:components], np.concatenate(rows)[:components]
    exact = [Fraction(v, unit) for v in values]
    return Whitening(d, n, shift, sums, [float(v / n**2) for v in exact], [float(v / trace) for v in exact], found)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    k, d = len(model.eigenvalues), model.d
    cells = [(i, j) for i in range(k) for j in range(i + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, n = np.zeros(k), np.zeros((k, k)), 0
        for batch in batches:
            w = model.whiten(unpacked(batch.column(0), d))  # centred already
            first, second, n = first + w.sum(axis=0), second + w.T @ w, n + len(w)
        if n:
            found = [(-1, j, first[j]) for j in range(k)] + [(i, j, second[i, j]) for i, j in cells]
            i, j, v = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(v, pa.float64())], names=["i", "j", "v"])

    parts = vectors.where(F.col("d") == d).select("x").distinct().mapInArrow(run, "i int, j int, v double")
    got = {(r.i, r.j): r.v / model.n for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    return max((abs(got[i, j] - got[-1, i] * got[-1, j] - (i == j)) for i, j in cells), default=0.0)


def transform(vectors: DataFrame, model: Whitening, *keep: str) -> DataFrame:
    """``keep``, ``deviation`` and ``whitened`` (one double a component) of the rows of the model's length."""
    df = vectors.where(F.col("d") == model.d).select(*keep, F.col("x").alias("__x"))
    schema = T.StructType([*df.schema.fields[:-1], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column(len(keep)), model.d)
            w = model.whiten(x)
            ends = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
            lists = pa.ListArray.from_arrays(ends, pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(model.deviations(x), pa.int64()), lists], names=schema.names)

    return df.mapInArrow(run, schema)


def whitened(embeddings: DataFrame, vector: str = "embedding", ident: str = "vec_id", components: int = 16) -> DataFrame:
    """One row for each vector and component: its whitened coordinate, and the figures of the fit.

    Rows whose vector is null, or holds a null, a NaN, an infinity or an entry beyond 2**55, are left
    out, and so are rows whose vector has another length than the most frequent one (the longest of
    equally frequent ones) or none. Repeated rows and null ids each give rows; repeated vectors
    count once in the fit. Components with eigenvalue 0 (equal vectors, fewer vectors than
    dimensions) have no whitened coordinate and give no rows; an empty table gives none. A deviation
    beyond a long is null. Other columns of the table are not looked at.
    """
    kind = embeddings.schema[ident].dataType
    vectors = materialize(integer_vectors(embeddings, vector, ident), "vectors")
    model = fit(vectors, components)
    if model is None or not model.eigenvalues:
        return embeddings.sparkSession.createDataFrame([], T.StructType([
            T.StructField(ident, kind), *(T.StructField(c, T.IntegerType() if c == "component" else T.LongType() if c in ("n", "deviation") else T.DoubleType())
            for c in ("component", "n", "deviation", "whitened", "explained", "identity_error"))]))
    error = identity_error(vectors, model)
    rows = transform(vectors, model, ident)
    each = rows.select(ident, "deviation", F.posexplode("whitened").alias("place", "whitened"))
    explained = F.get(F.array(*map(F.lit, model.explained)), F.col("place"))
    return each.select(
        ident, (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(error).alias("identity_error"))
