"""Embedding whitening from the exact characteristic polynomial of the integer scatter.

Entries are quantised to integers, so the scatter matrix of the distinct vectors is an integer matrix
that Spark sums without rounding. Its characteristic polynomial is found modulo many primes (Hessenberg
reduction, one prime a row of a Spark job) and put together by Chinese remaindering. All its roots are
real, so the sign changes of the shifted coefficients count the roots beyond a point exactly; that
isolates the largest roots to 128 bits after the point, also where several coincide. Inverse
iteration in fixed point of 256 bits gives each root's null space.
"""
from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import comb, isqrt, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staffhouse.llm.common import stage

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
ROOT_BITS, SOLVE_BITS = 128, 256
LIMB, ROWS = 20, 4096           # 4,096 products of two 20-bit limbs add up exactly in a double
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def complete(vec: Column) -> Column:
    """Vectors that take part: not null, every entry present and finite."""
    return vec.isNotNull() & F.coalesce(F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def quantised(vectors: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """vec_id and y = floor(64 * c) of every entry; x is y + 1,000,000, a shift that leaves the covariance
    as it is. Shorter vectors are filled up with zeros, values beyond a long count as its ends."""
    y = F.transform(vec_col, lambda c: F.floor(c.cast("double") * SCALE))
    return vectors.select(F.col(id_col).alias("vec_id"), F.concat(y, F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size(vec_col))).alias("y"))


def _rows(batch: pa.RecordBatch, column: int, dim: int) -> Iterator[np.ndarray]:
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    for low in range(0, len(values), ROWS):
        yield values[low:low + ROWS]


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """y as the sum of limbs times 2^(20 k), every one within +-2^20."""
    out = []
    while ((y > 1 << LIMB) | (y < -1 << LIMB)).any():
        out.append((y & ((1 << LIMB) - 1)).astype(float))
        y = y >> LIMB
    return [*out, y.astype(float)]


def _sums(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Exact sums of y (j = -1) and of its products, as parts value * 2^e; (-1, -1) counts the rows."""
    product, total, n = {}, {}, 0
    for b in batches:
        for y in _rows(b, 0, dim):
            n += len(y)
            limbs = _limbs(y)
            for k, x in enumerate(limbs):
                total[LIMB * k] = total.get(LIMB * k, 0) + x.sum(axis=0).astype(np.int64)
                for m, z in enumerate(limbs):
                    p = (x.T @ z).astype(np.int64)
                    for e, part in ((LIMB * (k + m), p & ((1 << 30) - 1)), (LIMB * (k + m) + 30, p >> 30)):
                        product[e] = product.get(e, 0) + part
    if not n:
        return
    i, j = np.triu_indices(dim)
    rows = [(np.array([-1]), np.array([-1]), 0, np.array([n]))]
    rows += [(i, j, e, p[i, j]) for e, p in product.items()]
    rows += [(np.arange(dim), np.full(dim, -1), e, t) for e, t in total.items()]
    for a, c, e, v in rows:
        yield pa.record_batch([pa.array(a, pa.int32()), pa.array(c, pa.int32()), pa.array(np.full(len(v), e), pa.int32()), pa.array(v, pa.int64())], names=["i", "j", "e", "v"])


def scatter(fit: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums T of y and the integer matrix M = n * sum(y y') - T T' (n^2 times the covariance)."""
    parts = fit.mapInArrow(lambda it: _sums(it, dim), "i int, j int, e int, v long").groupBy("i", "j", "e").agg(F.sum("v").alias("v"))
    n, total, product = 0, [0] * dim, [[0] * dim for _ in range(dim)]
    for i, j, e, v in parts.collect():      # about dim^2 / 2 rows, whatever the table
        if i < 0:
            n += v
        elif j < 0:
            total[i] += v << e
        else:
            product[i][j] += v << e
    m = [[n * product[min(i, j)][max(i, j)] - total[i] * total[j] for j in range(dim)] for i in range(dim)]
    return n, total, m


def is_prime(n: int) -> bool:
    """Miller-Rabin; these bases are enough below 3 * 10^9."""
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bits: float) -> list[int]:
    """Primes below 2^31, largest first, whose product has more than ``bits`` bits."""
    out, p, have = [], (1 << 31) - 1, 0.0
    while have <= bits:
        if is_prime(p):
            out.append(p)
            have += log2(p)
        p -= 2
    return out


def polynomial_mod(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients (constant first) of det(x - m) modulo the prime p."""
    h, d = m.copy(), len(m)
    for k in range(d - 2):
        found = np.flatnonzero(h[k + 1:, k])
        if not len(found):
            continue
        i = k + 1 + found[0]
        if i != k + 1:
            h[[i, k + 1]] = h[[k + 1, i]]
            h[:, [i, k + 1]] = h[:, [k + 1, i]]
        f = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - f[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * f % p).sum(axis=1)) % p
    poly = np.zeros((d + 1, d + 1), np.int64)
    poly[0, 0] = 1
    for k in range(1, d + 1):
        row = np.zeros(d + 1, np.int64)
        row[1:] = poly[k - 1, :-1]
        row = (row - h[k - 1, k - 1] * poly[k - 1]) % p
        below = 1
        for i in range(1, k):
            below = below * int(h[k - i, k - i - 1]) % p
            if not below:
                break
            row = (row - int(h[k - i - 1, k - 1]) * below % p * poly[k - i - 1]) % p
        poly[k] = row
    return poly[d]


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Integer coefficients (constant first) of det(x - M) for a positive semidefinite integer M.

    Its k-th elementary symmetric function of eigenvalues is at most C(d, k) * (trace / d)^k, which
    says how many primes are enough."""
    d, trace = len(m), sum(m[i][i] for i in range(len(m)))
    mean = log2(max(trace / d, 1))
    primes = primes_for(2 + max(log2(comb(d, k)) + k * mean for k in range(d + 1)))
    shared = spark.sparkContext.broadcast((m, primes))       # dim^2 numbers

    def run(batches):
        m, primes = shared.value
        for b in batches:
            for k in b.column(0).to_pylist():
                p = primes[k]
                c = polynomial_mod(np.array([[x % p for x in row] for row in m], np.int64), p)
                yield pa.record_batch([pa.array([k]), pa.array([c.tolist()], pa.list_(pa.int64()))], names=["k", "c"])

    slices = min(len(primes), spark.sparkContext.defaultParallelism)
    rows = sorted(spark.range(0, len(primes), 1, slices).mapInArrow(run, "k long, c array<long>").collect())
    whole = 1
    for p in primes:
        whole *= p
    weights = [whole // p * pow(whole // p, -1, p) for p in primes]
    out = []
    for i in range(d + 1):
        c = sum(r.c[i] * w for r, w in zip(rows, weights)) % whole
        out.append(c - whole if c > whole // 2 else c)
    return out


def roots_above(poly: list[int], t: int) -> int:
    """How many roots, with multiplicity, of a polynomial with real roots only are larger than t: the sign
    changes of its coefficients after shifting it by t (Descartes' rule is exact for such)."""
    c = list(poly)
    d = len(c) - 1
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += t * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(poly: list[int], t: int) -> int:
    v = 0
    for c in reversed(poly):
        v = v * t + c
    return (v > 0) - (v < 0)


def largest_roots(poly: list[int], count: int, bits: int = ROOT_BITS) -> list[tuple[int, int]]:
    """The ``count`` largest positive roots, fewer if there are not so many, falling: (root * 2^bits
    rounded up, multiplicity)."""
    d = len(poly) - 1
    poly = [c << (bits * (d - i)) for i, c in enumerate(poly)]      # roots times 2^bits
    top = max(0, -poly[d - 1]) + 1
    todo, out, found = [(0, top, roots_above(poly, 0), 0)], [], 0
    while todo and found < count:
        low, high, above_low, above_high = todo.pop()
        n = above_low - above_high
        if n == 0:
            continue
        if n == 1 and (end := _sign(poly, high)):
            while high - low > 1:
                mid = (low + high) // 2
                s = _sign(poly, mid)
                low, high = (low, mid) if s == end or s == 0 else (mid, high)
                if s == 0:
                    break
        if n == 1 or high - low == 1:
            out.append((high, n))
            found += n
            continue
        mid = (low + high) // 2
        above = roots_above(poly, mid)
        todo += [(low, mid, above_low, above), (mid, high, above, above_high)]
    return out


def null_space(m: list[list[int]], root: int, multiplicity: int, bits: int = ROOT_BITS) -> list[list[float]]:
    """Orthonormal eigenvectors of M for one root by inverse iteration in fixed point."""
    d, f = len(m), SOLVE_BITS
    a = np.array(m, dtype=object) << f
    for i in range(d):
        a[i, i] -= root << (f - bits)
    order = np.arange(d)
    for k in range(d):
        p = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        a[[k, p]], order[[k, p]] = a[[p, k]], order[[p, k]]
        a[k, k] = a[k, k] or 1          # one unit in the last place
        if k + 1 < d:
            by = (a[k + 1:, k] << f) // a[k, k]
            a[k + 1:, k + 1:] -= (by[:, None] * a[k, k + 1:]) >> f
            a[k + 1:, k] = by

    def solve(b: np.ndarray) -> np.ndarray:
        z = b[order]
        for k in range(d):
            z[k + 1:] -= (a[k + 1:, k] * z[k]) >> f
        for k in reversed(range(d)):
            z[k] = (z[k] << f) // a[k, k]
            z[:k] -= (a[:k, k] * z[k]) >> f
        return z

    def unit(vectors: list[np.ndarray]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for v in vectors:
            for _ in range(2):
                v = (v << f) // (isqrt(int((v * v).sum())) or 1)
                for u in out:
                    v = v - ((u * ((u * v).sum() >> f)) >> f)
            out.append((v << f) // (isqrt(int((v * v).sum())) or 1))
        return out

    rng = np.random.default_rng(13)
    basis = unit([np.array([int(x) << (f - 30) for x in rng.integers(-1 << 30, 1 << 30, d)], dtype=object) for _ in range(multiplicity)])
    for _ in range(3):
        basis = unit([solve(v) for v in basis])
    out = []
    for v in basis:
        sign = 1 if max(v, key=abs) > 0 else -1
        out.append([sign * int(x) / (1 << f) for x in v])
    return out


def components(spark: SparkSession, m: list[list[int]], count: int = COMPONENTS) -> tuple[list[Fraction], np.ndarray]:
    """The largest eigenvalues of M (exact to 2^-128) and their unit eigenvectors as rows; at most
    ``count``, positive ones only."""
    roots = largest_roots(characteristic_polynomial(spark, m), count)
    shared = spark.sparkContext.broadcast((m, roots))

    def run(batches):
        m, roots = shared.value
        for b in batches:
            for k in b.column(0).to_pylist():
                yield pa.record_batch([pa.array([k]), pa.array([null_space(m, *roots[k])], pa.list_(pa.list_(pa.float64())))], names=["k", "v"])

    if not roots:
        return [], np.empty((0, len(m)))
    rows = sorted(spark.range(0, len(roots), 1, min(len(roots), spark.sparkContext.defaultParallelism)).mapInArrow(run, "k long, v array<array<double>>").collect())
    values = [Fraction(r, 1 << ROOT_BITS) for r, n in roots for _ in range(n)]
    return values[:count], np.array([v for r in rows for v in r.v])[:count]


def _centred(y: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """n * y - T, exact: longs where they hold it, else Python integers."""
    if not len(y) or n * max(abs(int(y.min())), abs(int(y.max()))) + max(map(abs, map(int, total))) < 1 << 62:
        return y * n - total.astype(np.int64)
    return y.astype(object) * n - total


def _projected(z: np.ndarray, directions: np.ndarray) -> np.ndarray:
    return z.astype(float) @ directions


def _moments(batches, n, total, directions, dim):
    k = directions.shape[1]
    first, second = np.zeros(k), np.zeros((k, k))
    for b in batches:
        for y in _rows(b, 0, dim):
            w = _projected(_centred(y, n, total), directions)
            first += w.sum(axis=0)
            second += w.T @ w
    i, j = np.indices((k, k)).reshape(2, -1)
    yield pa.record_batch([pa.array([*i, *range(k)], pa.int32()), pa.array([*j, *[-1] * k], pa.int32()), pa.array([*second.ravel(), *first])], names=["i", "j", "v"])


def _whiten(batches, n, total, directions, explained, error, dim):
    k = directions.shape[1]
    for b in batches:
        at = 0
        for y in _rows(b, 1, dim):
            z = _centred(y, n, total)
            if z.dtype == object or len(z) and int(np.abs(z).max()) ** 2 * dim >= 1 << 63:
                exact = [sum(int(x) ** 2 for x in row) for row in z]
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            else:
                deviation = pa.array((z * z).sum(axis=1), pa.int64())
            each, m = np.repeat(np.arange(len(z)), k), len(z) * k
            yield pa.record_batch([
                b.column(0).slice(at, len(z)).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(z))), pa.array(np.full(m, n)),
                deviation.take(pa.array(each)), pa.array(_projected(z, directions).ravel()), pa.array(np.tile(explained, len(z))), pa.array(np.full(m, error))],
                names=[c.split()[0] for c in RESULT.split(", ")])
            at += len(z)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1, by falling eigenvalue), n (distinct quantised vectors), deviation, whitened,
    explained, identity_error, for every row whose vector is complete and each of its first ``count``
    components. The covariance is over the distinct quantised vectors, each once.

    Rows with a null vector, or a null or non-finite entry, are left out; repeated rows and null ids
    give their rows each. Shorter vectors (empty ones too) count as filled up with zeros. Components
    of eigenvalue zero cannot be whitened and give no rows, so equal vectors alone, or an empty table,
    give none. A deviation beyond a long is null. Equal eigenvalues get one orthonormal basis of
    their space. Extra columns are ignored."""
    spark = vectors.sparkSession
    taken = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec")).filter(complete(F.col("vec")))
    dim = taken.agg(F.max(F.size("vec"))).first()[0]
    if not dim:
        return spark.createDataFrame([], RESULT)
    rows = quantised(taken, "vec_id", "vec", dim)
    fit = stage(rows.select("y").distinct(), "op13_fit")
    n, total, m = scatter(fit, dim)
    values, basis = components(spark, m, count)
    if not values:
        return spark.createDataFrame([], RESULT)
    trace = sum(m[i][i] for i in range(dim))
    explained = np.array([float(v / trace) for v in values])
    directions = basis.T / np.array([sqrt(v) for v in values])       # (n y - T) . v / sqrt(n^2 e)
    total = np.array(total, dtype=object)
    moments = fit.mapInArrow(lambda it: _moments(it, n, total, directions, dim), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    k = len(values)
    first, second = np.zeros(k), np.zeros((k, k))
    for i, j, v in moments.collect():       # count^2 rows
        if j < 0:
            first[i] = v / n
        else:
            second[i, j] = v / n
    error = float(np.abs(second - np.outer(first, first) - np.eye(k)).max())
    return rows.mapInArrow(lambda it: _whiten(it, n, total, directions, explained, error, dim), RESULT)
