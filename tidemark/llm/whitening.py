"""Whitening of embeddings by exact linear algebra.

Entries become whole numbers, so the scatter of the distinct vectors is a matrix of integers that Spark sums without
rounding. Its characteristic polynomial is computed exactly: modulo many primes by reduction to Hessenberg form, one batch
of primes a task, and put together by Chinese remaindering. All its roots are real, so Descartes' rule counts the roots
above any number; bisection isolates the largest ones and refines each to RESOLUTION bits. A component is the null space
of scatter minus root, by inverse iteration in fixed-point arithmetic of the same precision, one root a task.

What reaches the driver depends on the dimension only: the sums of a matrix, coefficients, roots and components.

Defined results: rows whose vector is null or holds a null, non-finite or huge entry (64 times it is 2**62 or more) are left
out. The dimension is the commonest length among distinct vectors (ties: the longer); vectors of another length are left
out too. Repeated vectors count once in the fit and each give their rows. Components without variance do not exist: a
table without two distinct vectors gives no rows. Equal eigenvalues give some orthonormal basis of their space.
A null key is kept; other columns of the table are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

#: Entries are floor(SCALE * c) + ORIGIN. The origin cancels in everything but the vectors themselves.
SCALE, ORIGIN = 64, 1_000_000
#: Bits of a root below the trace of the scatter, and further bits that elimination carries.
RESOLUTION, GUARD = 224, 160
#: Primes of one task.
PRIMES = 16
ROWS = 2_000
_LIMB, _EXACT = 21, 1 << 53


@dataclass(frozen=True)
class Whitening:
    """A fitted transform. `sums` are of floor(64 c) over the n distinct vectors; `roots` are eigenvalues of n**2 times their covariance."""

    n: int
    dimension: int
    sums: tuple[int, ...]
    trace: int
    roots: tuple[Fraction, ...]
    components: np.ndarray
    identity_error: float

    @property
    def eigenvalues(self) -> list[float]:
        return [float(r / self.n**2) for r in self.roots]

    @property
    def explained(self) -> list[float]:
        return [float(r / self.trace) for r in self.roots]

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened coordinates [row, component] of rows floor(64 c)."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return ((y - whole).astype(float) - rest) @ (self.components / np.sqrt(self.eigenvalues)[:, None]).T

    def deviations(self, y: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)**2 for every row, exact."""
        total = sum(s * s for s in self.sums)
        if len(y) and max(abs(int(y.max())), abs(int(y.min()))) >= 1 << 26:
            rows = y.astype(object)
            squares, cross = (rows * rows).sum(1).tolist(), (rows * np.array(self.sums, object)).sum(1).tolist()
        else:
            parts, rest = [], np.array(self.sums, object)
            while any(rest):  # limbs small enough for whole-number arithmetic of 64 bits
                parts.append((rest % (1 << 24)).astype(np.int64))
                rest = rest // (1 << 24) if min(rest) >= 0 else np.array([v // (1 << 24) for v in rest], object)
                if all(v in (0, -1) for v in rest):
                    break
            squares = (y * y).sum(1).tolist()
            products = [(y @ p).tolist() for p in parts] + [(y @ np.array([int(v) for v in rest], np.int64)).tolist()]
            cross = [sum(v << (24 * k) for k, v in enumerate(row)) for row in zip(*products, strict=True)]
        n = self.n
        return [n * n * q - 2 * n * c + total for q, c in zip(squares, cross, strict=True)]


# --- whole-number vectors ---

def _whole_numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows kept, offsets of their entries, entries floor(64 c)) of an Arrow column of lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    lists = column.take(pa.array(rows))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(lists).cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(flat * SCALE)
        bad = ~(np.abs(scaled) < 2.0**62)
    at = np.concatenate([[0], np.cumsum(sizes)])
    faults = np.concatenate([[0], np.cumsum(bad)])
    good = faults[at[1:]] == faults[at[:-1]]
    entries = scaled[np.repeat(good, sizes)].astype(np.int64)
    return rows[good], np.concatenate([[0], np.cumsum(sizes[good])]), entries


def _distinct_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Each vector of whole numbers once, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), ROWS):
                _, at, entries = _whole_numbers(batch.column(0).slice(begin, ROWS))
                packed = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * 8).astype(np.int32)), pa.py_buffer(entries)])
                yield pa.RecordBatch.from_arrays([packed.unique()], ["y"])

    return df.select(vector).mapInArrow(run, "y binary").distinct()


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for begin in range(0, len(batch), ROWS):
            cells = batch.column(0).slice(begin, ROWS).to_pylist()
            if cells:
                yield np.frombuffer(b"".join(cells), np.int64).reshape(len(cells), width)


def exact_gram(y: np.ndarray) -> np.ndarray:
    """y.T @ y as Python integers, through float products that stay exact."""
    most = max(abs(int(y.max())), abs(int(y.min())), 1)
    if most < 1 << 26:
        limbs, step = [y], max(1, _EXACT // (most * most))
    else:
        limbs, step = [y & ((1 << _LIMB) - 1), (y >> _LIMB) & ((1 << _LIMB) - 1), y >> (2 * _LIMB)], _EXACT >> (2 * _LIMB + 2)
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for begin in range(0, len(y), step):
        parts = [x[begin : begin + step].astype(float) for x in limbs]
        for a, left in enumerate(parts):
            for b, right in enumerate(parts):
                total += (left.T @ right).astype(np.int64).astype(object) * (1 << (_LIMB * (a + b)))
    return total


def _moments(fit: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """Number, sums and products of the vectors. Tasks send one row per pair of dimensions; Spark adds them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, gram = 0, np.zeros(width, object), np.zeros((width, width), object)
        for y in _matrices(batches, width):
            n += len(y)
            sums += np.array([int(v) for v in (y & 0xFFFFFFFF).sum(0)], object) + np.array([int(v) << 32 for v in (y >> 32).sum(0)], object)
            gram += exact_gram(y)
        if n:
            cells = [(-1, -1, n), *((-1, j, sums[j]) for j in range(width)), *((i, j, gram[i, j]) for i in range(width) for j in range(i, width))]
            high, low = [Decimal(v >> 64) for _, _, v in cells], [Decimal(v & (1 << 64) - 1) for _, _, v in cells]
            exact = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()), pa.array(high, exact), pa.array(low, exact)], ["i", "j", "high", "low"])

    partial = fit.mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    found = {(r["i"], r["j"]): (int(r["high"]) << 64) + int(r["low"]) for r in partial.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}
    return found[-1, -1], [found[-1, j] for j in range(width)], [[found[min(i, j), max(i, j)] for j in range(width)] for i in range(width)]


# --- the characteristic polynomial ---

def _is_prime(n: int) -> bool:
    odd, twos = n - 1, 0
    while not odd % 2:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):  # enough below 3.2e9
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bits: int) -> list[int]:
    """The greatest primes below 2**31 whose product has more than `bits` bits."""
    found, product, n = [], 1, (1 << 31) - 1
    while product.bit_length() <= bits:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def charpoly_modulo(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients [prime, power] of det(x I - matrix) modulo each prime."""
    d, p = len(matrix), np.array(primes, np.int64)
    h = np.array([[[v % q for v in row] for row in matrix] for q in primes], np.int64).reshape(len(p), d, d)
    each, m1, m2 = np.arange(len(p)), p[:, None], p[:, None, None]
    for k in range(d - 2):  # to Hessenberg form by similarity
        pivot = k + 1 + np.argmax(h[:, k + 1 :, k] != 0, axis=1)
        rows = h[each, pivot].copy()
        h[each, pivot], h[:, k + 1] = h[:, k + 1].copy(), rows
        columns = h[each, :, pivot].copy()
        h[each, :, pivot], h[:, :, k + 1] = h[:, :, k + 1].copy(), columns
        inverse = np.array([pow(int(v), -1, int(q)) if v else 0 for v, q in zip(h[:, k + 1, k], p, strict=True)], np.int64)
        factor = h[:, k + 2 :, k] * inverse[:, None] % m1
        h[:, k + 2 :] = (h[:, k + 2 :] - factor[:, :, None] * h[:, None, k + 1] % m2) % m2
        h[:, :, k + 1] = (h[:, :, k + 1] + (h[:, :, k + 2 :] * factor[:, None, :] % m2).sum(2)) % m1
    poly = np.zeros((len(p), d + 1, d + 1), np.int64)  # poly[:, k]: of the leading k rows and columns
    poly[:, 0, 0] = 1
    for k in range(d):
        poly[:, k + 1, 1:] = poly[:, k, :-1]
        poly[:, k + 1] -= h[:, k, k, None] * poly[:, k] % m1
        chain = np.ones(len(p), np.int64)
        for i in range(k - 1, -1, -1):
            chain = chain * h[:, i + 1, i] % p
            poly[:, k + 1] -= (chain * h[:, i, k] % p)[:, None] * poly[:, i] % m1
        poly[:, k + 1] %= m1
    return poly[:, d]


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x I - matrix), lowest power first, for a positive semidefinite matrix of integers.

    Its coefficients alternate in sign, and by Maclaurin's inequality no one exceeds its binomial times a power of the mean root."""
    d = len(matrix)
    mean = -(-sum(matrix[i][i] for i in range(d)) // d) + 1
    primes = primes_for(max((math.comb(d, k) * mean**k).bit_length() for k in range(d + 1)))
    groups = [primes[k : k + PRIMES] for k in range(0, len(primes), PRIMES)]

    def run(frames):
        for frame in frames:
            for group in frame["primes"]:
                own = [int(q) for q in group]
                for q, row in zip(own, charpoly_modulo(matrix, own).tolist(), strict=True):
                    yield pa.RecordBatch.from_pydict({"prime": [q], "residues": [row]}).to_pandas()

    tasks = spark.createDataFrame([(g,) for g in groups], "primes array<long>").repartition(len(groups))
    found = tasks.mapInPandas(run, "prime long, residues array<long>").collect()
    total = math.prod(primes)
    shares = [total // r["prime"] * pow(total // r["prime"], -1, r["prime"]) for r in found]
    sizes = [sum(share * ((-1) ** (d - k) * r["residues"][k]) for share, r in zip(shares, found, strict=True)) % total for k in range(d + 1)]
    return [(-1) ** (d - k) * size for k, size in enumerate(sizes)]


# --- its roots ---

def _scaled(poly: list[int], bits: int) -> list[int]:
    d = len(poly) - 1
    return [c << (bits * (d - k)) for k, c in enumerate(poly)]


def roots_above(poly: list[int], at: int) -> int:
    """Roots greater than `at`, with multiplicity, of a polynomial with real roots only: sign changes of poly(x + at)."""
    c = list(poly)
    for k in range(len(c) - 1):
        for i in range(len(c) - 2, k - 1, -1):
            c[i] += at * c[i + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(poly: list[int], at: int) -> int:
    value = 0
    for c in reversed(poly):
        value = value * at + c
    return (value > 0) - (value < 0)


def isolate_roots(poly: list[int], wanted: int, bits: int) -> list[tuple[int, int, int]]:
    """(low, high, number) of the largest positive roots, times 2**bits, each in (low, high]; largest first.

    Intervals hold one root, or several that agree to the last bit. At least `wanted` roots if there are so many."""
    scaled = _scaled(poly, bits)
    top = (-poly[-2] << bits) + 1
    found, have, stack = [], 0, [(0, top, roots_above(scaled, 0), 0)]
    while stack and have < wanted:
        low, high, above, over = stack.pop()  # `above` roots exceed low, `over` of them exceed high
        if above == over:
            continue
        if above - over == 1 or high - low == 1:
            found.append((low, high, above - over))
            have += above - over
            continue
        middle = (low + high) // 2
        count = roots_above(scaled, middle)
        stack += [(low, middle, above, count), (middle, high, count, over)]
    return found


def refine(poly: list[int], low: int, high: int, bits: int) -> int:
    """The least whole number, times 2**-bits, that the only root in (low, high] does not exceed."""
    scaled = _scaled(poly, bits)
    beyond = _sign(scaled, high)
    if not beyond:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        sign = _sign(scaled, middle)
        if not sign:
            return middle
        low, high = (low, middle) if sign == beyond else (middle, high)
    return high


# --- components ---

def null_space(matrix: list[list[int]], root: int, number: int, bits: int) -> list[list[float]]:
    """`number` orthonormal vectors that span the space nearest the null space of matrix - root / 2**bits.

    Inverse iteration with one factorisation, in fixed-point arithmetic."""
    d, guard = len(matrix), GUARD
    unit = RESOLUTION + 2 * guard
    a = np.array([[(v << bits) - (root if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(matrix)], object).reshape(d, d) * (1 << guard)
    order = list(range(d))
    for k in range(d):
        best = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if best != k:
            a[[k, best]] = a[[best, k]]
            order[k], order[best] = order[best], order[k]
        a[k, k] = a[k, k] or 1
        if k + 1 < d:
            factor = np.array([(v << unit) // a[k, k] for v in a[k + 1 :, k]], object)
            a[k + 1 :, k + 1 :] -= np.outer(factor, a[k, k + 1 :]) >> unit
            a[k + 1 :, k] = factor
    seed = np.random.Generator(np.random.PCG64(20240611))
    space = [np.array([int(v) << (unit - 40) for v in seed.integers(-(1 << 39), 1 << 39, d)], object) for _ in range(number)]
    for _ in range(3):
        after = []
        for x in space:
            x = x[order].copy()
            for k in range(1, d):
                x[k] -= int((a[k, :k] * x[:k]).sum()) >> unit
            for k in range(d - 1, -1, -1):
                x[k] = ((int(x[k]) << unit) - int((a[k, k + 1 :] * x[k + 1 :]).sum())) // a[k, k]
            most = max(abs(v) for v in x)
            x = np.array([(v << unit) // most for v in x], object)
            for other in after:
                x = x - (other * ((int((x * other).sum())) >> unit) >> unit)
            length = math.isqrt(int((x * x).sum()))
            after.append(np.array([(v << unit) // length for v in x], object))
        space = after
    out = []
    for x in space:
        largest = max(range(d), key=lambda i: abs(x[i]))
        turn = -1 if x[largest] < 0 else 1
        out.append([float(Fraction(turn * int(v), 1 << unit)) for v in x])
    return out


def principal_components(spark, matrix: list[list[int]], wanted: int) -> tuple[list[Fraction], np.ndarray]:
    """The largest positive eigenvalues of a positive semidefinite matrix of integers and unit eigenvectors, largest first."""
    poly = characteristic_polynomial(spark, matrix)
    bits = max(0, RESOLUTION - poly[-2].bit_length())
    spans = isolate_roots(poly, wanted, bits)

    def run(frames):
        for frame in frames:
            for k, low, high, number in frame.itertuples(index=False):
                root = refine(poly, int(low), int(high), bits) if number == 1 else int(high)
                vectors = null_space(matrix, root, number, bits)
                yield pa.RecordBatch.from_pydict({"k": [k] * number, "root": [str(root)] * number, "vector": vectors}).to_pandas()

    if not spans:
        return [], np.zeros((0, len(matrix)))
    tasks = spark.createDataFrame([(k, str(low), str(high), number) for k, (low, high, number) in enumerate(spans)], "k int, low string, high string, number int").repartition(len(spans), "k")
    found = sorted(tasks.mapInPandas(run, "k int, root string, vector array<double>").collect(), key=lambda r: r["k"])[:wanted]
    return [Fraction(int(r["root"]), 1 << bits) for r in found], np.array([r["vector"] for r in found])


# --- the operator ---

def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened covariance minus the identity, over the fit list."""
    k = len(model.roots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for y in _matrices(batches, model.dimension):
            w = np.hstack([np.ones((len(y), 1)), model.project(y)])
            total += w.T @ w
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "v"])

    sums = {(r["i"], r["j"]): r["v"] / model.n for r in fit.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    return max(abs(sums[i, j] - sums[0, i] * sums[0, j] - (i == j)) for i in range(1, k + 1) for j in range(i, k + 1))


def fit_whitening(df: DataFrame, vector: str = "embedding", components: int = 16) -> Whitening | None:
    """Fit on every distinct vector of the table; None where there is no variance."""
    fit = materialize(_distinct_vectors(df, vector), "vectors")
    sizes = fit.groupBy(F.octet_length("y").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if sizes is None or not sizes["size"]:
        return None
    width = sizes["size"] // 8
    fit = fit.where(F.octet_length("y") == sizes["size"])
    n, sums, gram = _moments(fit, width)
    scatter = [[n * gram[i][j] - sums[i] * sums[j] for j in range(width)] for i in range(width)]
    trace = sum(scatter[i][i] for i in range(width))
    if not trace:
        return None
    roots, vectors = principal_components(df.sparkSession, scatter, min(components, width))
    model = Whitening(n, width, tuple(sums), trace, tuple(roots), vectors, 0.0)
    return Whitening(n, width, tuple(sums), trace, tuple(roots), vectors, _identity_error(fit, model))


def whiten(df: DataFrame, model: Whitening | None, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per vector and component: the key, component (from 1), n, deviation, whitened, explained, identity_error.

    deviation is the sum over dimensions of (n x - S)**2, exact, as DECIMAL(38, 0); NULL beyond 38 digits."""
    kind = dict(df.dtypes)[key]
    fields = f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None:
        return df.sparkSession.createDataFrame([], fields)
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few numbers per dimension and component

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        k, explained = len(fitted.roots), np.array(fitted.explained)
        for whole in batches:
            for begin in range(0, len(whole), ROWS):
                batch = whole.slice(begin, ROWS)
                rows, at, entries = _whole_numbers(batch.column(1))
                own = np.diff(at) == fitted.dimension
                y = entries[np.repeat(own, np.diff(at))].reshape(-1, fitted.dimension)
                m = len(y)
                deviation = pa.array([Decimal(v) if v < 10**38 else None for v in fitted.deviations(y)], pa.decimal128(38, 0))
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows[own])).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, fitted.n)),
                    deviation.take(each), pa.array(fitted.project(y).reshape(-1)), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, fitted.identity_error)),
                ], [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return df.select(key, vector).mapInArrow(run, fields)
