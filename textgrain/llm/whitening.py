"""Whitening of vectors by the exact characteristic polynomial of their integer scatter.

**Fit.**  A component ``c`` becomes the integer ``x = floor(1024 * c) + 100000``.  Counts, sums
and products are added up exactly, so the scatter ``M = n * sum(x x') - S S'``, which is
``n ** 2`` times the covariance, is an integer matrix.

1. ``det(z - M)`` is found modulo primes below 2 ** 31: a Hessenberg form by elimination, then
   the recurrence over its leading minors.  The primes are dealt over tasks; as many are taken
   as the bound on the coefficients of a positive matrix asks for, so Chinese remaindering
   gives the integer polynomial itself.
2. All its roots are real, so the sign changes of the shifted polynomial count the roots above
   a point exactly.  Bisection with integers isolates each wanted root to ``ROOT_BITS`` bits.
3. A component spans the null space of ``M - root``: inverse iteration with ``DIGITS`` decimal
   digits; equal roots are iterated together and kept orthogonal.

Only the sums (one row per pair of dimensions) come to the driver, never vectors.

**Rows.**  Each vector is centred in integers, ``n * x - S``, projected on the components and
divided by the roots of the eigenvalues.  A component's largest entry is positive.

Cases: vectors that are null or hold a null or non-finite entry take no part, nor do vectors
whose length is not the most frequent one (the larger of equally frequent ones).  Repeated
rows count each time; ids may be null.  ``floor`` saturates at the range of a long; a deviation
beyond it is null.  With fewer dimensions than components wanted, all are returned.  A
component without variance has ``whitened`` 0 and ``explained`` 0 and is left out of
``identity_error``, which is 0 if no component has variance.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
ROOT_BITS = 140
DIGITS = 120
# Products of entries below this are added exactly in double precision, so many rows at a time.
SMALL_ENTRY, EXACT_ROWS = 1 << 20, 1 << 12
LIMB = 44
PRIMES_PER_TASK = 16


@dataclass
class Whitening:
    """A fitted transform: ``vectors[k]`` is the unit component of ``eigenvalues[k]``."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float


def finite_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, vec)`` of the rows that take part."""
    largest = float(np.finfo(np.float64).max)
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= largest))
    kept = rows.select(F.col(key).alias("id"), values.alias("vec")).filter(F.col("vec").isNotNull() & F.coalesce(fine, F.lit(False)))
    length = kept.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return kept.filter(F.size("vec") == (length["n"] if length else 0))


def entries(column: pa.Array) -> np.ndarray:
    """``floor(1024 * c)`` of every component, one row per vector."""
    flat = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    with np.errstate(over="ignore"):
        low = np.floor(flat * SCALE)
    limit = float(2**63)
    out = np.where(np.abs(low) < limit, low, 0).astype(np.int64)
    if (np.abs(low) >= limit).any():
        out[low >= limit] = 2**63 - 1 - SHIFT
        out[low <= -limit] = -(2**63)
    return out


def gram(y: np.ndarray) -> list[list[int]]:
    """Exact products ``y' y``."""
    width = y.shape[1]
    if len(y) and np.abs(y).max() >= SMALL_ENTRY or len(y) and y.min() == -(2**63):
        wide = y.astype(object)
        return (wide.T @ wide).tolist()
    total = np.zeros((width, width), np.int64)
    for low in range(0, len(y), EXACT_ROWS):
        part = y[low : low + EXACT_ROWS].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total.tolist()


def exact_sums(vectors: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """``(n, sums, products)`` of the entries of all vectors."""
    upper = [(i, j) for i in range(width) for j in range(i, width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (1 + width + len(upper))
        for batch in batches:
            y = entries(batch.column(0))
            if not len(y):
                continue
            products = gram(y)
            sums = y.astype(object).sum(0) if np.abs(y).max() >= 1 << 40 else y.sum(0).tolist()
            own = [len(y), *sums, *(products[i][j] for i, j in upper)]
            total = [a + int(b) for a, b in zip(total, own)]
        mask = (1 << LIMB) - 1
        limbs = [[v >> (2 * LIMB), (v >> LIMB) & mask, v & mask] for v in total]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), *(pa.array([x[k] for x in limbs], pa.int64()) for k in range(3))], ["slot", "a", "b", "c"]
        )

    parts = vectors.select("vec").mapInArrow(run, "slot int, a bigint, b bigint, c bigint")
    sums = parts.groupBy("slot").agg(*[F.sum(F.col(k).cast("decimal(38,0)")).alias(k) for k in "abc"])
    found = [0] * (1 + width + len(upper))
    # One row per pair of dimensions.
    for row in sums.collect():
        found[row["slot"]] = (int(row["a"]) << (2 * LIMB)) + (int(row["b"]) << LIMB) + int(row["c"])
    products = [[0] * width for _ in range(width)]
    for (i, j), value in zip(upper, found[1 + width :]):
        products[i][j] = products[j][i] = value
    return found[0], found[1 : 1 + width], products


# --- the polynomial ---------------------------------------------------------------


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 2 ** 32."""
    if n < 2 or n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 7, 61):
        x = pow(base, odd, n)
        if base % n == 0 or x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2 ** 31 whose product is larger than ``bound``."""
    found, product, at = [], 1, 2**31 - 1
    while product <= bound:
        if is_prime(at):
            found.append(at)
            product *= at
        at -= 2
    return found


def modular_polynomials(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients of ``det(z - matrix)`` from the constant on, modulo each prime."""
    p = np.array(primes, np.int64)
    size = len(matrix)
    a = np.array([[[v % q for v in row] for row in matrix] for q in primes], np.int64).reshape(len(p), size, size)
    p2, p3 = p[:, None], p[:, None, None]
    every = np.arange(len(p))
    for k in range(size - 2):
        pivot = k + 1 + (a[:, k + 1 :, k] != 0).argmax(1)
        rows = a[every, pivot].copy()
        a[every, pivot], a[:, k + 1] = a[:, k + 1].copy(), rows
        columns = a[every, :, pivot].copy()
        a[every, :, pivot], a[:, :, k + 1] = a[:, :, k + 1].copy(), columns
        # A column that is zero already stays as it is: its factors are zero.
        inverse = np.array([pow(int(v), -1, int(q)) if v else 0 for v, q in zip(a[:, k + 1, k], p)], np.int64)
        factor = a[:, k + 2 :, k] * inverse[:, None] % p2
        a[:, k + 2 :] = (a[:, k + 2 :] - factor[:, :, None] * a[:, k + 1 : k + 2] % p3) % p3
        a[:, :, k + 1] = (a[:, :, k + 1] + (a[:, :, k + 2 :] * factor[:, None, :] % p3).sum(2)) % p2
    minors = np.zeros((size + 1, len(p), size + 1), np.int64)
    minors[0, :, 0] = 1
    for m in range(1, size + 1):
        new = np.zeros((len(p), size + 1), np.int64)
        new[:, 1:] = minors[m - 1, :, :-1]
        new = (new - a[:, m - 1, m - 1][:, None] * minors[m - 1] % p2) % p2
        below = np.ones(len(p), np.int64)
        for i in range(1, m):
            below = below * a[:, m - i, m - i - 1] % p
            new = (new - (a[:, m - i - 1, m - 1] * below % p)[:, None] * minors[m - i - 1] % p2) % p2
        minors[m] = new
    return minors[size]


def lifted(residues: list[list[int]], primes: list[int]) -> list[int]:
    """The integers of smallest absolute value with the given residues, per column."""
    product = 1
    for q in primes:
        product *= q
    weights = [product // q * pow(product // q, -1, q) for q in primes]
    found = [sum(w * r for w, r in zip(weights, column)) % product for column in zip(*residues)]
    return [v - product if 2 * v > product else v for v in found]


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """``det(z - matrix)`` of a positive semi-definite integer matrix, from the constant on."""
    size = len(matrix)
    trace = sum(matrix[i][i] for i in range(size))
    # The k-th elementary symmetric function of values with this sum and no negative one.
    bound = max(comb(size, k) * trace**k // size**k + 1 for k in range(size + 1))
    primes = primes_beyond(2 * bound)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for low in range(0, len(part), PRIMES_PER_TASK):
                own = part["prime"].iloc[low : low + PRIMES_PER_TASK].tolist()
                yield pd.DataFrame({"prime": own, "residues": modular_polynomials(matrix, own).tolist()})

    deal = spark.createDataFrame([(q,) for q in primes], "prime bigint").repartition(-(-len(primes) // PRIMES_PER_TASK))
    # One row per prime; their number follows from the digits of the matrix.
    found = {r["prime"]: r["residues"] for r in deal.mapInPandas(run, "prime bigint, residues array<bigint>").collect()}
    return lifted([found[q] for q in primes], primes)


# --- roots and components ---------------------------------------------------------


def roots_above(polynomial: list[int], point: int) -> int:
    """Number of roots larger than an integer, with multiplicity; all roots must be real."""
    shifted, power = [], 1
    for coefficient in polynomial:
        shifted.append(coefficient * power)
        power *= point
    if point:
        # The polynomial in point * (t + 1).
        for i in range(len(shifted) - 1):
            for k in range(len(shifted) - 2, i - 1, -1):
                shifted[k] += shifted[k + 1]
    else:
        shifted = polynomial
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def isolated_root(polynomial: list[int], number: int, upper: int, bits: int = ROOT_BITS) -> tuple[int, int, int, int]:
    """``(value, scale, before, multiplicity)`` of the number-th largest root, which is positive.

    The root is ``value / 2 ** scale`` to ``bits`` bits; ``before`` roots are larger, and
    ``multiplicity`` roots cannot be told from it.
    """
    scale, low, high = 0, 0, upper
    scaled = list(polynomial)
    above_low, above_high = roots_above(scaled, 0), 0
    while high - low > max(low >> bits, 0 if low else -1):
        if high - low <= 1:
            scale += 64
            low, high = low << 64, high << 64
            scaled = [c << (64 * (len(scaled) - 1 - k)) for k, c in enumerate(scaled)]
        middle = (low + high) // 2
        above = roots_above(scaled, middle)
        if above >= number:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
        if low and high - low <= low >> bits:
            break
    return 2 * low + (high - low), scale + 1, above_high, above_low - above_high


def null_space(matrix: list[list[int]], root: Decimal, count: int, rounds: int = 3) -> list[list[Decimal]]:
    """Orthonormal vectors that ``matrix - root`` maps to nearly nothing, by inverse iteration."""
    size = len(matrix)
    work = [[Decimal(v) for v in row] for row in matrix]
    for i in range(size):
        work[i][i] -= root
    tiny = (abs(root) + 1) * Decimal(10) ** (10 - DIGITS)
    order = list(range(size))
    for k in range(size):
        best = max(range(k, size), key=lambda i: abs(work[i][k]))
        work[k], work[best] = work[best], work[k]
        order[k], order[best] = order[best], order[k]
        if abs(work[k][k]) < tiny:
            work[k][k] = tiny
        top = work[k]
        for i in range(k + 1, size):
            row = work[i]
            if row[k]:
                factor = row[k] / top[k]
                row[k] = factor
                for j in range(k + 1, size):
                    row[j] -= factor * top[j]

    def solved(right: list[Decimal]) -> list[Decimal]:
        y = [right[i] for i in order]
        for i in range(size):
            y[i] -= sum((work[i][j] * y[j] for j in range(i)), Decimal(0))
        for i in range(size - 1, -1, -1):
            y[i] = (y[i] - sum((work[i][j] * y[j] for j in range(i + 1, size)), Decimal(0))) / work[i][i]
        return y

    basis = [[Decimal((i * 7919 + k * 104729 + i * i * (k + 3)) % 1009 - 504) for i in range(size)] for k in range(count)]
    for _ in range(rounds):
        done: list[list[Decimal]] = []
        for vector in basis:
            vector = solved(vector)
            largest = max(map(abs, vector))
            vector = [v / largest for v in vector]
            for _ in range(2):
                for other in done:
                    along = sum((a * b for a, b in zip(vector, other)), Decimal(0))
                    vector = [a - along * b for a, b in zip(vector, other)]
            length = sum((v * v for v in vector), Decimal(0)).sqrt()
            done.append([v / length for v in vector])
        basis = done
    return basis


def component(matrix: list[list[int]], polynomial: list[int], number: int, n: int) -> tuple[float, list[float]]:
    """Eigenvalue of the covariance and unit vector of the number-th component."""
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    with localcontext() as context:
        context.prec = DIGITS
        if number <= roots_above(polynomial, 0):
            value, scale, before, count = isolated_root(polynomial, number, trace)
            root = Decimal(value) / Decimal(2**scale)
        else:
            before = roots_above(polynomial, 0)
            root, count = Decimal(0), len(matrix) - before
        vector = null_space(matrix, root, count)[number - before - 1]
        eigenvalue = float(root / Decimal(n * n))
        largest = max(range(len(vector)), key=lambda i: (abs(float(vector[i])), -i))
        sign = -1 if vector[largest] < 0 else 1
        return eigenvalue, [float(sign * v) for v in vector]


def fit_whitening(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8) -> Whitening | None:
    """The largest components of all rows that take part; None if there is none."""
    vectors = finite_vectors(rows, key, vector)
    first = vectors.select(F.size("vec").alias("width")).first()
    if first is None:
        return None
    width, spark = first["width"], rows.sparkSession
    n, sums, products = exact_sums(vectors, width)
    scatter = [[n * products[i][j] - sums[i] * sums[j] for j in range(width)] for i in range(width)]
    count = min(components, width)
    if not count:
        return Whitening(n, sums, np.zeros(0), np.zeros((0, width)), 0.0)
    polynomial = characteristic_polynomial(spark, scatter)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for number in part["number"].tolist():
                value, vector = component(scatter, polynomial, number, n)
                yield pd.DataFrame({"number": [number], "value": [value], "vector": [vector]})

    deal = spark.createDataFrame([(k,) for k in range(1, count + 1)], "number int").repartition(count)
    found = sorted(deal.mapInPandas(run, "number int, value double, vector array<double>").collect(), key=lambda r: r["number"])
    trace = float(Decimal(sum(scatter[i][i] for i in range(width))) / Decimal(n * n))
    return Whitening(n, sums, np.array([r["value"] for r in found]), np.array([list(r["vector"]) for r in found]), trace)


# --- rows -------------------------------------------------------------------------


def projected(y: np.ndarray, model: Whitening) -> tuple[np.ndarray, list[int]]:
    """Whitened coordinates, one column per component, and deviations of entries."""
    n, sums = model.n, model.sums
    bound = n * int(np.abs(y.astype(np.float64)).max(initial=0)) + max(map(abs, sums), default=0)
    if bound * bound * max(1, len(sums)) < 2**62:
        away = n * y - np.array(sums, np.int64)
        deviation = (away * away).sum(1).tolist()
    else:
        away = n * y.astype(object) - np.array(sums, object)
        deviation = (away * away).sum(1).tolist()
    centred = away.astype(np.float64) / n
    deviations = np.sqrt(model.eigenvalues)
    scaled = np.where(deviations > 0, 1.0 / np.where(deviations > 0, deviations, 1.0), 0.0)
    return centred @ model.vectors.T * scaled, deviation


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    kept = np.flatnonzero(model.eigenvalues > 0)
    if not len(kept):
        return 0.0
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + width * width)
        for batch in batches:
            if batch.num_rows:
                w = projected(entries(batch.column(0)), model)[0][:, kept]
                total += np.concatenate((w.sum(0), (w.T @ w).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["slot", "value"])

    # The entries are centred in integers, so the means below are rounding only.
    sums = vectors.select("vec").mapInArrow(run, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value"))
    total = np.zeros(width + width * width)
    for row in sums.collect():
        total[row["slot"]] = row["value"]
    mean = total[:width] / model.n
    return float(np.abs(total[width:].reshape(width, width) / model.n - np.outer(mean, mean) - np.eye(width)).max())


def whiten(rows: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(key, component, n, deviation, whitened, explained, identity_error)``: one row per vector and component."""
    fields = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    kind = rows.schema[key].dataType.simpleString()
    if model is None:
        return rows.sparkSession.createDataFrame([], f"{key} {kind}, {fields}")
    vectors = finite_vectors(rows, key, vector)
    error = identity_error(vectors, model)
    count = len(model.eigenvalues)
    explained = model.eigenvalues / model.trace if model.trace else np.zeros(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not (batch.num_rows and count):
                continue
            whitened, deviation = projected(entries(batch.column(1)), model)
            owner = np.repeat(np.arange(batch.num_rows), count)
            fits = pa.array([v if v < 2**63 else None for v in deviation], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(len(owner), model.n, np.int64)), fits.take(pa.array(owner)), pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, batch.num_rows)), pa.array(np.full(len(owner), error)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.select("id", "vec").mapInArrow(run, f"id {kind}, {fields}").withColumnRenamed("id", key)
