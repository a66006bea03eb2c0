"""Whitening of embeddings from the exact characteristic polynomial of their integer scatter matrix.

Entries become whole numbers, x = floor(64*c) + 1000000. The fit list is each distinct vector once. Its scatter matrix
M = n*sum(x x') - S S' is a matrix of integers, and V = M / n**2 is the covariance. All that follows from M is exact until
the last step:

1. Tasks add up products of their rows in blocks small enough for doubles to hold every sum exactly; Spark adds the
   blocks up as decimals. d*(d+1)/2 numbers reach the driver, whatever the number of rows.
2. The characteristic polynomial of M is computed modulo as many primes as the bound on its coefficients asks for, by
   reduction to Hessenberg form, one prime a row of a Spark job. Chinese remaindering gives the integer coefficients.
3. All roots are real, so the sign changes of the polynomial shifted to a point count the roots above it, with their
   multiplicity. Halving intervals isolates the largest roots to ``ROOT_BITS`` binary digits; zeros are counted exactly.
4. Components are null vectors of M minus the root, by inverse iteration with ``DIGITS`` decimal digits. Roots that
   agree to many digits share an orthogonal basis. The entry of largest magnitude is positive.

Defined results: vectors that are NULL, empty, or hold NULL or non-finite entries take no part; nor do vectors of another
length than the most frequent (the longest of equally frequent). Only components with an eigenvalue above 0 exist, so one
distinct vector gives no rows. Repeated rows and vectors are whitened each by itself; NULL ids stay. ``deviation`` is
a decimal, NULL beyond 38 digits. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import narrow, stored

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
ROOT_BITS = 120
DIGITS = 80
#: Doubles hold whole numbers below this exactly.
EXACT = 1 << 53
BLOCK = 4096


def whole_entries(table: DataFrame, id: str, vector: str) -> DataFrame:
    """``vec_id`` and ``y`` = floor(64*c) of the usable vectors. The shift to x cancels out of all that is centred."""
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    read = narrow(table, vec_id=id, v=vector).withColumn("v", F.col("v").cast("array<double>"))
    usable = read.filter(F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)
    rows = stored(usable.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("y")), "whitening-rows")
    lengths = rows.groupBy(F.size("y").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("y") == lengths["d"]) if lengths else rows


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without NULLs as one row per list."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: the exact sums of y and of the products of its entries, as (i, j, total); j is -1 for a plain sum."""
    sums = second = None
    for batch in batches:
        if not batch.num_rows:
            continue
        y = matrix(batch.column(0))
        if sums is None:
            sums, second = [0] * y.shape[1], np.zeros((y.shape[1],) * 2, dtype=object)
        most = max(1, int(np.abs(y).max()))
        rows = max(1, min(BLOCK, (EXACT - 1) // most**2))
        for a in range(0, len(y), rows):
            part = y[a:a + rows]
            if most**2 * len(part) < EXACT:
                f = part.astype(np.float64)
                second = second + (f.T @ f).astype(np.int64).astype(object)
            else:
                part = part.astype(object)
                second = second + part.T @ part
        for i, s in enumerate(y.astype(object).sum(axis=0)):
            sums[i] += int(s)
    if sums is None:
        return
    d = len(sums)
    rows = [(i, -1, sums[i]) for i in range(d)] + [(i, j, int(second[i, j])) for i in range(d) for j in range(i, d)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([Decimal(r[2]) for r in rows], pa.decimal128(38, 0))], ["i", "j", "total"])


def scatter(fit: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """Rows n of the fit list, sums T of y, and n*sum(y y') - T T'."""
    n = fit.count()
    found = fit.select("y").mapInArrow(products, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(
        F.sum("total").alias("total")).collect()
    total = {(r["i"], r["j"]): int(r["total"]) for r in found}
    d = sum(1 for _, j in total if j < 0)
    t = [total[i, -1] for i in range(d)]
    m = [[n * total[min(i, j), max(i, j)] - t[i] * t[j] for j in range(d)] for i in range(d)]
    return n, t, m


def is_prime(p: int) -> bool:
    """Miller-Rabin with bases that decide all numbers below 2**32."""
    if p % 2 == 0:
        return p == 2
    odd, twos = p - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, p)
        if x in (1, p - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % p
            if x == p - 1:
                break
        else:
            return False
    return True


def primes(bits: int) -> list[int]:
    """Primes below 2**31 whose product has more than ``bits`` binary digits."""
    found, have, p = [], 0, (1 << 31) - 1
    while have <= bits:
        if is_prime(p):
            found.append(p)
            have += 30
        p -= 2
    return found


def characteristic_modulo(m: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(z - m) modulo p, highest first, by reduction to Hessenberg form. Entries of ``m`` are in
    [0, p); p < 2**31, so that products fit."""
    h = m.astype(np.int64).copy()
    d = len(h)
    for c in range(d - 2):
        below = np.flatnonzero(h[c + 1:, c])
        if not len(below):
            continue
        r = c + 1 + int(below[0])
        if r != c + 1:
            h[[r, c + 1]] = h[[c + 1, r]]
            h[:, [r, c + 1]] = h[:, [c + 1, r]]
        factor = h[c + 2:, c] * pow(int(h[c + 1, c]), -1, p) % p
        h[c + 2:] = (h[c + 2:] - factor[:, None] * h[c + 1][None, :] % p) % p
        # the inverse step on columns keeps the matrix similar
        h[:, c + 1] = (h[:, c + 1] + (h[:, c + 2:] * factor[None, :] % p).sum(axis=1)) % p
    # polys[k]: characteristic polynomial of the leading k x k block, lowest coefficient first
    polys = [np.zeros(d + 1, dtype=np.int64) for _ in range(d + 1)]
    polys[0][0] = 1
    for k in range(1, d + 1):
        out = np.zeros(d + 1, dtype=np.int64)
        out[1:] = polys[k - 1][:-1]
        out = (out - int(h[k - 1, k - 1]) * polys[k - 1] % p) % p
        product = 1
        for i in range(1, k):
            product = product * int(h[k - i, k - i - 1]) % p
            if not product:
                break
            out = (out - product * int(h[k - i - 1, k - 1]) % p * polys[k - i - 1] % p) % p
        polys[k] = out
    return [int(x) for x in polys[d][::-1]]


def coefficient_bits(m: list[list[int]]) -> int:
    """Binary digits that hold every coefficient of the characteristic polynomial, with its sign: each is a sum of
    products of roots, none of which exceeds the largest sum of magnitudes in a row."""
    radius = max(sum(abs(x) for x in row) for row in m)
    return len(m) * ((1 + radius).bit_length() + 1) + 2


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Integer coefficients of det(z - m), highest first; one prime per row of a Spark job."""
    chosen = primes(coefficient_bits(m))
    shared = spark.sparkContext.broadcast(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                reduced = np.array([[x % p for x in row] for row in shared.value], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int64()), pa.array([characteristic_modulo(reduced, p)], pa.list_(pa.int64()))],
                    ["p", "coefficients"])

    tasks = min(len(chosen), 2 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(tasks).mapInArrow(
        run, "p long, coefficients array<long>").collect()
    product = 1
    for r in rows:
        product *= r["p"]
    total = [0] * (len(m) + 1)
    for r in rows:
        rest = product // r["p"]
        unit = rest * pow(rest, -1, r["p"])
        for i, c in enumerate(r["coefficients"]):
            total[i] += unit * c
    return [x - product if x > product // 2 else x for x in (t % product for t in total)]


def roots_above(poly: list[int], point: int) -> int:
    """How many roots of a polynomial with real roots only lie above a whole number, counted with multiplicity: the sign
    changes of its coefficients after the shift by that number."""
    c = list(poly)
    for end in range(len(c) - 1, 0, -1):
        for i in range(1, end + 1):
            c[i] += point * c[i - 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


@dataclass
class Root:
    """The ``count`` roots in [low, low + 1) / 2**scale, as one."""

    low: int
    scale: int
    count: int

    def decimal(self) -> Decimal:
        return (Decimal(2 * self.low + 1) / 2) / Decimal(1 << self.scale)


def largest_roots(poly: list[int], most: int, bits: int = ROOT_BITS) -> list[Root]:
    """The ``most`` largest positive roots, largest first, each isolated to ``bits`` binary digits of the largest."""
    zeros = 0
    while poly[-1 - zeros] == 0:
        zeros += 1
    poly = poly[:len(poly) - zeros]
    if len(poly) < 2:
        return []
    bound = max(1, max(abs(c) for c in poly[1:2]))  # the sum of all roots, none of them negative
    scale = max(0, bits - bound.bit_length())
    poly = [c << (scale * i) for i, c in enumerate(poly)]
    high = (bound << scale) + 1
    wanted = min(most, len(poly) - 1)
    found: list[Root] = []
    open_ = [(0, high, len(poly) - 1, 0)]  # low, high, roots above low, roots above high
    while open_ and sum(r.count for r in found) < wanted:
        low, top, more, less = open_.pop()
        if more == less:
            continue
        if top - low == 1:
            found.append(Root(low, scale, more - less))
            continue
        middle = (low + top) // 2
        at = roots_above(poly, middle)
        open_ += [(low, middle, more, at), (middle, top, at, less)]
    return found


def null_vectors(m: list[list[int]], root: Root) -> list[list[Decimal]]:
    """Orthonormal vectors that m takes to ``root`` times themselves, by inverse iteration on exact digits."""
    d = len(m)
    value = root.decimal()
    a = [[Decimal(m[i][j]) - (value if i == j else 0) for j in range(d)] for i in range(d)]
    order, tiny = list(range(d)), max(abs(Decimal(x)) for row in m for x in row) * Decimal(10) ** (8 - DIGITS)
    for c in range(d):
        r = max(range(c, d), key=lambda i: abs(a[i][c]))
        a[c], a[r], order[c], order[r] = a[r], a[c], order[r], order[c]
        if abs(a[c][c]) < tiny:
            a[c][c] = tiny
        pivot, row = a[c][c], a[c]
        for i in range(c + 1, d):
            if a[i][c]:
                f = a[i][c] / pivot
                below = a[i]
                below[c] = f
                for j in range(c + 1, d):
                    below[j] -= f * row[j]

    def solved(b: list[Decimal]) -> list[Decimal]:
        x = [b[o] for o in order]
        for i in range(d):
            x[i] -= sum((a[i][j] * x[j] for j in range(i)), Decimal(0))
        for i in reversed(range(d)):
            x[i] = (x[i] - sum((a[i][j] * x[j] for j in range(i + 1, d)), Decimal(0))) / a[i][i]
        return x

    def unit(x: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
        for _ in range(2):
            for o in others:
                dot = sum((p * q for p, q in zip(x, o)), Decimal(0))
                x = [p - dot * q for p, q in zip(x, o)]
        length = sum((p * p for p in x), Decimal(0)).sqrt()
        return [p / length for p in x]

    start = np.random.default_rng(d)
    basis: list[list[Decimal]] = []
    for _ in range(root.count):
        x = unit([Decimal(float(v)) for v in start.standard_normal(d)], basis)
        for _ in range(3):
            x = unit(solved(x), basis)
        basis.append(x)
    return basis


@dataclass
class Whitening:
    """``n`` and ``sums`` of y over the fit list, unit components as columns, eigenvalues of V and their shares."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The largest components of the distinct vectors in the stored table ``fit``, None if there is none."""
    n, sums, m = scatter(fit)
    if not any(m[i][i] for i in range(len(m))):
        return None
    poly = characteristic_polynomial(fit.sparkSession, m)
    vectors, values = [], []
    with decimal.localcontext() as context:
        context.prec = DIGITS
        trace = Decimal(sum(m[i][i] for i in range(len(m))))
        for root in largest_roots(poly, components):
            for x in null_vectors(m, root):
                lead = max(x, key=abs)
                vectors.append([float(v if lead > 0 else -v) for v in x])
                values.append(root.decimal())
        vectors, values = vectors[:components], values[:components]
        explained = np.array([float(v / trace) for v in values])
        values = np.array([float(v / n**2) for v in values])
    return Whitening(n, sums, np.array(vectors).T, values, explained)


def whitened(y: np.ndarray, model: Whitening) -> tuple[list[int], np.ndarray]:
    """Exact sums of squares of n*y - T, and the whitened rows."""
    n, most = model.n, max(1, int(np.abs(y).max())) if len(y) else 1
    wide = n * most + max(abs(t) for t in model.sums)
    gap = n * y - np.array(model.sums) if wide < 1 << 62 else n * y.astype(object) - np.array(model.sums, dtype=object)
    square = (gap * gap).sum(axis=1) if wide**2 * y.shape[1] < 1 << 62 else (gap.astype(object) ** 2).sum(axis=1)
    return [int(s) for s in square], (gap / n).astype(np.float64) @ model.components / np.sqrt(model.values)


def project(model) -> object:
    """A function for ``mapInArrow``: (vec_id, y) becomes (vec_id, deviation, whitened)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            square, z = whitened(matrix(batch.column(1)), model.value)
            square = [Decimal(s) if s < 10**38 else None for s in square]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(square, pa.decimal128(38, 0)), pa.array(list(z), pa.list_(pa.float64()))],
                ["vec_id", "deviation", "whitened"])

    return run


def moments(model) -> object:
    """A function for ``mapInArrow``: y of the fit list becomes the task's sums of whitened values and products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.value.values)
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                _, z = whitened(matrix(batch.column(0)), model.value)
                first, second = first + z.sum(axis=0), second + z.T @ z
        flat = np.concatenate([first, second.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], ["at", "total"])

    return run


def identity_error(fit: DataFrame, model) -> float:
    """The largest entry, by magnitude, of the covariance of the whitened fit list less the identity."""
    k, n = len(model.value.values), model.value.n
    flat = np.zeros(k + k * k)
    for r in fit.select("y").mapInArrow(moments(model), "at int, total double").groupBy("at").agg(
            F.sum("total").alias("total")).collect():
        flat[r["at"]] = r["total"]
    mean = flat[:k] / n
    return float(np.abs(flat[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(table: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error`` for each
    usable row and component."""
    spark = table.sparkSession
    rows = whole_entries(table, id, vector)
    fit = stored(rows.select("y").distinct(), "whitening-fit")
    model = fit_whitening(fit, components) if fit.limit(1).count() else None
    if model is None:
        return rows.select(
            "vec_id", F.lit(1).alias("component"), F.lit(1).cast("long").alias("n"),
            F.lit(0).cast("decimal(38,0)").alias("deviation"), F.lit(0.0).alias("whitened"),
            F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error")).limit(0)
    shared = spark.sparkContext.broadcast(model)
    error = identity_error(fit, shared)
    kind = rows.schema["vec_id"].dataType.simpleString()
    found = rows.mapInArrow(project(shared), f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")
    share = F.array(*[F.lit(float(x)) for x in model.explained])
    return found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
