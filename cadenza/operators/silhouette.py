"""The silhouette of a large clustering with a stated error, at a cost that does not grow with the square of its rows.

Sampled points are scored exactly, against all rows. Rounds of twice as many points each go on until the confidence bound
of the mean is as narrow as asked for, or all points are scored. The number of sampled points follows from the error
alone, so the work is rows times that number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.constants import SEED
from cadenza.session import materialise, small_side

#: Numbers in the vectors of a block, and in its sums: a task holds two blocks.
BLOCK_VALUES = 2_000_000
BLOCK_SUMS = 4_000_000
#: Points of the first round, over all clusters, and the least of each cluster.
FIRST_POINTS = 1024
LEAST_POINTS = 32
_CELLS = 1_000_000
_CLOSE = 1e-4  # squared, of the squared lengths: beneath it a matrix product loses digits


def _matrix(column: pa.Array) -> np.ndarray:
    """One row per vector; all are of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(a: np.ndarray, b: np.ndarray, member: np.ndarray) -> np.ndarray:
    """For each row of ``a`` the sums of its distances to the rows of ``b``, by the columns of ``member``.

    Distances come from a matrix product of the rows less their mean; pairs too close for it are subtracted one by one, and
    so are all pairs if the numbers are not finite or their squares are not.
    """
    sums = np.zeros((len(a), member.shape[1]))
    with np.errstate(all="ignore"):
        mean = b.mean(axis=0)
        near_a, near_b = a - mean, b - mean
        length_a, length_b = (near_a * near_a).sum(axis=1), (near_b * near_b).sum(axis=1)
        plain = np.isfinite(length_a.sum() + length_b.sum()) and max(length_a.max(), length_b.max()) < 1e300
        if plain:  # one product gives the squares of the lengths as well
            near_a = np.column_stack([near_a, length_a, np.ones(len(a))])
            near_b = np.column_stack([-2.0 * near_b, np.ones(len(b)), length_b])
        step = max(1, _CELLS // len(b))
        for start in range(0, len(a), step):
            rows = slice(start, start + step)
            if plain:
                gaps = near_a[rows] @ near_b.T
                few = np.nonzero(gaps.min(axis=1) <= _CLOSE * (length_a[rows] + length_b.max()))[0]
                for some in np.array_split(few, -(-len(few) * len(b) // 200_000) or 1):
                    i, j = np.nonzero(gaps[some] <= _CLOSE * (length_a[rows][some][:, None] + length_b[None, :]))
                    for at in range(0, len(i), 50_000):
                        x, y = some[i[at:at + 50_000]], j[at:at + 50_000]
                        gaps[x, y] = ((a[rows][x] - b[y]) ** 2).sum(axis=1)
            else:
                gaps = np.zeros((len(a[rows]), len(b)))
                for d in range(b.shape[1]):
                    gaps += (a[rows, d][:, None] - b[:, d][None, :]) ** 2
            sums[rows] = np.sqrt(gaps, out=gaps) @ member
    return sums


def _members(clusters: np.ndarray, count: int) -> np.ndarray:
    member = np.zeros((len(clusters), count))
    member[np.arange(len(clusters)), clusters] = 1.0
    return member


def _totals(at: np.ndarray, names: list[str | None], sums: np.ndarray, pa=pa) -> pa.RecordBatch:
    """(at, other, total) of a matrix of sums."""
    others = pa.DictionaryArray.from_arrays(np.tile(np.arange(len(names), dtype=np.int32), len(at)), pa.array(names, pa.string()))
    return pa.RecordBatch.from_arrays([
        pa.array(np.repeat(at, len(names)), pa.int64()), others.cast(pa.string()), pa.array(sums.ravel())], ["at", "other", "total"])


def _distance_sums(sampled: np.ndarray, at: np.ndarray, names: list[str]):
    """A function for ``mapInArrow``: (cluster, vector) becomes (at, other, total), the sums of the distances between each
    sampled point and the task's rows of each cluster."""
    place = {c: i for i, c in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(sampled), len(names)))
        for batch in batches:
            if not batch.num_rows:
                continue
            clusters = np.array([place[c] for c in batch.column(0).to_pylist()], dtype=np.int64)
            vectors = _matrix(batch.column(1))
            for start in range(0, len(vectors), 4096):
                part = slice(start, start + 4096)
                sums += _sums(sampled, vectors[part], _members(clusters[part], len(names)))
        yield _totals(at, names, sums)

    return run


def block_sums(points: DataFrame, others: DataFrame) -> DataFrame:
    """``(at, other, total)``: the sums of the distances between each row ``(at, vector)`` of ``points`` and the rows
    ``(cluster, vector)`` of ``others`` in each cluster, once per block of ``others``; add up the totals.

    Blocks of both sides meet in one task. A block is bounded by the numbers of its vectors and of its sums, not by the
    input; a row travels once per block of the other side, so blocks are as large as a task can well hold.
    """
    about = others.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width"),
                       F.approx_count_distinct("cluster").alias("clusters")).first()
    cores = points.sparkSession.sparkContext.defaultParallelism
    even = max(1024, math.ceil(about["n"] / math.sqrt(2 * cores)))  # small inputs are spread over the cores, too
    rows = max(1, min(BLOCK_VALUES // max(1, about["width"] or 1), max(2048, BLOCK_SUMS // max(1, about["clusters"])), even))
    mine, theirs = max(1, -(-points.count() // rows)), max(1, -(-about["n"] // rows))
    dealt = lambda n: F.pmod(F.xxhash64("deal"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = points.withColumn("deal", F.col("at")).select(dealt(mine).alias("block"), every(theirs).alias("facing"), "at", "vector")
    right = others.withColumn("deal", F.monotonically_increasing_id()).select(
        dealt(theirs).alias("facing"), every(mine).alias("block"), F.col("cluster").alias("other"), F.col("vector").alias("opposite"))
    matrix, sums, members, totals = _matrix, _sums, _members, _totals

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        import pyarrow as pa

        none = pa.schema([("at", pa.int64()), ("other", pa.string()), ("total", pa.float64())]).empty_table()
        if not a.num_rows or not b.num_rows:
            return none
        clusters = b.column("other").combine_chunks().dictionary_encode(null_encoding="encode")
        found = sums(*[matrix(t.combine_chunks()) for t in (a.column("vector"), b.column("opposite"))],
                     members(clusters.indices.to_numpy(), len(clusters.dictionary)))
        return pa.Table.from_batches([totals(a.column("at").to_numpy(), clusters.dictionary.to_pylist(), found)])

    return left.groupBy("block", "facing").cogroup(right.groupBy("block", "facing")).applyInArrow(meet, "at long, other string, total double")


def _scores(sums: DataFrame, sampled: DataFrame, sizes: DataFrame) -> DataFrame:
    """``cluster``, ``n``, ``s``, ``ss``: count, sum and sum of squares of the sampled points' silhouettes."""
    own = F.col("other") == F.col("cluster")
    gaps = sums.groupBy("at", "other").agg(F.sum("total").alias("total")).join(sizes, "other").join(sampled, "at").groupBy(
        "at", "cluster").agg(
        F.max(F.when(own & (F.col("size") > 1), F.col("total") / (F.col("size") - 1))).alias("within"),
        F.min(F.when(~own, F.col("total") / F.col("size"))).alias("nearest"))
    best = F.greatest("within", "nearest")
    score = F.when(F.col("within").isNotNull() & F.col("nearest").isNotNull() & (best > 0),
                   (F.col("nearest") - F.col("within")) / best).otherwise(0.0)
    return gaps.select("cluster", score.alias("x")).groupBy("cluster").agg(
        F.count("x").alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("ss"))


def _estimate(sizes: dict, found: dict, z: float) -> tuple[float, float]:
    """Mean over clusters in proportion to their rows, and the half-width of its bound."""
    rows = sum(sizes.values())
    mean = variance = 0.0
    for c, size in sizes.items():
        n, s, ss = found.get(c, (0, 0.0, 0.0))
        if n < min(size, 2):
            return 0.0, float("inf")
        mean += size / rows * s / n
        if n < size:
            spread = max(0.0, ss - s * s / n) / (n - 1)
            variance += (size / rows) ** 2 * spread / n * (1 - n / size)
    return mean, z * variance ** 0.5


def silhouette_estimate(df: DataFrame, key: str, vector: str, cluster: str, error: float = 0.01,
                        confidence: float = 0.95, first: int = FIRST_POINTS, seed: int = SEED) -> DataFrame:
    """One row: ``silhouette_score``, ``error`` (half-width of its bound), ``points`` (scored), ``rows`` and ``rounds``.

    The bound holds at ``confidence`` over all rounds together: a round may use half of what the earlier ones left of the
    chance to be wrong. If all points are to be scored, blocks of them meet in the tasks and none reaches the driver. Points are drawn by the hash of their key, in every cluster in proportion to its size but at least
    ``LEAST_POINTS``, so the result does not depend on partitioning. ``error=0`` scores all points. Per round about
    (z / error) squared vectors at most reach the driver and every task, beside the least per cluster; a task holds one
    number per sampled point and cluster, so clusters should be some thousands at most.

    Rows without a vector or a cluster take no part; a point alone in its cluster, or all points in one, count as 0. No
    rows give NULL with an error of 0. Equal keys are drawn together.
    """
    u = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    points = materialise(df.select(
        F.col(cluster).cast("string").alias("cluster"), F.col(vector).cast("array<double>").alias("vector"), u.alias("u"),
        F.monotonically_increasing_id().alias("at")).filter("cluster IS NOT NULL AND vector IS NOT NULL"), "silhouette")
    spark = df.sparkSession
    sizes = {r["cluster"]: r["n"] for r in points.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    rows, names = sum(sizes.values()), sorted(sizes)
    schema = "silhouette_score double, error double, points long, rows long, rounds int"
    if not rows:
        return spark.createDataFrame([(None, 0.0, 0, 0, 0)], schema)
    others = small_side(spark.createDataFrame(list(sizes.items()), "other string, size long"))
    low, found, rounds = dict.fromkeys(names, 0.0), {}, 0

    def add(scores):
        for r in scores.collect():
            n, s, ss = found.get(r["cluster"], (0, 0.0, 0.0))
            found[r["cluster"]] = (n + r["n"], s + r["s"], ss + r["ss"])

    while True:
        share = first * 2.0 ** rounds / rows
        high = {c: 1.0 if error <= 0 else min(1.0, max(share, LEAST_POINTS * 2.0 ** rounds / sizes[c])) for c in names}
        bounds = small_side(spark.createDataFrame([(c, low[c], high[c]) for c in names], "cluster string, low double, high double"))
        drawn = points.join(bounds, "cluster").filter("u >= low AND u < high")
        sampled = materialise(drawn.select("at", "cluster", "vector"), "silhouette-sample")
        whole = min(high.values()) >= 1.0  # so many points may be left that they do not pass through the driver
        for part in [sampled] if whole else _parts(sampled, first):
            if whole:
                add(_scores(block_sums(part, points), part.select("at", "cluster"), others))
                continue
            local = part.select("at", "vector").toArrow()
            if not local.num_rows:
                continue
            at, vectors = local.column(0).to_numpy(), _matrix(local.column(1).combine_chunks())
            sums = points.select("cluster", "vector").mapInArrow(
                _distance_sums(vectors, at, names), "at long, other string, total double")
            add(_scores(sums, part.select("at", "cluster"), others))
        low, rounds = high, rounds + 1
        mean, half = _estimate(sizes, found, NormalDist().inv_cdf(1 - (1 - confidence) / 2 ** (rounds + 1)))
        if half <= error or min(high.values()) >= 1.0:
            break
    scored = sum(n for n, _, _ in found.values())
    return spark.createDataFrame([(mean, half, scored, rows, rounds)], schema)


def _parts(sampled: DataFrame, size: int) -> list[DataFrame]:
    """``sampled`` in parts of about ``4 * size`` points, so that neither driver nor task holds more at once."""
    n = max(1, -(-sampled.count() // (4 * size)))
    part = F.pmod(F.xxhash64("at"), F.lit(n))
    return [sampled.filter(part == i) for i in range(n)]
