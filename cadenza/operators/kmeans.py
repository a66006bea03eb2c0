"""K-means from several starts at once.

The rows are stored once, in blocks. A pass over them serves all starts that still move, so the number of passes is that of
the longest start and not the sum of all. A task holds one block; sums of the clusters are all that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.session import materialise_blocks

#: Numbers of a block, and of the distances that a task holds at once.
BLOCK_VALUES = 500_000
_CELLS = 4_000_000
#: As Spark's: rounds of the start, and steps on the points that they draw.
ROUNDS = 2
LOCAL_STEPS = 30


def _to_blocks(width: int, size: int):
    """A function for ``mapInArrow``: columns of numbers become rows ``(n, numbers)`` of ``size`` vectors."""

    def packed(table):
        lines = np.stack([c.to_numpy() for c in table.columns], axis=1)
        return pa.RecordBatch.from_arrays([pa.array([len(lines)], pa.int32()), pa.array([lines.tobytes()], pa.binary())], ["n", "numbers"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            while rows >= size:
                table = pa.Table.from_batches(held)
                yield packed(table.slice(0, size))
                held, rows = table.slice(size).combine_chunks().to_batches(), rows - size
        if rows:
            yield packed(pa.Table.from_batches(held))

    return run


def _parts(batches: Iterator[pa.RecordBatch], width: int, step: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Block, first row and vectors, ``step`` rows at most."""
    for batch in batches:
        for block, numbers in zip(batch.column("block"), batch.column("numbers")):
            lines = np.frombuffer(numbers.as_buffer(), np.float64).reshape(-1, width)
            for first in range(0, len(lines), step):
                yield block.as_py(), first, lines[first:first + step]


def _distances(centres: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """``(centres, rows)`` squared distances."""
    gaps = centres @ lines.T
    gaps *= -2.0
    gaps += (centres * centres).sum(axis=1)[:, None]
    gaps += (lines * lines).sum(axis=1)
    return np.maximum(gaps, 0.0, out=gaps)


def _bounds(centres: list[np.ndarray]) -> list[slice]:
    ends = np.cumsum([0, *[len(c) for c in centres]])
    return [slice(a, b) for a, b in zip(ends, ends[1:])]


def _moments(centres: list[np.ndarray]):
    """A function of a task's parts: per start the cost, per centre the nearest rows' count and sum."""
    every, bounds = np.concatenate(centres), _bounds(centres)

    def run(parts):
        costs, sums, counts = np.zeros(len(bounds)), np.zeros(every.shape), np.zeros(len(every))
        for _, _, lines in parts:
            gaps, member, at = _distances(every, lines), np.zeros((len(every), len(lines))), np.arange(len(lines))
            for start, some in enumerate(bounds):
                nearest = gaps[some].argmin(axis=0)
                costs[start] += gaps[some][nearest, at].sum()
                member[some.start + nearest, at] = 1.0
            sums += member @ lines
            counts += member.sum(axis=1)
        yield np.concatenate([costs, counts, sums.ravel()])

    return run


def _drawn(centres: list[np.ndarray], costs: np.ndarray, k: int, seeds: Sequence[int], turn: int):
    """A function of a task's parts: ``start, vector`` of points drawn in proportion to their distance, about ``2 * k``."""
    every, bounds = np.concatenate(centres), _bounds(centres)

    def run(parts):
        for block, first, lines in parts:
            gaps = _distances(every, lines)
            for start, some in enumerate(bounds):
                if costs[start] <= 0:
                    continue
                chance = gaps[some].min(axis=0) * (2.0 * k / costs[start])
                for i in np.flatnonzero(np.random.default_rng([seeds[start], turn, block, first]).random(len(lines)) < chance):
                    yield np.concatenate([[start], lines[i]])

    return run


def _picked(wanted: dict[int, list[tuple[int, int]]]):
    """A function of a task's parts: ``start, vector`` of the rows ``(start, row)`` wanted of a block."""

    def run(parts):
        for block, first, lines in parts:
            for start, row in wanted.get(block, []):
                if first <= row < first + len(lines):
                    yield np.concatenate([[start], lines[row - first]])

    return run


def _local(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """K-means++ and some steps of k-means on weighted points."""
    random = np.random.default_rng([seed, 1])
    chosen = [points[random.choice(len(points), p=weights / weights.sum())]]
    while len(chosen) < k:
        chance = _distances(np.array(chosen), points).min(axis=0) * weights
        if chance.sum() <= 0:
            break
        chosen.append(points[random.choice(len(points), p=chance / chance.sum())])
    centres, before = np.array(chosen), None
    for _ in range(LOCAL_STEPS):
        nearest = _distances(centres, points).argmin(axis=0)
        if before is not None and (nearest == before).all():
            break
        before = nearest
        for i in range(len(centres)):
            mine = nearest == i
            held = weights[mine].sum()
            centres[i] = weights[mine] @ points[mine] / held if held > 0 else points[random.integers(len(points))]
    return centres


class _Rows:
    """The stored rows."""

    def __init__(self, numbers: DataFrame, names: Sequence[str]):
        self.width = len(names)
        size = max(1, BLOCK_VALUES // self.width)
        self.stored = materialise_blocks(numbers.select(*names).mapInArrow(
            _to_blocks(self.width, size), "n int, numbers binary").withColumn("block", F.monotonically_increasing_id()), "kmeans")
        self.blocks = sorted((r["block"], r["n"]) for r in self.stored.select("block", "n").collect())
        self.spread = max(2, numbers.sparkSession.sparkContext.defaultParallelism)

    def visit(self, make: Callable, centres: int = 1, blocks: Sequence[int] | None = None) -> list[np.ndarray]:
        """What ``make`` yields in all tasks: arrays."""
        width, step = self.width, max(1, _CELLS // centres)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for found in make(_parts(batches, width, step)):
                yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], ["found"])

        stored = self.stored if blocks is None else self.stored.filter(F.col("block").isin(*blocks))
        return [np.frombuffer(r["found"]) for r in stored.coalesce(self.spread).mapInArrow(run, "found binary").collect()]

    def moments(self, centres: list[np.ndarray]):
        """Per start its cost, and the counts and sums of its centres."""
        several, width, n = len(centres), self.width, sum(len(c) for c in centres)
        found = sum(self.visit(_moments(centres), n))
        counts, sums = found[several:several + n], found[several + n:].reshape(n, width)
        return found[:several], [counts[b] for b in _bounds(centres)], [sums[b] for b in _bounds(centres)]


def _starts(rows: _Rows, k: int, seeds: Sequence[int]) -> list[np.ndarray]:
    """The first centres of each start, by k-means||."""
    ends = np.cumsum([n for _, n in rows.blocks])
    wanted = {}
    for start, seed in enumerate(seeds):
        row = int(np.random.default_rng([seed, 0]).integers(ends[-1]))
        at = int(np.searchsorted(ends, row, side="right"))
        block, n = rows.blocks[at]
        wanted.setdefault(block, []).append((start, row - int(ends[at]) + n))
    found = sorted(rows.visit(_picked(wanted), 1, list(wanted)), key=lambda x: x[0])
    centres = [x[None, 1:] for x in found]
    for turn in range(ROUNDS):
        costs, _, _ = rows.moments(centres)
        drawn = rows.visit(_drawn(centres, costs, k, seeds, turn), sum(len(c) for c in centres))
        drawn.sort(key=lambda x: tuple(x))
        for x in drawn:
            centres[int(x[0])] = np.vstack([centres[int(x[0])], x[1:]])
    centres = [np.unique(c, axis=0) for c in centres]
    _, weights, _ = rows.moments(centres)
    return [c if len(c) <= k else _local(c, w, k, seed) for c, w, seed in zip(centres, weights, seeds)]


def best_of_starts(numbers: DataFrame, names: Sequence[str], k: int, seeds: Sequence[int], max_iterations: int,
                   tolerance: float) -> tuple[np.ndarray, float]:
    """Centres of the start with the least cost, and that cost. A start ends when no centre moves by more than ``tolerance``."""
    rows = _Rows(numbers, names)
    if not rows.blocks:
        raise ValueError("no rows to cluster")
    centres = _starts(rows, k, seeds)
    moving = list(range(len(seeds)))
    for _ in range(max_iterations):
        if not moving:
            break
        _, counts, sums = rows.moments([centres[i] for i in moving])
        still = []
        for i, n, total in zip(moving, counts, sums):
            moved = np.where(n[:, None] > 0, total / np.maximum(n, 1.0)[:, None], centres[i])
            if ((moved - centres[i]) ** 2).sum(axis=1).max() > tolerance ** 2:
                still.append(i)
            centres[i] = moved
        moving = still
    costs, _, _ = rows.moments(centres)
    best = int(np.argmin(costs))
    return centres[best], float(costs[best])


def clusters_model(centres: np.ndarray, features: str, prediction: str) -> KMeansModel:
    """Spark's model with these centres."""
    spark = SparkSession.active()
    jvm = spark._jvm
    held = jvm.java.util.ArrayList()
    for centre in centres:
        numbers = spark.sparkContext._gateway.new_array(jvm.double, len(centre))
        for i, x in enumerate(centre):
            numbers[i] = float(x)
        held.add(jvm.org.apache.spark.mllib.linalg.Vectors.dense(numbers))
    parent = jvm.org.apache.spark.mllib.clustering.KMeansModel(held)
    model = KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(
        jvm.org.apache.spark.ml.util.Identifiable.randomUID("kmeans"), parent))
    return model.setFeaturesCol(features).setPredictionCol(prediction)
