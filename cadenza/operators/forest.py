"""Random forests whose trees never pass through the driver as a whole.

The numbers are cut into at most 32 bins and stored once, in blocks. Nodes with many rows are split by histograms that the
tasks make of their blocks, level by level. A node with few enough rows goes on in one task, which gets its rows and grows
the rest of the tree there; such subtrees stay in stored rows. The driver holds the nodes above them only. A model of few
nodes scores rows where they lie; with a large one, blocks of rows meet parts of the forest in the tasks.
"""

from __future__ import annotations

import gc
import json
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators import trees as T
from cadenza.session import materialise, materialise_blocks, scratch_dir

BLOCK_ROWS = 1 << 16
#: A node of so many rows or fewer is finished in one task.
LOCAL_ROWS = 250_000
#: Trees of at most this depth are finished so only if all their rows together are of at most LOCAL_BYTES.
SHALLOW = 12
LOCAL_BYTES = 1 << 30
#: Numbers of the histograms of a job's task, and of one of them.
JOB_CELLS = 8_000_000
ITEM_CELLS = 250_000
#: A model of so many nodes scores rows where they lie. A task else holds parts of about PART_NODES nodes and SCORED_ROWS rows.
NARROW_NODES = 1_000_000
PART_NODES = 500_000
SCORED_ROWS = 250_000
_SLICE = 4096

_ARRAYS = {"feature": np.int16, "cut": np.uint8, "left": np.int32, "ptr": np.int32, "classes": np.int32,
           "values": np.float64, "gains": np.float64, "slots": np.int32}
_SCHEMA = "tree int, slot int, nodes int, " + ", ".join(f"{name} binary" for name in _ARRAYS)


def _packed(tree: int, slot: int, arrays: dict) -> tuple:
    return (tree, slot, len(arrays["feature"]), *[
        np.asarray(arrays.get(name, []), kind).tobytes() for name, kind in _ARRAYS.items()])


def _unpacked(row) -> dict[str, np.ndarray]:
    return {name: np.frombuffer(row[name], kind) for name, kind in _ARRAYS.items()}


def _split_points(numbers: DataFrame, names: Sequence[str]) -> list[list[float]]:
    """At most ``BINS - 1`` increasing numbers per column: between neighbours of few distinct values, else quantiles. These
    are shifted from column to column: of two that follow from each other each splits where the other does not.
    """
    shift = [0.5 + 0.6180339887 * (i + 1) % 1 for i in range(len(names))]
    grids = [F.array(*[F.lit((j / 2 + s) / T.BINS) for j in range(2 * T.BINS - 3)]) for s in shift]
    row = numbers.agg(*[F.percentile_approx(c, grid, 10_000).alias(f"p{i}") for i, (c, grid) in enumerate(zip(names, grids))],
                      *[F.max(c).alias(f"m{i}") for i, c in enumerate(names)]).first()
    points = []
    for i, c in enumerate(names):
        every = [p for p in row[f"p{i}"] or [] if p < row[f"m{i}"]]
        found = sorted(set(every[::2]))
        if len(found) < T.BINS - 1:  # some value is frequent; are there few?
            values = sorted(r[0] for r in numbers.select(c).distinct().limit(T.BINS + 1).collect())
            if len(values) <= T.BINS:
                found = [a + (b - a) / 2 for a, b in zip(values, values[1:])]
            else:
                found = sorted({*found, *sorted(set(every) - set(found))[:T.BINS - 1 - len(found)]})
        points.append(found)
    return points


def _to_blocks(points: list[list[float]], size: int):
    """A function for ``mapInArrow``: columns of features and the label become rows ``(n, bins, label)``."""
    points = [np.array(p) for p in points]

    def packed(columns, label):
        return pa.RecordBatch.from_arrays(
            [pa.array([len(label)], pa.int32()), pa.array([T.to_bins(columns, points).tobytes()], pa.binary()),
             pa.array([label.astype(np.float64).tobytes()], pa.binary())], ["n", "bins", "label"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            while rows >= size:
                table = pa.Table.from_batches(held)
                columns = [c.to_numpy() for c in table.slice(0, size).columns]
                yield packed(columns[:-1], columns[-1])
                held, rows = table.slice(size).combine_chunks().to_batches(), rows - size
        if rows:
            columns = [c.to_numpy() for c in pa.Table.from_batches(held).columns]
            yield packed(columns[:-1], columns[-1])

    return run


class _Blocks:
    """The stored rows to train on, and what holds for the whole forest."""

    def __init__(self, data: DataFrame, features: int, classes: int, trees: int, depth: int, subset: int, seed: int):
        self.data, self.features, self.classes, self.trees = data, features, classes, trees
        self.depth, self.subset, self.seed = depth, min(subset, features), seed
        rows = np.array(data.mapInArrow(_sums, "n long, s double, ss double").agg(F.sum("n"), F.sum("s"), F.sum("ss")).first() or 0, float)
        if not np.isfinite(rows).all() or not rows[0]:
            raise ValueError("no rows to train on")
        self.rows, self.mean = int(rows[0]), 0.0 if classes else rows[1] / rows[0]
        self.floor = 1e-12 * max(0.0, rows[2] - rows[1] * rows[1] / rows[0]) + 1e-300
        self.stats = classes or 2
        self.parallel = data.sparkSession.sparkContext.defaultParallelism
        volume = trees * self.rows * 0.64 * (features + 9)
        self.local = depth > SHALLOW or volume <= LOCAL_BYTES
        self.groups = max(1, -int(-volume // LOCAL_BYTES))

    def reader(self):
        """For a task: each block's id, ``(features, rows)`` of bins and labels."""
        features, classes, mean = self.features, self.classes, self.mean

        def read(batches):
            for batch in batches:
                for block, n, bins, label in zip(*[batch.column(c) for c in ("block", "n", "bins", "label")]):
                    label = np.frombuffer(label.as_buffer(), np.float64)
                    yield block.as_py(), np.frombuffer(bins.as_buffer(), np.uint8).reshape(features, n.as_py()), (
                        label.astype(np.int64) if classes else label - mean)

        return read


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = np.zeros(3)
    for batch in batches:
        for label in batch.column("label"):
            y = np.frombuffer(label.as_buffer(), np.float64)
            found += [len(y), y.sum(), (y * y).sum()]
    yield pa.RecordBatch.from_arrays([pa.array([int(found[0])]), pa.array([found[1]]), pa.array([found[2]])], ["n", "s", "ss"])


class _Top:
    """The upper nodes of one tree, on the driver."""

    def __init__(self):
        self.feature, self.cut, self.left, self.total, self.slot = [-1], [0], [0], [None], [-1]
        self.gains = None

    def split(self, node: int, feature: int, cut: int, total, left) -> tuple[int, int]:
        first = len(self.feature)
        self.feature[node], self.cut[node], self.left[node] = feature, cut, first
        for stats in (left, total - left):
            for held, x in zip((self.feature, self.cut, self.left, self.total, self.slot), (-1, 0, 0, stats, -1)):
                held.append(x)
        return first, first + 1

    def arrays(self, classes: int, mean: float) -> dict:
        feature, slots = np.array(self.feature, np.int16), np.array(self.slot, np.int32)
        none = np.zeros(classes or 2)
        total = np.array([none if t is None else t for t in self.total])
        ptr, kinds, values = T.entries(total, (feature < 0) & (slots < 0), classes)
        return {"feature": feature, "cut": np.array(self.cut, np.uint8), "left": np.array(self.left, np.int32), "ptr": ptr,
                "classes": kinds, "values": values + mean, "gains": self.gains, "slots": slots}


def _closed(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, stride: int = 1):
    """The arrays of a tree whose leaves point to themselves, so that all rows can take equally many steps."""
    end = feature < 0
    return (np.where(end, 0, feature).astype(np.int64) * stride, np.where(end, 255, cut).astype(np.uint8),
            np.where(end, np.arange(len(left)), left).astype(np.int64))


def _steps(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, depth: int, flat: np.ndarray, base: np.ndarray, root: int = 0) -> np.ndarray:
    """The node that each row reaches in so many steps. ``flat[base + f]`` is its bin of feature ``f``."""
    at = np.full(len(base), root, np.int64)
    for _ in range(depth):
        higher = flat.take(feature.take(at) + base) > cut.take(at)
        at = left.take(at)
        at += higher
    return at


def _descend(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, depth: int, bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The node of a top in which each of ``rows`` is, from ``(features, rows)`` of bins."""
    return _steps(*_closed(feature, cut, left, bins.shape[1]), depth, bins.ravel(), rows)


def _histograms(blocks: _Blocks, level: int, jobs: list):
    """A function for ``mapInArrow``: for each ``(item, tree, top arrays, nodes, drawn features)`` of ``jobs``, the histogram
    of a task's rows in these nodes."""
    read, classes, seed = blocks.reader(), blocks.classes, blocks.seed
    width, stats = blocks.subset, blocks.stats
    by_tree = defaultdict(list)
    for job in jobs:
        by_tree[job[1]].append(job)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = {item: np.zeros((width, len(nodes) * T.BINS, stats)) for item, _, _, nodes, _ in jobs}
        for block, bins, label in read(batches):
            n, flat = bins.shape[1], bins.ravel()
            for tree, items in by_tree.items():
                copies = T.copies(seed, tree, block, n)
                rows = np.flatnonzero(copies)
                at = _descend(*items[0][2], level, bins, rows)
                for item, _, (feature, _, _), nodes, drawn in items:
                    place = np.full(len(feature), -1, np.int64)
                    place[nodes] = np.arange(len(nodes))
                    spot = place.take(at)
                    mine, here = rows, spot
                    if len(spot) and spot.min() < 0:
                        keep = spot >= 0
                        mine, here = rows[keep], spot[keep]
                    weight, y = copies[mine].astype(np.float64), label[mine]
                    weighted, first = None if classes else weight * y, here * T.BINS
                    for k in range(width):
                        if drawn is None:
                            key = first + bins[k].take(mine)
                        else:
                            key = first + flat.take(drawn[:, k].take(here) * n + mine)
                        if classes:
                            cells[item][k] += T.histogram(key, y, weight, len(nodes) * T.BINS, classes)
                        else:
                            size = len(nodes) * T.BINS
                            cells[item][k, :, 0] += np.bincount(key, weight, size)
                            cells[item][k, :, 1] += np.bincount(key, weighted, size)
        for item, found in cells.items():
            yield pa.RecordBatch.from_arrays([pa.array([item], pa.int32()), pa.array([found.tobytes()], pa.binary())], ["item", "cells"])

    return run


def _best(classes: int, floor: float, width: int, stats: int):
    """A function for ``applyInArrow``: the tasks' histograms of an item become its nodes' best splits."""

    def run(table: pa.Table) -> pa.Table:
        cells = 0
        for chunk in table.column("cells").chunks:
            for one in chunk:
                cells = cells + np.frombuffer(one.as_buffer(), np.float64)
        cells = cells.reshape(width, -1, T.BINS, stats).transpose(1, 0, 2, 3)
        slot, cut, gain, total, left = T.best_splits(cells, classes, floor)
        arrays = [slot.astype(np.int32), cut, gain, total, left]
        return pa.table({"item": table.column("item").slice(0, 1).cast(pa.int32())} | {
            name: pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for name, a in zip(("slot", "cut", "gain", "total", "left"), arrays)})

    return run


def _tops(blocks: _Blocks) -> list[_Top]:
    """Splits nodes by histograms until each is a leaf or small enough for one task; the small ones get slots."""
    tops = [_Top() for _ in range(blocks.trees)]
    for top in tops:
        top.gains = np.zeros(blocks.features)
    random = np.random.default_rng([blocks.seed, 1])
    active = {tree: [(0, blocks.rows)] for tree in range(blocks.trees)}
    spread = max(blocks.parallel, 2)
    per_node = blocks.subset * T.BINS * blocks.stats
    for level in range(blocks.depth):
        items = []
        for tree, found in active.items():
            top, large = tops[tree], []
            for node, weight in found:
                if blocks.local and weight <= LOCAL_ROWS:
                    top.slot[node] = max(top.slot) + 1
                else:
                    large.append(node)
            arrays = tuple(np.array(x) for x in (top.feature, top.cut, top.left))
            step = max(1, ITEM_CELLS // per_node)
            for first in range(0, len(large), step):
                nodes = np.array(large[first:first + step])
                drawn = None if blocks.subset == blocks.features else np.stack(
                    [random.permutation(blocks.features)[:blocks.subset] for _ in nodes])
                items.append((len(items), tree, arrays, nodes, drawn))
        if not items:
            break
        active = {tree: [] for tree in active}
        per_job = max(1, JOB_CELLS // (per_node * max(len(i[3]) for i in items)))
        for first in range(0, len(items), per_job):
            some = items[first:first + per_job]
            found = blocks.data.coalesce(spread).mapInArrow(_histograms(blocks, level, some), "item int, cells binary").repartition(
                max(1, min(len(some), 4 * spread)), "item").groupBy("item").applyInArrow(
                _best(blocks.classes, blocks.floor, blocks.subset, blocks.stats),
                "item int, slot binary, cut binary, gain binary, total binary, left binary").collect()
            for r in found:
                _, tree, _, nodes, drawn = items[r["item"]]
                total, left = (np.frombuffer(r[c], np.float64).reshape(len(nodes), -1) for c in ("total", "left"))
                for i, (node, slot, cut, gain) in enumerate(zip(nodes, np.frombuffer(r["slot"], np.int32), r["cut"], np.frombuffer(r["gain"], np.float64))):
                    top = tops[tree]
                    if slot < 0:
                        top.total[node] = total[i]
                        continue
                    feature = int(slot if drawn is None else drawn[i, slot])
                    top.gains[feature] += gain
                    for child in top.split(int(node), feature, cut, total[i], left[i]):
                        stats = top.total[child]
                        weight = stats.sum() if blocks.classes else stats[0]
                        mixed = stats.max() < weight if blocks.classes else weight > 1
                        if mixed:
                            active[tree].append((child, weight))
    return tops


def _rows_of_slots(blocks: _Blocks, tops: list[tuple], depth: int):
    """A function for ``mapInArrow``: a task's rows of each ``(tree, slot)``, a block's together."""
    read, classes, seed = blocks.reader(), blocks.classes, blocks.seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, bins, label in read(batches):
            lines = np.ascontiguousarray(bins.T)
            for tree, arrays, slots in tops:
                copies = T.copies(seed, tree, block, len(label))
                rows = np.flatnonzero(copies)
                spot = slots[_descend(*arrays, depth, bins, rows)]
                for slot in np.unique(spot[spot >= 0]):
                    mine = rows[spot == slot]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree], pa.int32()), pa.array([slot], pa.int32()), pa.array([block], pa.int64()),
                         *[pa.array([x.tobytes()], pa.binary()) for x in (lines[mine], label[mine].astype(np.float64), copies[mine])]],
                        ["tree", "slot", "block", "bins", "label", "copies"])

    return run


def _grown(blocks: _Blocks, levels: dict):
    """A function for ``applyInArrow``: the rows of a slot become its subtree."""
    classes, subset, depth, seed, floor, features, mean = (
        blocks.classes, blocks.subset, blocks.depth, blocks.seed, blocks.floor, blocks.features, blocks.mean)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        tree, slot = table.column("tree")[0].as_py(), table.column("slot")[0].as_py()
        whole = [np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(c)]) for c, kind in (
            ("bins", np.uint8), ("label", np.float64), ("copies", np.uint8))]
        label = whole[1].astype(np.int64) if classes else whole[1]
        arrays, gains = T.grow(whole[0].reshape(len(label), features), label, whole[2].astype(np.float64), classes, subset,
                               depth - levels[tree, slot], np.random.default_rng([seed, 2, tree, slot]), floor)
        values = _packed(tree, slot, arrays | {"gains": gains, "values": arrays["values"] + mean})
        kinds = [pa.int32()] * 3 + [pa.binary()] * len(_ARRAYS)
        names = ["tree", "slot", "nodes", *_ARRAYS]
        return pa.Table.from_arrays([pa.array([v], kind) for v, kind in zip(values, kinds)], names)

    return run


def _levels(top: _Top) -> dict[int, int]:
    """The level of each slot's node."""
    level = [0] * len(top.feature)
    for node, feature in enumerate(top.feature):
        if feature >= 0:
            level[top.left[node]] = level[top.left[node] + 1] = level[node] + 1
    return {slot: level[node] for node, slot in enumerate(top.slot) if slot >= 0}


def store_binned(numbers: DataFrame, names: Sequence[str], label: str) -> tuple[DataFrame, list[list[float]]]:
    """What a forest reads of the double columns ``names`` without gaps and of the label: blocks of bins, stored, and the
    features' split points."""
    points = _split_points(numbers, names)
    return materialise_blocks(numbers.select(*names, F.col(label).cast("double").alias("_label")).mapInArrow(
        _to_blocks(points, BLOCK_ROWS), "n int, bins binary, label binary").withColumn(
        "block", F.monotonically_increasing_id()), "forest-blocks"), points


def train_forest(stored: DataFrame, points: list[list[float]], classes: int, trees: int, depth: int, subset: int, seed: int,
                 output: str = "predicted") -> ForestModel:
    """A forest on rows from :func:`store_binned`. The label is a number, or with ``classes`` the number of one.

    Trees get Poisson(1) copies of each row, look at ``subset`` features drawn for each node, split by Gini impurity or
    variance and grow to ``depth`` as long as a split lowers the impurity.
    """
    spark = stored.sparkSession
    blocks = _Blocks(stored, len(points), classes, trees, depth, subset, seed)
    tops = _tops(blocks)
    arrays = [t.arrays(classes, blocks.mean) for t in tops]
    levels = {(tree, slot): level for tree, top in enumerate(tops) for slot, level in _levels(top).items()}
    pieces, base = [], scratch_dir(spark, "forest")
    waiting = [tree for tree in range(trees) if max(tops[tree].slot) >= 0]
    size = -(-len(waiting) // blocks.groups) or 1
    for first in range(0, len(waiting), size):
        some = waiting[first:first + size]
        given = [(t, tuple(arrays[t][c] for c in ("feature", "cut", "left")), arrays[t]["slots"]) for t in some]
        deep = max(levels[k] for k in levels if k[0] in set(some))
        slots = sum(1 for k in levels if k[0] in set(some))
        stored.mapInArrow(
            _rows_of_slots(blocks, given, deep), "tree int, slot int, block long, bins binary, label binary, copies binary",
        ).repartition(max(blocks.parallel, min(slots, 2000)), "tree", "slot").groupBy("tree", "slot").applyInArrow(
            _grown(blocks, levels), _SCHEMA).write.parquet(f"{base}/{first}")
        pieces.append(f"{base}/{first}")
        gc.collect()  # shuffle files go when the driver's objects for them do
        spark.sparkContext._jvm.System.gc()
    return ForestModel(arrays, spark.read.schema(_SCHEMA).parquet(*pieces) if pieces else None, points, classes, output)


def _flat(tops: list[dict], pieces: list[tuple[int, int, dict]]) -> dict[str, np.ndarray]:
    """Tops and subtrees as one set of arrays; ``roots`` are the trees' first nodes."""
    held, roots, start, votes = [], [], 0, 0
    for _, _, arrays in [(0, 0, t) for t in tops] + pieces:
        held.append({"feature": arrays["feature"].astype(np.int16), "cut": arrays["cut"], "left": arrays["left"] + start,
                     "first": arrays["ptr"][:-1].astype(np.int64) + votes, "count": np.diff(arrays["ptr"]),
                     "classes": arrays["classes"], "values": arrays["values"]})
        roots.append(start)
        start, votes = start + len(arrays["feature"]), votes + len(arrays["values"])
    flat = {name: np.concatenate([h[name] for h in held]) for name in held[0]}
    places = {(t, s): roots[len(tops) + i] for i, (t, s, _) in enumerate(pieces)}
    for tree, top in enumerate(tops):
        for node in np.flatnonzero(top["slots"] >= 0):
            root = places[tree, int(top["slots"][node])]
            for name in ("feature", "cut", "left", "first", "count"):
                flat[name][roots[tree] + node] = flat[name][root]
    steps, at = 0, np.array(roots[:len(tops)])
    while len(at := at[flat["feature"][at] >= 0]):
        at, steps = np.concatenate([flat["left"][at], flat["left"][at] + 1]), steps + 1
    return flat | {"roots": np.array(roots[:len(tops)]), "steps": steps}


def _scorer(flat: dict, points: list, width: int):
    """A function of a column of feature arrays: the sums of the trees' votes."""
    points, steps, descend = [np.array(p) for p in points], flat["steps"], _steps
    feature, cut, left = _closed(flat["feature"], flat["cut"], flat["left"])

    def run(column: pa.Array) -> pa.Array:
        n = len(column)
        numbers = column.flatten().to_numpy(zero_copy_only=False).reshape(n, len(points))
        lines = np.ascontiguousarray(T.to_bins(numbers.T, points).T).ravel()
        out = np.zeros((n, width))
        base = np.arange(n) * len(points)
        for root in flat["roots"]:
            if steps <= SHALLOW:
                leaf = descend(feature, cut, left, steps, lines, base, root)
            else:
                leaf = T.walk(lines, base, root, flat["feature"], flat["cut"], flat["left"])
            T.vote(out, slice(None), leaf, flat["first"], flat["count"], flat["classes"], flat["values"])
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(out.ravel()))

    return run


def _to_scored_blocks(points: list, size: int):
    """A function for ``mapInArrow``: ``(_row, features)`` become rows ``(n, ids, bins)``."""
    points = [np.array(p) for p in points]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        def packed():
            ids, bins = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array([rows], pa.int32()), *[
                pa.array([x.tobytes()], pa.binary()) for x in (ids, bins)]], ["n", "ids", "bins"])

        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(points))
            held.append((batch.column(0).to_numpy(), np.ascontiguousarray(T.to_bins(numbers.T, points).T)))
            rows += batch.num_rows
            if rows >= size:
                yield packed()
                held, rows = [], 0
        if rows:
            yield packed()

    return run


def _meet(tops: list[dict], width: int, features: int):
    """A function for two groups: the votes of a part's subtrees for a block's rows, in slices."""
    unpacked = _unpacked

    def run(rows: pa.Table, pieces: pa.Table) -> pa.Table:
        found = {"block": [], "slice": [], "ids": [], "votes": []}
        pieces = sorted(((p["tree"], p["slot"], p) for p in pieces.to_pylist()), key=lambda p: p[:2])
        for line in rows.to_pylist() if pieces else []:
            ids, bins = np.frombuffer(line["ids"], np.int64), np.frombuffer(line["bins"], np.uint8)
            base, out, tree = np.arange(len(ids)) * features, np.zeros((len(ids), width)), None
            for t, slot, piece in pieces:
                if t != tree:
                    tree, top = t, tops[t]
                    spot = top["slots"][T.walk(bins, base, 0, top["feature"], top["cut"], top["left"])]
                mine, arrays = np.flatnonzero(spot == slot), unpacked(piece)
                leaf = T.walk(bins, base[mine], 0, arrays["feature"], arrays["cut"], arrays["left"])
                T.vote(out, mine, leaf, arrays["ptr"], np.diff(arrays["ptr"]), arrays["classes"], arrays["values"])
            for first in range(0, len(ids), _SLICE):
                some = slice(first, first + _SLICE)
                for name, x in (("block", line["block"]), ("slice", first), ("ids", ids[some].tobytes()), ("votes", out[some].tobytes())):
                    found[name].append(x)
        return pa.table([pa.array(found[c], k) for c, k in zip(found, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], list(found))

    return run


def _added(width: int):
    """A function for ``applyInArrow``: the parts' votes for a slice of rows, added up per row."""

    def run(table: pa.Table) -> pa.Table:
        votes = sum(np.frombuffer(v.as_buffer(), np.float64) for v in table.column("votes"))
        ids = np.frombuffer(table.column("ids")[0].as_buffer(), np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * width), pa.array(votes))
        return pa.table({"_row": pa.array(ids), "_votes": lists})

    return run


class ForestModel(Model, MLWritable, MLReadable):
    """A fitted forest over the vector column ``_features``.

    A regressor adds ``output``; a classifier ``_raw``, ``_probability`` and ``_prediction``, the number of the class.
    """

    def __init__(self, tops: list[dict] | None = None, pieces: DataFrame | None = None, points: list | None = None,
                 classes: int = 0, output: str = "predicted"):
        super().__init__()
        self.tops, self.pieces, self.points, self.classes, self.output = tops, pieces, points, classes, output
        self._nodes = self._one = None

    @property
    def nodes(self) -> int:
        if self._nodes is None:
            stored = 0 if self.pieces is None else self.pieces.agg(F.sum("nodes")).first()[0] or 0
            self._nodes = stored + sum(len(t["feature"]) for t in self.tops)
        return self._nodes

    @property
    def featureImportances(self) -> DenseVector:
        """Each tree's gains in proportion, averaged and scaled to a sum of 1."""
        found = np.array([t["gains"] for t in self.tops])
        if self.pieces is not None:
            for r in self.pieces.select("tree", "gains").toLocalIterator():
                found[r["tree"]] += np.frombuffer(r["gains"], np.float64)
        whole = found.sum(axis=1, keepdims=True)
        mean = np.divide(found, whole, out=np.zeros_like(found), where=whole > 0).sum(axis=0)
        return DenseVector(mean / mean.sum() if mean.sum() > 0 else mean)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if dataset.isStreaming or self.nodes <= NARROW_NODES:
            scored = self._where_they_lie(dataset)
        else:
            scored = self._joined(dataset)
        if not self.classes:
            return scored.withColumn(self.output, F.col("_votes")[0] / F.lit(float(len(self.tops)))).drop("_votes")
        total = F.aggregate("_votes", F.lit(0.0), lambda a, x: a + x)
        return scored.withColumns({
            "_raw": array_to_vector("_votes"),
            "_probability": array_to_vector(F.transform("_votes", lambda v: v / total)),
            "_prediction": (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double"),
        }).drop("_votes")

    def _where_they_lie(self, dataset: DataFrame) -> DataFrame:
        if self._one is None:
            rows = [] if self.pieces is None else self.pieces.collect()
            self._one = _flat(self.tops, [(r["tree"], r["slot"], _unpacked(r)) for r in rows])
        run = _scorer(self._one, self.points, self.classes or 1)
        run.__annotations__ = {"column": pa.Array, "return": pa.Array}
        return dataset.withColumn("_votes", F.arrow_udf(run, "array<double>")(vector_to_array("_features")))

    def _joined(self, dataset: DataFrame) -> DataFrame:
        """Rows are stored and numbered; blocks of them meet parts of the forest, and the votes come back by the number."""
        spark, width = dataset.sparkSession, self.classes or 1
        rows = materialise(dataset.withColumn("_row", F.monotonically_increasing_id()), "forest-rows")
        count = rows.count()
        blocks = rows.select("_row", vector_to_array("_features").alias("features")).repartition(
            max(1, -(-count // SCORED_ROWS)), "_row").mapInArrow(
            _to_scored_blocks(self.points, SCORED_ROWS), "n int, ids binary, bins binary").withColumn(
            "block", F.monotonically_increasing_id())
        parts, leaves, held, part = [], [], 0, 0
        for r in sorted(self.pieces.select("tree", "slot", "nodes").collect()):
            if held and held + r["nodes"] > PART_NODES:
                held, part = 0, part + 1
            held += r["nodes"]
            parts.append((r["tree"], r["slot"], part))
        tops = []
        for tree, top in enumerate(self.tops):  # leaves of a top are subtrees of one node
            slots = top["slots"].copy()
            for node in np.flatnonzero((top["feature"] < 0) & (slots < 0)):
                slots[node] = slots.max() + 1
                ends = slice(top["ptr"][node], top["ptr"][node + 1])
                leaf = {"feature": [-1], "cut": [0], "left": [0], "ptr": [0, ends.stop - ends.start],
                        "classes": top["classes"][ends], "values": top["values"][ends]}
                leaves.append(_packed(tree, int(slots[node]), leaf))
                parts.append((tree, int(slots[node]), tree % (part + 1)))
            tops.append({name: top[name] for name in ("feature", "cut", "left")} | {"slots": slots})
        pieces = self.pieces.unionByName(spark.createDataFrame(leaves, _SCHEMA)) if leaves else self.pieces
        dealt = pieces.join(F.broadcast(spark.createDataFrame(parts, "tree int, slot int, part int")), ["tree", "slot"])
        several = materialise(blocks, "forest-scored", **{"parquet.block.row.count.limit": "4"})
        every = F.broadcast(several.select(F.col("block").alias("facing")))
        left = several.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(part))))
        right = dealt.crossJoin(every)
        spread = max(spark.sparkContext.defaultParallelism, min(2000, part + 1))
        votes = left.repartition(spread, "block", "part").groupBy("block", "part").cogroup(
            right.repartition(spread, "facing", "part").groupBy("facing", "part")).applyInArrow(
            _meet(tops, width, len(self.points)), "block long, slice int, ids binary, votes binary")
        added = votes.groupBy("block", "slice").applyInArrow(_added(width), "_row long, _votes array<double>")
        return rows.join(added, "_row").drop("_row")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model, SparkSession.active()
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={
            "points": [[float(x) for x in p] for p in m.points], "classes": m.classes, "output": m.output})
        tops = spark.createDataFrame([_packed(i, -1, t) for i, t in enumerate(m.tops)], _SCHEMA)
        tops.coalesce(1).write.parquet(f"{path}/tops")
        if m.pieces is not None:
            m.pieces.write.parquet(f"{path}/pieces")


class _Reader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        tops = [_unpacked(r) for r in sorted(spark.read.schema(_SCHEMA).parquet(f"{path}/tops").collect(), key=lambda r: r["tree"])]
        pieces = spark.read.schema(_SCHEMA).parquet(f"{path}/pieces") if any((t["slots"] >= 0).any() for t in tops) else None
        model = ForestModel(tops, pieces, metadata["points"], metadata["classes"], metadata["output"])
        model._resetUid(metadata["uid"])
        return model
