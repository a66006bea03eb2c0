"""Approximate nearest neighbours by inner product: shifted Hilbert orderings, key windows, exact rerank.

1. Vectors get one more coordinate that makes all of them equally long, so that the largest inner product is the
   smallest distance. ``CURVES`` random projections to ``DIMENSIONS`` coordinates, each with its own shift, are turned
   into Hilbert keys.
2. The keys of a curve are range-partitioned at ``SLOTS`` quantiles. A query's window on a curve is its own slot and
   ``reach`` slots to either side; candidates of all windows are merged and ranked by the exact inner product.
3. ``reach`` is measured, not guessed: for ``SAMPLE`` queries the true neighbours are found by brute force, in blocks,
   and the smallest reach that holds ``TARGET`` of them is taken. Vectors with structure need short windows; vectors
   without any (all directions alike) need windows over most of the table, and get them.
4. Work is dealt in tiles of at most about ``TILE`` rows and ``TILE`` queries; a slot that holds more (copies of one
   vector) is split by a hash, so no task holds more than a tile. Ties go to the smaller id.

Every row is indexed. Only splits, slot counts and the sample reach the driver, all of bounded size.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite components take no part, nor do those whose
length is not the most frequent one (the smaller length, if two are). A row with a NULL id can be found but is no query.
Repeated rows are rows of their own and neighbours of each other. Fewer candidates than asked for are all returned if the
windows hold them; with up to ``k`` + 1 rows windows cover everything. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import narrow, stored

CURVES = 4
DIMENSIONS = 8
BITS = 7
SLOTS = 512
SAMPLE = 192
TARGET = 0.94
TILE = 16_384


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid coordinates below ``2**bits``, by Skilling's transform: exchange
    and invert the lower bits from the highest level down, then decode the Gray code."""
    x = cells.T.astype(np.int64).copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(d):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where(x[d - 1] & q, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class Curves:
    """Projections, shifts and grid of each curve, from a seed."""

    def __init__(self, length: int, largest: float, curves: int = CURVES, dimensions: int = DIMENSIONS,
                 bits: int = BITS, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.largest, self.bits = largest, bits
        self.spread = 3.0 / np.sqrt(length + 1)
        dimensions = min(dimensions, length + 1)
        self.projections = [np.linalg.qr(rng.normal(size=(length + 1, dimensions)))[0] for _ in range(curves)]
        self.shifts = [rng.uniform(-0.5, 0.5, dimensions) * self.spread / 4 for _ in range(curves)]

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / self.largest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1)))
        full = np.concatenate([unit, rest[:, None]], axis=1)
        out = []
        for projection, shift in zip(self.projections, self.shifts):
            at = (full @ projection + shift) / (2 * self.spread) + 0.5
            cells = np.clip((at * (1 << self.bits)).astype(np.int64), 0, (1 << self.bits) - 1)
            out.append(hilbert_keys(cells, self.bits))
        return np.stack(out, axis=1)


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """Rows of a list column, all of one length, in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), length)


def orderable(ids: np.ndarray) -> np.ndarray:
    """Order keys to break ties by, as numpy sorts them."""
    return np.asarray(ids, dtype=str)


def order_key(id: str, kind: T.DataType) -> Column:
    """Text that sorts like the ids, NULL last. In numpy ids are this text: whole numbers beside a NULL would become
    floating point there."""
    text = F.col(id).cast("string")
    if isinstance(kind, T.IntegralType):
        text = F.lpad((F.col(id).cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.coalesce(text, F.lit("\uffff"))


def usable(vector: Column) -> Column:
    d = vector.cast("array<double>")
    bad = F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(d, lambda x: x != 0), F.lit(False))


def exact_best(rows: np.ndarray, ids: np.ndarray, query: np.ndarray, near: np.ndarray, floor: float, k: int):
    """Indices and scores of the best ``k`` rows: those of ``near`` scores from ``floor`` on, scored again one by one so
    that equal vectors tie exactly, and ranked by score, then id."""
    at = np.flatnonzero(near >= floor - 1e-9 * (1 + abs(floor)))
    score = (rows[at] * query).sum(axis=1)
    best = np.lexsort((ids[at], -score))[:k]
    return at[best], score[best]


def search_tile(rows: np.ndarray, ids: np.ndarray, row_at: np.ndarray, queries: np.ndarray, query_at: np.ndarray,
                low: np.ndarray, high: np.ndarray, k: int):
    """(query index, row indices, scores) for each query against rows[low:high], itself left out."""
    for start in range(0, len(queries), 128):
        block = queries[start:start + 128]
        a, b = int(low[start:start + 128].min()), int(high[start:start + 128].max())
        if a >= b:
            continue
        scores = block @ rows[a:b].T
        places = np.arange(a, b)
        for i in range(len(block)):
            q = start + i
            s = scores[i]
            s[(places < low[q]) | (places >= high[q]) | (row_at[a:b] == query_at[q])] = -np.inf
            valid = int(np.isfinite(s).sum())
            if not valid:
                continue
            n = min(k, valid)
            floor = np.partition(s, len(s) - n)[len(s) - n]
            at, score = exact_best(rows[a:b], ids[a:b], block[i], s, floor, n)
            yield q, at + a, score


def with_keys(curves: Curves, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = curves.keys(matrix(batch.column(2), length)) if batch.num_rows else np.zeros((0, CURVES), np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(keys[:, c]) for c in range(keys.shape[1])]],
                [*batch.schema.names, *[f"key{c}" for c in range(keys.shape[1])]])

    return run


def sample_scores(queries: pd.DataFrame, length: int, k: int):
    """A function for ``mapInArrow``: the best ``k`` rows of each batch for each sampled query, with their slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = np.stack(queries["vector"].to_list()).astype(np.float64)
        at = queries["at"].to_numpy()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, n = matrix(batch.column(2), length), batch.num_rows
            ids = orderable(batch.column(1).to_numpy(zero_copy_only=False))
            found = list(search_tile(rows, ids, batch.column(0).to_numpy(), q, at, np.zeros(len(q), int),
                                     np.full(len(q), n), k))
            if not found:
                continue
            picked = np.concatenate([r for _, r, _ in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(at[[i for i, _, _ in found]], [len(r) for _, r, _ in found])),
                 pa.array(np.concatenate([s for _, _, s in found])),
                 *[batch.column(i).take(pa.array(picked)) for i in (1, *range(3, batch.num_columns))]],
                ["query", "score", "id", *batch.schema.names[3:]])

    return run


def ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def tile_search(k: int, reach: int):
    """A function for cogrouped pandas: one tile of rows against one tile of queries."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["query", "at", "id", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame({c: [] for c in columns})
        left = left.sort_values(["slot", "at"], kind="stable")
        rows = np.stack(left["vector"].to_list()).astype(np.float64)
        ids = orderable(left["id"].to_numpy())
        slots, at = left["slot"].to_numpy(), left["at"].to_numpy()
        queries = np.stack(right["vector"].to_list()).astype(np.float64)
        mine = right["slot"].to_numpy()
        low, high = np.searchsorted(slots, mine - reach, "left"), np.searchsorted(slots, mine + reach, "right")
        out = [(np.full(len(r), right["at"].iat[q]), at[r], left["id"].to_numpy()[r], s) for q, r, s in search_tile(
            rows, ids, at, queries, right["at"].to_numpy(), low, high, k)]
        if not out:
            return pd.DataFrame({c: [] for c in columns})
        return pd.DataFrame({c: np.concatenate([x[i] for x in out]) for i, c in enumerate(columns)})

    return run


def tiles(counts: dict[tuple[int, int], tuple[int, int]], curves: int, slots: int, reach: int, tile: int):
    """Of each (curve, slot): its block, into how many row tiles the block is split, and into how many query tiles.

    A block is a run of slots with at most ``tile`` rows, or one slot with more, which is split.
    """
    out, visits = [], []
    for c in range(curves):
        block, rows, members = 0, 0, []
        blocks: list[tuple[list[int], int]] = []
        for s in range(slots):
            n = counts.get((c, s), (0, 0))[0]
            if members and rows + n > tile:
                blocks.append((members, rows))
                members, rows = [], 0
            members.append(s)
            rows += n
        blocks.append((members, rows))
        for block, (members, rows) in enumerate(blocks):
            near = range(max(0, members[0] - reach), min(slots, members[-1] + reach + 1))
            queries = sum(counts.get((c, s), (0, 0))[1] for s in near)
            split, parts = max(1, -(-rows // tile)), max(1, -(-queries // tile))
            out += [(c, s, block, split, parts) for s in members]
            visits += [(c, s, block, split, parts) for s in near]
    return out, visits


def nearest(vectors: DataFrame, is_query: Column, k: int, id: str = "vec_id", vector: str = "embedding",
            target: float = TARGET, sample: int = SAMPLE, tile: int = TILE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the nearest found of each query. ``is_query`` is a condition on
    the column ``id``; a row's own is left out."""
    spark = vectors.sparkSession
    read = narrow(vectors, id=id, vector=vector).filter(usable(F.col("vector")))
    asked = F.coalesce(is_query, F.lit(False))
    sized = read.select(F.monotonically_increasing_id().alias("at"), order_key("id", read.schema["id"].dataType).alias("key"),
                        "vector", F.col("id").alias("own"), asked.alias("asked")).withColumnRenamed("key", "id")
    lengths = read.groupBy(F.size("vector").alias("length")).agg(
        F.count("*").alias("n"),
        F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).alias("m"))
    most = lengths.orderBy(F.desc("n"), "length").first()
    kind = read.schema["id"].dataType
    if most is None:
        return spark.createDataFrame([], f"query_id {kind.simpleString()}, rank int, vec_id {kind.simpleString()}, "
                                         "score double")
    length, total = most["length"], most["n"]
    curves = Curves(length, most["m"])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sized.schema.fields)
    keys = [f"key{c}" for c in range(CURVES)]
    keyed = stored(sized.filter(F.size("vector") == length).mapInArrow(
        with_keys(curves, length), fields + "".join(f", {x} long" for x in keys)), "neighbours-keys")
    cuts = [(i + 1) / SLOTS for i in range(SLOTS - 1)]
    splits = keyed.agg(*[F.percentile_approx(x, cuts, 20_000).alias(x) for x in keys]).first()
    bounds = {c: np.unique(np.array(splits[x], dtype=np.int64)) for c, x in enumerate(keys)}

    def in_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], *[pa.array(np.searchsorted(bounds[c], batch.column(5 + c).to_numpy(), "left"),
                                                pa.int32()) for c in range(CURVES)]],
                ["at", "id", "vector", "own", "asked", *[f"slot{c}" for c in range(CURVES)]])

    slots = [f"slot{c}" for c in range(CURVES)]
    placed = stored(keyed.mapInArrow(in_slots, fields + "".join(f", {s} int" for s in slots)), "neighbours-slots")
    queries = placed.filter("asked")
    chosen = queries.orderBy(F.xxhash64("at")).limit(sample).select("at", "vector", *slots).toPandas()
    if not len(chosen):
        return spark.createDataFrame([], f"query_id {kind.simpleString()}, rank int, vec_id {kind.simpleString()}, "
                                         "score double")
    truth = ranked(placed.select("at", "id", "vector", *slots).mapInArrow(
        sample_scores(chosen[["at", "vector"]], length, k), "query long, score double, id string, "
        + ", ".join(f"{s} int" for s in slots)), k).toPandas()
    own = chosen.set_index("at")[slots]
    gaps = np.min(np.abs(truth[slots].to_numpy() - own.loc[truth["query"]].to_numpy()), axis=1) if len(truth) else [0]
    reach = int(np.sort(gaps)[min(len(gaps) - 1, int(np.ceil(target * len(gaps))) - 1)])
    merged = stored(ranked(by_windows(placed, slots, reach, k, tile), k), "neighbours-merged")
    while reach < SLOTS:  # windows of a few queries may hold fewer rows than are asked for: these search wider
        full = merged.filter(F.col("rank") == min(k, total - 1)).select(F.col("query").alias("at"))
        short = stored(queries.select("at").join(full, "at", "left_anti"), "neighbours-short")
        if total < 2 or not short.limit(1).count():
            break
        reach = min(SLOTS, max(8, 4 * reach))
        again = placed.drop("asked").join(short.withColumn("asked", F.lit(True)), "at", "left").withColumn(
            "asked", F.coalesce("asked", F.lit(False)))
        more = ranked(by_windows(again, slots, reach, k, tile), k)
        merged = stored(merged.join(short.withColumnRenamed("at", "query"), "query", "left_anti").unionByName(more),
                        "neighbours-merged")
    names = placed.select("at", "own")
    return merged.join(names.toDF("query", "query_id"), "query").join(names.toDF("at", "vec_id"), "at").select(
        "query_id", "rank", "vec_id", "score")


def by_windows(placed: DataFrame, slots: list[str], reach: int, k: int, tile: int) -> DataFrame:
    """(query, at, id, score): the best rows of each tile within ``reach`` slots of the rows that are ``asked``."""
    spark = placed.sparkSession
    long_form = placed.select("at", "id", "vector", "asked", F.posexplode(F.array(*slots)).alias("curve", "slot"))
    counts = {(r["curve"], r["slot"]): (r["n"], r["q"]) for r in placed.select(
        "asked", F.posexplode(F.array(*slots)).alias("curve", "slot")).groupBy("curve", "slot").agg(
        F.count("*").alias("n"), F.sum(F.col("asked").cast("int")).alias("q")).collect()}
    homes, visits = tiles(counts, CURVES, SLOTS, reach, tile)
    shape = "curve int, slot int, block int, split int, parts int"
    left = long_form.join(F.broadcast(spark.createDataFrame(homes, shape)), ["curve", "slot"]).select(
        "curve", "block", F.pmod(F.xxhash64("at"), "split").cast("int").alias("row_tile"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("query_tile"), "slot", "at", "id", "vector")
    right = long_form.filter("asked").join(F.broadcast(spark.createDataFrame(visits, shape)), ["curve", "slot"]).select(
        "curve", "block", F.explode(F.sequence(F.lit(0), F.col("split") - 1)).alias("row_tile"),
        F.pmod(F.xxhash64("at"), "parts").cast("int").alias("query_tile"), "slot", "at", "vector").toDF(
        "curve", "block", "row_tile", "query_tile", "slot", "at", "vector")
    by = ["curve", "block", "row_tile", "query_tile"]
    found = stored(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(
        tile_search(k, reach), "query long, at long, id string, score double"), "neighbours-found")
    return found.dropDuplicates(["query", "at"])
