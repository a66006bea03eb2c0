"""A stored approximate neighbour index: hash tables of random hyperplanes, probed at several buckets.

A vector of length 1, less the catalogue's mean, lies on one side or the other of each of a table's hyperplanes: those
signs are its bucket. Near vectors share a bucket in some table. A query also probes the buckets across the hyperplanes
it lies closest to, nearest first.

The index is two Parquet folders: ``rows`` (one row per table and vector, sorted by bucket) and ``sizes``; ``about`` holds
its few numbers. A search joins probes and rows by table and region: buckets that share their upper bits, together about
``BLOCK_ROWS`` rows. So a query travels once to each region in which it probes buckets, with the list of them, and leaves it with
its best pairs over all of them. Large regions are cut into blocks and much probed ones into shares, so every group handed to
Python is bounded; similarities are matrix products, bucket by bucket, and only a group's best pairs become rows. Of equal vectors the index keeps the first ``most`` + 1 ids and a search asks once, so copies neither
fill a bucket nor multiply the work.

How many buckets to probe is measured, not guessed: :func:`probes_for` finds, for sampled queries and their exact
neighbours, how far down the probe order the neighbours lie. Queries for which the probed buckets hold too few rows are
answered exactly, so nobody gets a short list.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.constants import SEED
from cadenza.operators import similar
from cadenza.operators.sampling import seeded_sample
from cadenza.session import materialise, small_side

TABLES = 8
ROWS_PER_BUCKET = 256
MOST = 100
MAX_PROBES = 256
BLOCK_ROWS = 100_000
PAIRS = 2_000_000
SAMPLE = 128
RECALL = 0.95

_top_pairs = similar._top_pairs


@dataclass(frozen=True)
class Hasher:
    """Hyperplanes ``planes[table, bit]`` through ``center``."""

    planes: np.ndarray
    center: np.ndarray

    @classmethod
    def of(cls, tables: int, bits: int, center, seed: int) -> Hasher:
        normals = np.random.default_rng(seed).standard_normal((tables, bits, len(center)))
        return cls(normals / np.linalg.norm(normals, axis=2, keepdims=True), np.asarray(center))

    def margins(self, units: np.ndarray) -> np.ndarray:
        """Signed distances to all hyperplanes: (row, table, bit)."""
        tables, bits, d = self.planes.shape
        return ((units - self.center) @ self.planes.reshape(-1, d).T).reshape(len(units), tables, bits)

    def buckets(self, margins: np.ndarray) -> np.ndarray:
        return ((margins > 0) << np.arange(margins.shape[2])).sum(axis=2, dtype=np.int64)

    def probes(self, margins: np.ndarray, count: int) -> np.ndarray:
        """Buckets in the order of the squared distance to the hyperplanes crossed: (row, table, probe)."""
        bits = margins.shape[2]
        near = min(bits, max(1, math.ceil(math.log2(count)) + 4))  # the bits that may be crossed
        step = max(1, 4_000_000 // (margins.shape[1] << near))
        if len(margins) > step:
            return np.concatenate([self.probes(margins[a:a + step], count) for a in range(0, len(margins), step)])
        order = np.argsort(np.abs(margins), axis=2, kind="stable")[:, :, :near]
        cost = np.take_along_axis(margins**2, order, axis=2)
        crossed = np.arange(1 << near)[:, None] >> np.arange(near) & 1
        total = cost @ crossed.T.astype(float)
        best = np.argsort(total, axis=2, kind="stable")[:, :, :count]
        flips = (1 << order.astype(np.int64)) @ crossed.T.astype(np.int64)
        return self.buckets(margins)[:, :, None] ^ np.take_along_axis(flips, best, axis=2)


@dataclass(frozen=True)
class LshIndex:
    """A written index: its folder, hasher and the number of ids kept of equal vectors."""

    path: str
    hasher: Hasher
    most: int

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows")

    def sizes(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/sizes")


def _mean_unit(vectors: DataFrame) -> list[float]:
    """Mean of the unit vectors; one pass, one number per dimension."""
    units = similar.unit_rows

    def sums(batches):
        import pandas as pd

        for batch in batches:
            if len(batch):
                total = units(batch["vector"].tolist()).sum(axis=0)
                yield pd.DataFrame({"at": np.arange(len(total), dtype=np.int32), "total": total, "n": len(batch)})

    rows = vectors.mapInPandas(sums, "at int, total double, n long").groupBy("at").agg(
        (F.sum("total") / F.sum("n")).alias("mean")).collect()
    return [r["mean"] for r in sorted(rows, key=lambda r: r["at"])]


def write_index(catalogue: DataFrame, path: str, id_col: str = "track_id", vector: str = "vector", tables: int = TABLES,
                rows_per_bucket: int = ROWS_PER_BUCKET, most: int = MOST, seed: int = SEED) -> LshIndex:
    """Write the index of ``catalogue`` (unique ids) to the new folder ``path``. It answers up to ``most`` neighbours.

    Rows without an id or a whole vector take no part. An empty catalogue gives an empty index.
    """
    spark = catalogue.sparkSession
    usable = similar._narrow(catalogue, id_col, vector)
    copies = Window.partitionBy("vector").orderBy("id")
    kept = materialise(usable.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= most + 1).drop("copy"),
                       "lsh-rows")
    n, center = kept.count(), _mean_unit(kept)
    bits = max(1, min(40, math.ceil(math.log2(max(2, n / rows_per_bucket)))))
    hasher = Hasher.of(tables, bits, center or [0.0], seed)
    shared = spark.sparkContext.broadcast(hasher)
    units, pack = similar.unit_rows, similar._pack

    def place(batches):
        import pandas as pd

        h = shared.value
        for batch in batches:
            if not len(batch):
                continue
            vectors = units(batch["vector"].tolist())
            buckets = h.buckets(h.margins(vectors))
            packed = pack(vectors)
            for t in range(buckets.shape[1]):
                yield pd.DataFrame({"table": np.int32(t), "bucket": buckets[:, t], "id": batch["id"], "vector": packed})

    placed = kept.mapInPandas(place, f"table int, bucket long, id {similar._id_type(kept)}, vector binary")
    placed.sort("table", "bucket").write.parquet(f"{path}/rows")
    spark.read.parquet(f"{path}/rows").groupBy("table", "bucket").agg(F.count("*").alias("n")).write.parquet(f"{path}/sizes")
    about = [(tables, bits, seed, most, [float(x) for x in hasher.center])]
    spark.createDataFrame(about, "tables int, bits int, seed long, most int, center array<double>").coalesce(1).write.json(
        f"{path}/about")
    return LshIndex(path, hasher, most)


def read_index(spark: SparkSession, path: str) -> LshIndex:
    r = spark.read.schema("tables int, bits int, seed long, most int, center array<double>").json(f"{path}/about").first()
    return LshIndex(path, Hasher.of(r["tables"], r["bits"], r["center"], r["seed"]), r["most"])


def probes_for(index: LshIndex, queries: DataFrame, catalogue: DataFrame, k: int, id_col: str = "track_id",
               vector: str = "vector", recall: float = RECALL, sample: int = SAMPLE, seed: int = SEED) -> tuple[int, float]:
    """The least number of probes per table that finds ``recall`` of the exact neighbours of ``sample`` queries, and the
    share it finds there; ``MAX_PROBES`` if even those find less."""
    picked = seeded_sample(similar._narrow(queries, id_col, vector), "id", sample, seed)
    exact = similar.nearest(picked, similar._narrow(catalogue, id_col, vector), k, "id")
    near = exact.join(similar._narrow(catalogue, id_col, vector), "id").select("query_id", F.col("vector").alias("found"))
    rows = near.join(picked.withColumnRenamed("id", "query_id"), "query_id").select("vector", "found").collect()
    if not rows:
        return 1, 1.0
    h = index.hasher
    probed = h.probes(h.margins(similar.unit_rows([r["vector"] for r in rows])), min(MAX_PROBES, 1 << h.planes.shape[1]))
    lies = h.buckets(h.margins(similar.unit_rows([r["found"] for r in rows])))
    hit = probed == lies[:, :, None]
    first = np.where(hit.any(axis=2), hit.argmax(axis=2), MAX_PROBES).min(axis=1)
    needed = int(np.quantile(first, recall, method="higher")) + 1
    needed = min(needed, probed.shape[2])
    return needed, float((first < needed).mean())


def _region_shift(n: int, bits: int) -> int:
    """How many lower bits of a bucket do not tell its region, for ``n`` rows of a table."""
    return bits - min(bits, max(0, math.ceil(math.log2(max(1, n) / BLOCK_ROWS))))


def _asks(probed: np.ndarray, shift: int):
    """The probed buckets (row, table, probe) in order of row, table and bucket, and where another region begins:
    rows, tables, buckets, starts."""
    import numpy as np

    ordered = np.sort(probed.astype(np.int64), axis=2)
    rows, tables, _ = np.indices(ordered.shape).reshape(3, -1)
    buckets = ordered.ravel()
    new = np.ones(len(buckets), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (tables[1:] != tables[:-1]) | (buckets[1:] >> shift != buckets[:-1] >> shift)
    return rows, tables, buckets, np.flatnonzero(new)


def _bucket_pairs(queries, at, asked, vectors, buckets, k, digits, pairs):
    """Each query's ``k`` best rows over the buckets it asks for: numbers of queries and of rows, similarities.

    ``at`` and ``asked`` list numbers of queries with the buckets they ask for; rows of equal similarity count in their
    order. Whenever about ``pairs`` pairs have come up they are cut to the best ones, and later ones must come up to those.
    """
    import numpy as np

    def best(found):
        a, b, s = (np.concatenate([f[i] for f in found]) for i in range(3))
        order = np.lexsort((b, -s, a))
        a, b, s = a[order], b[order], s[order]
        place = np.arange(len(a)) - np.searchsorted(a, a, side="left")
        floor[a[place == k - 1]] = s[place == k - 1]
        return a[place < k], b[place < k], s[place < k]

    floor = np.full(len(queries), -np.inf)
    order, by = np.argsort(buckets, kind="stable"), np.argsort(asked, kind="stable")
    buckets, at, asked = buckets[order], at[by], asked[by]
    names, starts = np.unique(buckets, return_index=True)
    ends = np.append(starts[1:], len(buckets))
    firsts, lasts = np.searchsorted(asked, names, side="left"), np.searchsorted(asked, names, side="right")
    found, new = [(at[:0], order[:0], np.zeros(0))], 0
    for start, end, first, last in zip(starts, ends, firsts, lasts):
        if first == last:
            continue
        some, rows = at[first:last], order[start:end]
        a, b, s = _top_pairs(some, queries[some], rows, vectors[rows], k, False, digits)
        good = s >= floor[a]
        found.append((a[good], b[good], s[good]))
        new += int(good.sum())
        if new > pairs:
            found, new = [best(found)], 0
    return best(found)


def lsh_nearest(index: LshIndex, queries: DataFrame, k: int, probes: int, catalogue: DataFrame | None = None,
                id_col: str = "track_id", vector: str = "vector", exclude_self: bool = True) -> DataFrame:
    """About the ``k`` most similar rows of the index for every query: ``(query_id, id, similarity, rank)``.

    With ``catalogue``, queries whose probed buckets held fewer than ``k`` rows are searched exactly in it.
    """
    places = k + 1 if exclude_self else k
    if places > index.most + 1:
        raise ValueError(f"the index answers up to {index.most} neighbours")
    spark = queries.sparkSession
    asked = similar._narrow(queries, id_col, vector)
    once = materialise(asked.groupBy("vector").agg(F.min("id").alias("id")), "lsh-queries")
    shared = spark.sparkContext.broadcast(index.hasher)
    units, pack = similar.unit_rows, similar._pack

    bits = index.hasher.planes.shape[1]
    held = index.sizes(spark).groupBy("table").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    shift = _region_shift(held, bits)
    narrow = np.min_scalar_type((1 << bits) - 1)
    asks = _asks

    def probe(batches):
        h = shared.value
        for whole in batches:
            for start in range(0, len(whole), 1000):
                batch = whole.iloc[start:start + 1000][["id"]].copy()
                vectors = units(whole["vector"].iloc[start:start + 1000].tolist())
                batch["vector"] = pack(vectors)
                batch["probed"] = pack(h.probes(h.margins(vectors), probes).astype(narrow))
                yield batch

    def lists(batch):
        tables = shared.value.planes.shape[0]
        probed = np.frombuffer(b"".join(batch["probed"]), dtype=narrow).reshape(len(batch), tables, -1)
        return asks(probed, shift)

    def count(batches):
        import pandas as pd

        for batch in batches:
            if len(batch):
                _, tables, buckets, starts = lists(batch)
                told = pd.DataFrame({"table": tables[starts].astype(np.int32), "region": buckets[starts] >> shift})
                yield told.groupby(["table", "region"]).size().reset_index(name="asked")

    def visit(batches):
        import pandas as pd

        for whole in batches:
            for start in range(0, len(whole), 1000):
                batch = whole.iloc[start:start + 1000]
                rows, tables, buckets, starts = lists(batch)
                parts = np.split(buckets, starts[1:])
                yield pd.DataFrame({
                    "table": tables[starts].astype(np.int32), "region": buckets[starts] >> shift,
                    "id": batch["id"].to_numpy()[rows[starts]], "vector": batch["vector"].to_numpy()[rows[starts]],
                    "asks": [x.astype(narrow).tobytes() for x in parts]})

    t = similar._id_type(once)
    probed = materialise(once.mapInPandas(probe, f"id {t}, vector binary, probed binary"), "lsh-probed")
    key = ["table", "region"]
    region = F.shiftright("bucket", shift).alias("region")
    asked_of = probed.select("probed").mapInPandas(count, "table int, region long, asked long").groupBy(*key).agg(
        F.sum("asked").alias("asked"))
    sizes = index.sizes(spark).select("table", region, "n").groupBy(*key).agg(F.sum("n").alias("n"))
    plan = small_side(materialise(asked_of.join(sizes, key).select(
        *key, F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"),
        F.ceil(F.col("asked") / BLOCK_ROWS).cast("int").alias("shares")), "lsh-plan"))
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    group = [*key, "block", "share"]
    visits = probed.mapInPandas(visit, f"table int, region long, id {t}, vector binary, asks binary")
    askers = visits.join(plan, key).withColumn("share", dealt("shares")).withColumn("block", every("blocks"))
    targets = index.rows(spark).withColumn("region", region).join(plan, key).withColumn("block", dealt("blocks")).withColumn(
        "share", every("shares"))
    digits, bucket_pairs, unpack, pairs_at_once = similar.DIGITS, _bucket_pairs, similar._unpack, PAIRS

    def score(left, right):
        import pandas as pd

        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": left["id"][:0], "id": right["id"][:0], "similarity": []})
        right = right.sort_values("id", kind="stable")  # equal similarities go to the smaller id
        at = np.repeat(np.arange(len(left)), left["asks"].str.len().to_numpy() // narrow.itemsize)
        asked = np.frombuffer(b"".join(left["asks"]), dtype=narrow).astype(np.int64)
        a, b, s = bucket_pairs(unpack(left["vector"].tolist()), at, asked, unpack(right["vector"].tolist()),
                               right["bucket"].to_numpy(), places, digits, pairs_at_once)
        return pd.DataFrame({"query_id": left["id"].to_numpy()[a], "id": right["id"].to_numpy()[b], "similarity": s})

    pairs = askers.select(*group, "id", "vector", "asks").groupBy(*group).cogroup(
        targets.select(*group, "bucket", "id", "vector").groupBy(*group)).applyInPandas(
        score, f"query_id {t}, id {t}, similarity double").repartition("query_id")
    # the same pair may meet in several tables
    best = similar._ranked(pairs.groupBy("query_id", "id").agg(F.max("similarity").alias("similarity")), places)
    lists = best.groupBy("query_id").agg(F.collect_list(F.struct("similarity", "id")).alias("found"))  # at most ``places``
    answers = once.join(lists, F.col("id") == F.col("query_id")).select("vector", "found")
    mine = asked.select(F.col("id").alias("query_id"), "vector").join(answers, "vector")
    out = mine.select("query_id", F.explode("found").alias("f")).select("query_id", "f.id", "f.similarity")
    if exclude_self:
        out = out.filter(F.col("id") != F.col("query_id"))
    found = materialise(similar._ranked(out, k), "lsh-found")
    if catalogue is None:
        return found
    full = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = materialise(asked.join(full, "id", "left_anti"), "lsh-short")
    if not short.limit(1).count():
        return found
    exact = similar.nearest(short, similar._narrow(catalogue, id_col, vector), k, "id", exclude_self=exclude_self)
    return found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(exact)
