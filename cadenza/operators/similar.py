"""Exact cosine neighbours.

Three ways to the same result, chosen by size:

* the catalogue is small: it is sent to the tasks that hold the queries, nothing is shuffled;
* the queries are few: they are sent to the tasks that hold the catalogue, each task keeps its k
  best per query, and only those are shuffled;
* neither: catalogue rows are put into cells around sampled pivots. A query is compared with one
  block near it to learn how good a neighbour must be, then only with the cells that can hold a
  better one (Cauchy-Schwarz on the cell radius). Cells travel in regions, so a query is sent once
  to each region and not once to each of its cells. The result is the same as without cells.

Inside a task, similarities are matrix products over Arrow batches. No pair of query and candidate
becomes a row unless it is among a task's k best. Similarities are rounded to ``DIGITS`` places
before they are compared; ties go to the smaller id. A zero vector has similarity 0 to everything.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.constants import SEED
from cadenza.operators.sampling import seeded_sample
from cadenza.session import materialise, small_side

DIGITS = 9
SMALL_CATALOGUE = 32_768
SMALL_QUERIES = 4_096
_SMALL_VALUES = 8_000_000  # 64 MB of doubles
_BLOCK_ROWS = 60_000
_LEAST_ROWS = 4_096
_DENSE = 0.25
_NO_PAIR = -9.0


def unit_rows(vectors) -> np.ndarray:
    """Rows scaled to length 1; zero rows stay zero."""
    matrix = np.asarray(vectors, dtype=float)
    length = np.sqrt((matrix * matrix).sum(axis=1))
    return matrix / np.where(length > 0, length, 1.0)[:, None]


def _best(similarity, ids, k):
    """Row and column numbers of each row's k best entries. Columns must be in id order."""
    import numpy as np

    n = similarity.shape[1]
    if n > k:
        least = np.partition(similarity, n - k, axis=1)[:, n - k]
        rows, columns = np.nonzero(similarity >= least[:, None])
    else:
        rows, columns = np.nonzero(similarity > -9.0)
    score = similarity[rows, columns]
    order = np.lexsort((columns, -score, rows))
    rows, columns, score = rows[order], columns[order], score[order]
    first = np.searchsorted(rows, rows, side="left")
    keep = (np.arange(len(rows)) - first < k) & (score > -9.0)
    return rows[keep], columns[keep], score[keep]


def _top_pairs(query_ids, queries, ids, vectors, k, exclude_self, digits, cells=2_000_000):
    """k best (query, candidate, similarity) triples per query, as three arrays."""
    import numpy as np

    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    step = max(1, cells // max(1, len(ids)))
    found = []
    for start in range(0, len(query_ids), step):
        part = query_ids[start:start + step]
        similarity = np.round(queries[start:start + step] @ vectors.T, digits)
        if exclude_self:
            place = np.minimum(np.searchsorted(ids, part), len(ids) - 1)
            own = np.nonzero(ids[place] == part)[0]
            similarity[own, place[own]] = -9.0
        rows, columns, score = _best(similarity, ids, k)
        found.append((part[rows], ids[columns], score))
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def _narrow(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """Ids and vectors; rows without either, or with a NULL or NaN component, have no similarity and take no part."""
    narrow = df.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    whole = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x))
    return narrow.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & whole)


def _pack(matrix) -> list[bytes]:
    """Rows as bytes: much cheaper to move between Spark and numpy than arrays."""
    return [row.tobytes() for row in matrix]


def _unpack(packed):
    import numpy as np

    return np.frombuffer(b"".join(packed), dtype=float).reshape(len(packed), -1)


def _bounded(df: DataFrame, limit: int):
    """Ids and unit vectors of a table of at most ``limit`` rows, else None."""
    width = df.agg(F.max(F.size("vector"))).first()[0] or 1
    limit = min(limit, _SMALL_VALUES // max(1, width))  # known before any vector is fetched
    rows = df.limit(limit + 1).toArrow()
    n = rows.num_rows
    ids = rows["id"].to_pandas().to_numpy()
    if n == 0:
        return ids, np.zeros((0, 1))
    vectors = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    if n > limit:
        return None
    return ids, unit_rows(vectors.reshape(n, -1))


def _id_type(df: DataFrame) -> str:
    return df.schema["id"].dataType.simpleString()


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(queries: DataFrame, catalogue: DataFrame, k: int, id_col: str = "track_id",
            vector: str = "vector", exclude_self: bool = True, strategy: str | None = None,
            small_rows: int | None = None) -> DataFrame:
    """The ``k`` most similar catalogue rows of every query: ``(query_id, id, similarity, rank)``.

    Ids must be unique on both sides. ``strategy`` forces ``"catalogue"``, ``"queries"`` or ``"cells"``;
    ``small_rows`` replaces the bounds up to which a side counts as small.
    """
    q, c = _narrow(queries, id_col, vector), _narrow(catalogue, id_col, vector)
    if strategy in (None, "catalogue"):
        small = _bounded(c, small_rows or SMALL_CATALOGUE)
        if small is not None:
            return _small_catalogue(q, small, k, exclude_self)
    if strategy in (None, "queries"):
        small = _bounded(q, small_rows or SMALL_QUERIES)
        if small is not None:
            return _small_queries(c, small, k, exclude_self)
    if strategy in ("catalogue", "queries"):
        raise ValueError(f"too many rows on the {strategy} side")
    return _by_cells(q, c, k, exclude_self)


def _small_catalogue(q, small, k, exclude_self) -> DataFrame:
    shared = q.sparkSession.sparkContext.broadcast(small)
    digits, top_pairs, units = DIGITS, _top_pairs, unit_rows

    def score(batches):
        import numpy as np
        import pandas as pd

        ids, vectors = shared.value
        for batch in batches:
            if not len(batch) or not len(ids):
                continue
            queries = units(batch["vector"].tolist())
            query_ids = batch["id"].to_numpy()
            a, b, s = top_pairs(query_ids, queries, ids, vectors, k, exclude_self, digits)
            frame = pd.DataFrame({"query_id": a, "id": b, "similarity": s})
            frame["rank"] = frame.groupby("query_id", sort=False).cumcount().astype(np.int32) + 1
            yield frame

    t = _id_type(q)
    return q.mapInPandas(score, f"query_id {t}, id {t}, similarity double, rank int")


def _small_queries(c, small, k, exclude_self) -> DataFrame:
    shared = c.sparkSession.sparkContext.broadcast(small)
    digits, top_pairs, units = DIGITS, _top_pairs, unit_rows

    def score(batches):
        import pandas as pd

        query_ids, queries = shared.value
        kept = []
        for batch in batches:
            if not len(batch) or not len(query_ids):
                continue
            ids = batch["id"].to_numpy()
            a, b, s = top_pairs(query_ids, queries, ids, units(batch["vector"].tolist()), k, exclude_self, digits)
            kept.append(pd.DataFrame({"query_id": a, "id": b, "similarity": s}))
            if sum(map(len, kept)) > 2_000_000:
                kept = [_merge(kept, k)]
        if kept:
            yield _merge(kept, k)

    def _merge(frames, k):
        merged = pd_concat(frames).sort_values(["query_id", "similarity", "id"], ascending=[True, False, True])
        return merged.groupby("query_id", sort=False).head(k)

    def pd_concat(frames):
        import pandas as pd

        return pd.concat(frames, ignore_index=True)

    t = _id_type(c)
    return _ranked(c.mapInPandas(score, f"query_id {t}, id {t}, similarity double"), k)


def _by_cells(q: DataFrame, c: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """Both sides large. Every group handed to Python has a bounded number of rows."""
    t = _id_type(c)
    places = k + 1 if exclude_self else k

    # Equal vectors have equal neighbours, and only the first ``places`` ids of a group of equal
    # vectors can ever be neighbours. So copies are cut before anything is compared.
    by_vector = Window.partitionBy("vector").orderBy("id")
    distinct_c = materialise(
        c.withColumn("copy", F.row_number().over(by_vector)).filter(F.col("copy") <= places).drop("copy"),
        "neighbour-catalogue",
    )
    distinct_q = q.groupBy("vector").agg(F.min("id").alias("id"))

    cells = _Cells(distinct_c)
    placed = materialise(cells.place(distinct_c), "neighbour-cells")
    stats = {r["cell"]: r for r in placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius")
    ).collect()}  # one row per pivot
    queries = materialise(distinct_q, "neighbour-queries")
    rows = _block_rows(sum(r["n"] for r in stats.values()), queries.count(), cells.pivots.shape[1],
                       c.sparkSession.sparkContext.defaultParallelism)

    near = cells.visits(queries, stats, places)
    probe = _compare(near, placed, {cell: 1 for cell in stats}, {cell: math.ceil(r["n"] / rows) for cell, r in stats.items()},
                     rows, t, places)
    floor = probe.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= places, F.min("similarity")).alias("floor")
    )
    floored = materialise(queries.join(floor, F.col("id") == F.col("query_id"), "left").select(
        "id", "vector", F.coalesce("floor", F.lit(_NO_PAIR)).alias("floor")
    ), "neighbour-floors")
    regions = cells.regions(stats, rows)
    held = placed.withColumnRenamed("cell", "own").join(F.broadcast(c.sparkSession.createDataFrame(
        [(int(i), int(region)) for i, region in enumerate(regions)], "own int, cell int")), "own")
    sizes = {}
    for cell, r in stats.items():
        sizes[regions[cell]] = sizes.get(regions[cell], 0) + r["n"]
    blocks = {region: math.ceil(n / rows) for region, n in sizes.items()}
    found = _compare(cells.region_visits(floored, stats, regions), held, blocks, blocks, rows, t, places, cells.among(stats))

    lists = found.groupBy("query_id").agg(
        F.collect_list(F.struct("similarity", "id")).alias("neighbours")  # at most ``places`` each
    )
    answers = queries.join(lists, F.col("id") == F.col("query_id")).select("vector", "neighbours")
    mine = q.select(F.col("id").alias("query_id"), "vector").join(answers, "vector")
    pairs = mine.select("query_id", F.explode("neighbours").alias("n")).select(
        "query_id", F.col("n.id").alias("id"), F.col("n.similarity").alias("similarity")
    )
    if exclude_self:
        pairs = pairs.filter(F.col("id") != F.col("query_id"))
    return _ranked(pairs, k)


def _block_rows(candidates: int, queries: int, width: int, cores: int) -> int:
    """Rows of a block: a row travels once per block of the other side, so blocks are as large as a task can well hold, but
    there are some for every core."""
    even = max(_LEAST_ROWS, math.ceil(max(candidates, queries) / math.sqrt(2 * cores)))
    return max(1, min(_BLOCK_ROWS, _SMALL_VALUES // max(1, width), even))


def _possible(likeness, radius, floor):
    """Whether a cell may hold a row that reaches a query's floor: Cauchy-Schwarz on the cell's radius."""
    return likeness + radius >= floor[:, None] - 1e-8


class _Cells:
    """Pivots sampled from the data: dense regions get more of them, so cells stay even."""

    def __init__(self, c: DataFrame):
        rows = c.count()
        wanted = int(min(4096, max(16, math.sqrt(rows))))
        sample = seeded_sample(c, "id", wanted, SEED).collect()
        self.pivots = unit_rows([r["vector"] for r in sample])
        self.shared = c.sparkSession.sparkContext.broadcast(self.pivots)

    def place(self, c: DataFrame) -> DataFrame:
        """``(id, vector, cell, distance)`` with packed unit vectors."""
        shared, units, pack = self.shared, unit_rows, _pack

        def assign(batches):
            import numpy as np
            import pandas as pd

            pivots = shared.value
            for batch in batches:
                if not len(batch):
                    continue
                vectors = units(batch["vector"].tolist())
                cell = np.concatenate([
                    np.argmax(vectors[s:s + 1000] @ pivots.T, axis=1) for s in range(0, len(vectors), 1000)
                ])
                gap = vectors - pivots[cell]
                yield pd.DataFrame({
                    "id": batch["id"], "vector": pack(vectors), "cell": cell.astype(np.int32),
                    "distance": np.sqrt((gap * gap).sum(axis=1)),
                })

        return c.mapInPandas(assign, f"id {_id_type(c)}, vector binary, cell int, distance double")

    def _about(self, stats):
        sizes = np.array([stats[i]["n"] if i in stats else 0 for i in range(len(self.pivots))])
        return sizes, np.array([stats[i]["radius"] if i in stats else 0.0 for i in range(len(self.pivots))])

    def regions(self, stats, rows: int) -> list[int]:
        """The region of each cell: cells next to each other, of ``rows`` rows together or alone beyond that."""
        sizes, _ = self._about(stats)
        coarse = self.pivots[:max(1, math.isqrt(len(self.pivots)))]
        likeness = self.pivots @ coarse.T
        out, region, held = [0] * len(sizes), 0, 0
        for i in np.lexsort((-likeness.max(axis=1), likeness.argmax(axis=1))):
            if held and held + sizes[i] > rows:
                region, held = region + 1, 0
            out[i] = region
            held += sizes[i]
        return out

    def visits(self, queries: DataFrame, stats, places: int) -> DataFrame:
        """``(id, vector, floor, cell)``: the nearest cells of a query that together hold ``places`` rows."""
        shared, units, pack = self.shared, unit_rows, _pack
        sizes, _ = self._about(stats)

        def choose(batches):
            import numpy as np
            import pandas as pd

            pivots = shared.value
            for whole in batches:
                for start in range(0, len(whole), 1000):
                    batch = whole.iloc[start:start + 1000]
                    vectors = units(batch["vector"].tolist())
                    order = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")
                    held = sizes[order]
                    rows, ranks = np.nonzero((np.cumsum(held, axis=1) - held < places) & (held > 0))
                    yield pd.DataFrame({
                        "id": batch["id"].to_numpy()[rows], "vector": np.array(pack(vectors), dtype=object)[rows],
                        "floor": -9.0, "cell": order[rows, ranks].astype(np.int32),
                    })

        return queries.mapInPandas(choose, f"id {_id_type(queries)}, vector binary, floor double, cell int")

    def region_visits(self, queries: DataFrame, stats, regions: list[int]) -> DataFrame:
        """``(id, vector, floor, cell)``, once for every region (as ``cell``) with a cell whose best possible similarity
        reaches the query's floor."""
        shared, units, pack, possible = self.shared, unit_rows, _pack, _possible
        sizes, radius = self._about(stats)
        used = np.nonzero(sizes)[0]
        used = used[np.argsort(np.array(regions)[used], kind="stable")]
        numbers, first = np.unique(np.array(regions)[used], return_index=True)

        def choose(batches):
            import numpy as np
            import pandas as pd

            pivots = shared.value
            for whole in batches:
                for start in range(0, len(whole), 1000):
                    batch = whole.iloc[start:start + 1000]
                    vectors, floor = units(batch["vector"].tolist()), batch["floor"].to_numpy()
                    rows, at = np.nonzero(np.logical_or.reduceat(possible(vectors @ pivots[used].T, radius[used], floor), first, axis=1))
                    yield pd.DataFrame({
                        "id": batch["id"].to_numpy()[rows], "vector": np.array(pack(vectors), dtype=object)[rows],
                        "floor": floor[rows], "cell": numbers[at].astype(np.int32),
                    })

        return queries.mapInPandas(choose, f"id {_id_type(queries)}, vector binary, floor double, cell int")

    def among(self, stats):
        """A function: (vectors, floors, cells) becomes the mask of the queries and cells to be compared."""
        shared, possible = self.shared, _possible
        _, radius = self._about(stats)
        return lambda vectors, floor, cells: possible(vectors @ shared.value[cells].T, radius[cells], floor)


def _pruned_pairs(query_ids, queries, floor, ids, vectors, cells, among, k, digits):
    """``_top_pairs`` of the cells that a query may find something in, or of all cells if those are many."""
    import numpy as np

    order = np.argsort(cells, kind="stable")
    names, first = np.unique(cells[order], return_index=True)
    groups = np.split(order, first[1:])
    weights = np.array([len(g) for g in groups]) / len(ids)
    found = []
    for start in range(0, len(query_ids), 2000):
        part = slice(start, start + 2000)
        mask = among(queries[part], floor[part], names)
        if (mask @ weights).mean() > _DENSE:
            found.append(_top_pairs(query_ids[part], queries[part], ids, vectors, k, False, digits))
            continue
        asked = []
        for i, group in enumerate(groups):
            rows = np.nonzero(mask[:, i])[0]
            if len(rows):
                asked.append(_top_pairs(query_ids[part][rows], queries[part][rows], ids[group], vectors[group], k, False, digits))
        if asked:
            a, b, s = (np.concatenate([x[i] for x in asked]) for i in range(3))
            best = np.lexsort((b, -s, a))
            a, b, s = a[best], b[best], s[best]
            keep = np.arange(len(a)) - np.searchsorted(a, a, side="left") < k
            found.append((a[keep], b[keep], s[keep]))
    if not found:
        return query_ids[:0], ids[:0], np.zeros(0)
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def _compare(visits: DataFrame, placed: DataFrame, blocks: dict[int, int], split: dict[int, int], rows: int, id_type: str,
             k: int, among=None) -> DataFrame:
    """Merge the k best of every visited block: ``(query_id, id, similarity)``.

    ``cell`` names what is visited, a cell or a region. It is ``split`` into blocks, of which the first ``blocks`` are
    compared, in several shares if much visited, each with a bounded part of the queries and its own copy of the block.
    With ``among``, a query is compared only with the block's cells (``own``) that it may find something in.
    """
    digits, top_pairs, pruned, unpack = DIGITS, _top_pairs, _pruned_pairs, _unpack
    visited = visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per pivot
    plan = F.broadcast(placed.sparkSession.createDataFrame(
        [(r["cell"], blocks[r["cell"]], split[r["cell"]], math.ceil(r["n"] / rows)) for r in visited],
        "cell int, n_blocks int, split int, shares int",
    ))
    all_shares = F.explode(F.sequence(F.lit(0), F.col("shares") - 1))
    all_blocks = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    targets = placed.join(plan, "cell").withColumn("block", F.pmod(F.xxhash64("id"), F.col("split")).cast("int"))
    targets = targets.filter("block < n_blocks").withColumn("share", all_shares)
    askers = visits.join(plan, "cell").withColumn("share", F.pmod(F.xxhash64("id"), F.col("shares")).cast("int"))
    askers = askers.withColumn("block", all_blocks)
    own = F.col("cell" if among is None else "own").alias("own")

    def score(left, right):
        import pandas as pd

        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": left["id"][:0], "id": right["id"][:0], "similarity": []})
        query_ids, queries = left["id"].to_numpy(), unpack(left["vector"].tolist())
        ids, vectors = right["id"].to_numpy(), unpack(right["vector"].tolist())
        if among is None:
            a, b, s = top_pairs(query_ids, queries, ids, vectors, k, False, digits)
        else:
            a, b, s = pruned(query_ids, queries, left["floor"].to_numpy(), ids, vectors, right["own"].to_numpy(), among, k, digits)
        return pd.DataFrame({"query_id": a, "id": b, "similarity": s})

    group = ["cell", "block", "share"]
    pairs = (
        askers.select(*group, "id", "vector", "floor").groupBy(*group)
        .cogroup(targets.select(*group, "id", "vector", own).groupBy(*group))
        .applyInPandas(score, f"query_id {id_type}, id {id_type}, similarity double")
    )
    return _ranked(pairs, k).drop("rank")


def similar_tracks(ids: DataFrame, index: DataFrame, info: DataFrame, k: int = 10,
                   id_col: str = "track_id", vector: str = "vector") -> DataFrame:
    """The ``k`` most similar tracks of each requested track, with the columns of ``info``.

    The hits are stored first: the search runs once, and the planner knows how small they are.
    """
    queries = index.join(small_side(ids.select(id_col).distinct()), id_col, "left_semi")
    hits = materialise(nearest(queries, index, k, id_col, vector), "hits")
    return hits.withColumnRenamed("id", id_col).join(info, id_col).withColumnRenamed(
        "similarity", "similarity_score"
    )


def similar_available(queries: DataFrame, index: DataFrame, available: DataFrame, k: int = 10,
                      id_col: str = "track_id", vector: str = "vector") -> DataFrame:
    """Neighbours among the ids that the current table has. Filtered before the search, so nothing falls short."""
    candidates = index.join(small_side(available.select(id_col).distinct()), id_col, "left_semi")
    return nearest(queries, candidates, k, id_col, vector)


def with_fallback(primary: DataFrame, fallback: DataFrame, limit: int) -> DataFrame:
    """Primary hits, then fallback hits not among them, up to ``limit`` per query."""
    tagged = primary.select("query_id", "id", "similarity", "rank", F.lit(0).alias("source")).unionByName(
        fallback.select("query_id", "id", "similarity", "rank", F.lit(1).alias("source"))
    )
    first = Window.partitionBy("query_id", "id").orderBy("source", "rank")
    merged = tagged.withColumn("_seen", F.row_number().over(first)).filter(F.col("_seen") == 1).drop("_seen")
    place = Window.partitionBy("query_id").orderBy("source", "rank")
    return (
        merged.withColumn("position", F.row_number().over(place))
        .filter(F.col("position") <= limit)
        .select("query_id", "id", "similarity", "source", "position")
    )


def fallback_neighbours(queries: DataFrame, catalogue: DataFrame, k: int, id_col: str = "track_id",
                        vector: str = "vector", sample: int | None = None, seed: int = SEED) -> DataFrame:
    """Neighbours by another vector, over the whole catalogue: the second choice of the similar-tracks page.

    ``sample`` limits the search to so many seeded rows, for callers that trade quality for time.
    """
    picked = catalogue.select(id_col, vector)
    if sample is not None:
        picked = seeded_sample(picked, id_col, sample, seed)
    return nearest(queries, picked, k, id_col, vector)


def raw_vector(columns, loudness: str | None = "loudness"):
    """Unscaled features for the fallback search: loudness brought to [0, 1], gaps 0."""
    parts = []
    for c in columns:
        value = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        parts.append((value + 60.0) / 60.0 if c == loudness else value)
    return F.array(*parts)
