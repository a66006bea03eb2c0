"""Best-fit packing of token sequences with a linear grouping scheme.

1. Documents are encoded (whole texts, closed by id 0). Those above ``CAPACITY`` tokens are cut; the first piece takes
   the remainder. Only lengths from 1 to CAPACITY remain, so everything is planned on their histogram: a bounded plan,
   whatever the number of documents.
2. Large lengths (above ``SMALL``) are sorted and split into ``GROUPS`` groups of equal cardinality; every length counts
   as the largest of its group. With so few sizes, configurations (how many of each size fill a sequence) are optimised:
   column generation on the linear programme of Gilmore and Gomory, rounded down, the rest best-fit.
3. Actual documents take the places of the rounded sizes, by rank within their group; sequences then have at least the
   room that was planned.
4. Small lengths, largest first, go to the sequences with the least room that holds them; sequences with equal room are
   treated together, so the plan is again on a histogram. What fits nowhere opens new sequences.

A plan is a few thousand ranges of ranks. Each piece has a rank within its class and finds its place by one join on
small bounded tables, however many pieces there are.

Defined results: NULL text is packed as the empty text: one token, id 0. Repeated rows are packed each by itself. An
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import narrow, stored

CAPACITY = 2048
SMALL = 256
GROUPS = 64
BLOCKS = 128
PIECES = "doc_id string, row long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(path: str, capacity: int = CAPACITY):
    """A function for ``mapInPandas``: documents become pieces of at most ``capacity`` ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from cadenza.llm.encoding import encoder

        encode = encoder(path)
        closing = np.zeros(1, dtype="<u4")
        for batch in batches:
            out = []
            texts = [t or "" for t in batch["text"]]
            for doc, row, ids in zip(batch["doc_id"], batch["row"], encode.encode_all(texts)):
                ids = np.concatenate([ids, closing])
                end = (len(ids) - 1) % capacity + 1
                start, piece = 0, 0
                while start < len(ids):
                    out.append((doc, row, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
                    start, end, piece = end, end + capacity, piece + 1
            yield pd.DataFrame(out, columns=["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    return run


def linear_groups(histogram: dict[int, int], groups: int) -> list[tuple[int, int, int]]:
    """(shortest, longest, count) of at most ``groups`` runs of neighbouring lengths with nearly equal counts."""
    total, out, low, n, seen = sum(histogram.values()), [], None, 0, 0
    for length in sorted(histogram):
        low = length if low is None else low
        n += histogram[length]
        seen += histogram[length]
        if seen * groups >= total * (len(out) + 1):
            out.append((low, length, n))
            low, n = None, 0
    if n:
        out.append((low, max(histogram), n))
    return out


def best_configuration(sizes: list[int], values: np.ndarray, capacity: int) -> np.ndarray:
    """Counts per size of the most valuable configuration: an unbounded knapsack over the capacity."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    size = np.array(sizes)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fit = bisect_right(sizes, room)
        if fit:
            with_one = best[room - size[:fit]] + values[:fit]
            i = int(with_one.argmax())
            if with_one[i] > best[room] + 1e-12:
                best[room], choice[room] = with_one[i], i
    counts, room = np.zeros(len(sizes), dtype=int), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= sizes[choice[room]]
    return counts


def configurations(sizes: list[int], counts: list[int], capacity: int, rounds: int = 400) -> list[tuple[int, np.ndarray]]:
    """(times, configuration) that hold every item: the linear programme's solution rounded down, the rest best-fit."""
    m = len(sizes)
    if not m:
        return []
    need = np.array(counts, dtype=float)
    columns = [np.eye(m, dtype=int)[i] * (capacity // sizes[i]) for i in range(m)]
    basis = np.array(columns, dtype=float).T
    x = np.linalg.solve(basis, need)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(m))
        new = best_configuration(sizes, prices, capacity)
        if prices @ new <= 1 + 1e-9:
            break
        direction = np.linalg.solve(basis, new.astype(float))
        able = direction > 1e-9
        if not able.any():
            break
        ratio = np.where(able, x / np.where(able, direction, 1), np.inf)
        leave = int(ratio.argmin())
        columns[leave] = new
        basis[:, leave] = new
        x = np.linalg.solve(basis, need)
    out, left = [], np.array(counts)
    for times, column in sorted(zip(x, columns), key=lambda c: -c[0]):
        whole = int(times + 1e-9)
        while whole > 0 and (left < whole * column).any():
            whole -= 1
        if whole:
            out.append((whole, column))
            left = left - whole * column
    # what rounding left, at most about m sequences' worth: best-fit, largest first
    open_: list[tuple[int, int]] = []
    filled: list[np.ndarray] = []
    for i in range(m - 1, -1, -1):
        for _ in range(int(left[i])):
            at = bisect_left(open_, (sizes[i], -1))
            if at < len(open_):
                room, k = open_.pop(at)
            else:
                room, k = capacity, len(filled)
                filled.append(np.zeros(m, dtype=int))
            filled[k][i] += 1
            insort(open_, (room - sizes[i], k))
    same = Counter(tuple(f) for f in filled)
    return out + [(n, np.array(f)) for f, n in same.items()]


def large_places(groups: list[tuple[int, int, int]], capacity: int) -> tuple[list[tuple], int]:
    """(group, first rank, last rank, first sequence, places per sequence) and the number of sequences."""
    places, rank, sequence = [], [0] * len(groups), 0
    for times, column in configurations([g[1] for g in groups], [g[2] for g in groups], capacity):
        for g, per in enumerate(column):
            if per:
                places.append((g, rank[g], rank[g] + times * int(per), sequence, int(per)))
                rank[g] += times * int(per)
        sequence += times
    assert rank == [g[2] for g in groups]
    return places, sequence


def small_places(rooms: dict[int, int], lengths: dict[int, int], capacity: int) -> list[tuple]:
    """(length, first rank, last rank, room class, first sequence rank in it, places per sequence) for small lengths.

    ``rooms`` counts the sequences by room. Sequences of one class and range are filled alike; class -1 are new ones.
    """
    # a cohort: [room left, class, first rank within class, count]
    cohorts = sorted([r, r, 0, n] for r, n in rooms.items() if n)
    out, opened = [], 0
    for length in sorted(lengths, reverse=True):
        left, rank = lengths[length], 0
        while left:
            at = bisect_left(cohorts, [length])
            if at == len(cohorts):
                n = -(-left // (capacity // length))
                insort(cohorts, [capacity, -1, opened, n])
                opened += n
                continue
            room, cls, first, n = cohorts.pop(at)
            per = room // length
            if left >= per * n:
                used, take = n, per
            elif left >= per:
                used, take = left // per, per
            else:
                used, take = 1, left
            out.append((length, rank, rank + used * take, cls, first, take))
            rank += used * take
            left -= used * take
            insort(cohorts, [room - take * length, cls, first, used])
            if used < n:
                insort(cohorts, [room, cls, first + used, n - used])
    return out


def ranked(rows: DataFrame, key: str, order: str) -> DataFrame:
    """``rows`` with ``rank`` from 0 within ``key``: numbered within BLOCKS blocks, which start where others end."""
    blocked = rows.withColumn("block", F.pmod(F.xxhash64(order), F.lit(BLOCKS)).cast("int"))
    before = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocked.groupBy(key, "block").agg(F.count("*").alias("n")).select(
        F.col(key).alias("of"), F.col("block").alias("of_block"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy(key, "block").orderBy(order)) - 1
    return blocked.withColumn("within", within).join(
        F.broadcast(starts), (F.col(key) == F.col("of")) & (F.col("block") == F.col("of_block"))).withColumn(
        "rank", F.col("first") + F.col("within")).drop("block", "within", "of", "of_block", "first")


def placed(rows: DataFrame, key: str, places: list[tuple], schema: str) -> DataFrame:
    """Join ranked rows to the place whose range of ranks holds them.

    Places of a key are sorted by rank and lie side by side; an array of their ends per key finds the one by search.
    """
    spark = rows.sparkSession
    table = spark.createDataFrame(places, schema)
    fields = [c for c in table.columns if c != key]
    lists = table.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("places"))
    lists = lists.withColumnRenamed(key, "of")
    ends = F.filter("places", lambda p: (p[fields[0]] <= F.col("rank")) & (F.col("rank") < p[fields[1]]))
    return rows.join(F.broadcast(lists), F.col(key) == F.col("of")).withColumn("place", F.get(ends, F.lit(0))).drop(
        "of", "places")


def pack(pieces: DataFrame, capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS) -> DataFrame:
    """``pieces`` (with unique long ``at`` and ``length`` from 1 to ``capacity``; stored) with ``sequence_id`` and
    ``offset``."""
    spark = pieces.sparkSession
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = linear_groups({k: n for k, n in histogram.items() if k > small}, groups)
    places, sequences = large_places(runs, capacity)
    of_length = spark.createDataFrame(
        [(k, g) for g, (low, high, _) in enumerate(runs) for k in range(low, high + 1)], "of_length long, grp int")
    large = pieces.filter(F.col("length") > small).join(F.broadcast(of_length), F.col("length") == F.col("of_length"))
    large = placed(ranked(large.drop("of_length"), "grp", "at"), "grp", places,
                   "grp int, low long, high long, sequence long, per long")
    large = stored(large.withColumn("sequence_id", F.col("place.sequence") + F.floor(
        (F.col("rank") - F.col("place.low")) / F.col("place.per"))).drop("place", "rank", "grp"), "packing-large")
    rooms = stored(large.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("room")), "packing-rooms")
    classes = {int(r["room"]): int(r["n"]) for r in rooms.groupBy("room").agg(F.count("*").alias("n")).collect()}
    fill = small_places(classes, {k: n for k, n in histogram.items() if k <= small}, capacity)
    tiny = placed(ranked(pieces.filter(F.col("length") <= small), "length", "at"), "length", fill,
                  "length long, low long, high long, room long, first long, per long")
    tiny = tiny.select("*", F.col("place.room").alias("room_class"), (F.col("place.first") + F.floor(
        (F.col("rank") - F.col("place.low")) / F.col("place.per"))).alias("room_rank")).drop("place", "rank")
    tiny = stored(tiny, "packing-small")
    numbered = ranked(rooms, "room", "sequence_id").select(
        F.col("room").alias("room_class"), F.col("rank").alias("room_rank"), "sequence_id")
    found = tiny.filter("room_class >= 0").join(numbered, ["room_class", "room_rank"])
    fresh = tiny.filter("room_class < 0").withColumn("sequence_id", F.col("room_rank") + F.lit(sequences))
    columns = [*pieces.columns, "sequence_id"]
    every = large.select(*columns).unionByName(found.select(*columns)).unionByName(fresh.select(*columns))
    before = Window.partitionBy("sequence_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return every.withColumn("sequence_id", F.col("sequence_id").cast("long")).withColumn(
        "offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))


def encode_pieces(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text",
                  capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents, stored, with a unique number ``at``."""
    read = narrow(docs, doc_id=id, text=text).select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    # ids are text in pandas, which would turn whole numbers beside a NULL into floating point
    pieces = read.mapInPandas(cut_pieces(path, capacity), PIECES).withColumn(
        "doc_id", F.col("doc_id").cast(docs.schema[id].dataType))
    return stored(pieces.withColumn("at", F.monotonically_increasing_id()), "packing-pieces")


def pack_documents(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """Per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``."""
    return pack(encode_pieces(docs, path, id, text, capacity), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
