import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import similar


def brute_force(queries, catalogue, k, exclude_self=True):
    """Top k by rounded cosine, ties to the smaller id."""
    out = {}
    for qid, q in queries.items():
        scored = []
        for cid, c in catalogue.items():
            if exclude_self and cid == qid:
                continue
            length = np.linalg.norm(q) * np.linalg.norm(c)
            scored.append((-round(float(q @ c / length) if length else 0.0, similar.DIGITS) + 0.0, cid))
        out[qid] = [cid for _, cid in sorted(scored)[:k]]
    return out


def frame(spark, vectors, partitions=4):
    t = "string" if isinstance(next(iter(vectors)), str) else "bigint"
    rows = [(k, [float(x) for x in v]) for k, v in vectors.items()]
    return spark.createDataFrame(rows, f"track_id {t}, vector array<double>").repartition(partitions)


def answer(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append(r["id"])
    return found


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    data = {i: rng.normal(size=5) + rng.choice([-3, 0, 3]) for i in range(300)}
    data.update({i: np.array([1.0, 2, 3, 4, 5]) for i in range(300, 420)})  # a group of copies
    data.update({i: 2.0 * np.array([1.0, 2, 3, 4, 5]) for i in range(420, 430)})  # copies up to length
    data.update({430: np.zeros(5), 431: np.zeros(5)})
    return data


@pytest.mark.parametrize("strategy", ["catalogue", "queries", "cells"])
def test_all_strategies_equal_brute_force(spark, vectors, strategy):
    df = frame(spark, vectors)
    assert answer(similar.nearest(df, df, 4, strategy=strategy)) == brute_force(vectors, vectors, 4)


@pytest.mark.parametrize("strategy", ["catalogue", "queries", "cells"])
def test_other_catalogue_and_text_ids(spark, vectors, strategy):
    queries = {f"q{k}": v for k, v in list(vectors.items())[::20]}
    catalogue = {f"c{k}": v for k, v in vectors.items() if k % 3}
    got = similar.nearest(frame(spark, queries), frame(spark, catalogue), 3, exclude_self=False, strategy=strategy)
    assert answer(got) == brute_force(queries, catalogue, 3, False)


def test_blocks_are_split_and_shared(spark, vectors, monkeypatch):
    monkeypatch.setattr(similar, "_BLOCK_ROWS", 7)
    df = frame(spark, vectors)
    assert answer(similar.nearest(df, df, 4, strategy="cells")) == brute_force(vectors, vectors, 4)


def test_a_query_is_sent_once_to_a_region_not_to_each_cell(spark):
    """Vectors without structure reach every cell; what is sent grows with the regions, which are few."""
    rng = np.random.default_rng(6)
    data = {i: rng.normal(size=24) for i in range(900)}
    df = similar._narrow(frame(spark, data), "track_id", "vector")
    cells = similar._Cells(df)
    placed = cells.place(df)
    stats = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()}
    regions = cells.regions(stats, 300)
    assert len(stats) > 20 and len(set(regions)) <= 6
    sent = cells.region_visits(df.withColumn("floor", F.lit(0.5)), stats, regions)
    assert sent.count() == sent.select("id", "cell").distinct().count() <= 900 * len(set(regions))
    got = answer(similar.nearest(frame(spark, data), frame(spark, data), 4, strategy="cells"))
    assert got == brute_force(data, data, 4)


def test_size_decides(spark, vectors):
    df = frame(spark, vectors)
    want = brute_force(vectors, vectors, 2)
    assert answer(similar.nearest(df, df, 2, small_rows=50)) == want  # cells
    few = df.filter("track_id < 10")
    assert answer(similar.nearest(few, df, 2, small_rows=50)) == {k: v for k, v in want.items() if k < 10}
    with pytest.raises(ValueError):
        similar.nearest(df, df, 2, strategy="queries", small_rows=50)


def test_twin_is_kept_and_self_removed(spark):
    df = frame(spark, {1: np.array([1.0, 0]), 2: np.array([1.0, 0]), 3: np.array([0.0, 1])})
    assert answer(similar.nearest(df, df, 1)) == {1: [2], 2: [1], 3: [1]}


def test_empty_sides(spark):
    df = frame(spark, {1: np.array([1.0, 0])})
    none = df.limit(0)
    assert similar.nearest(none, df, 2).count() == 0 and similar.nearest(df, none, 2).count() == 0
    assert similar.nearest(df, df, 2, strategy="cells").count() == 0


def test_fallback_fills_without_repeating(spark):
    schema = "query_id long, id long, similarity double, rank int"
    first = spark.createDataFrame([(1, 10, .9, 1), (1, 11, .8, 2)], schema)
    second = spark.createDataFrame([(1, 11, .99, 1), (1, 12, .7, 2), (1, 13, .6, 3), (2, 20, .5, 1)], schema)
    got = similar.with_fallback(first, second, 3).orderBy("query_id", "position").collect()
    assert [(r["query_id"], r["id"], r["source"]) for r in got] == [(1, 10, 0), (1, 11, 0), (1, 12, 1), (2, 20, 1)]


def test_raw_vector(spark):
    df = spark.createDataFrame([(.5, -30.0, None)], "energy double, loudness double, valence double")
    assert df.select(similar.raw_vector(["energy", "loudness", "valence"])).first()[0] == [.5, .5, 0.0]
