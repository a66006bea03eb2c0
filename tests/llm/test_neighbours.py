import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm.neighbours import hilbert_keys, nearest


@pytest.mark.parametrize("dimensions,bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve_visits_every_cell_by_single_steps(dimensions, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dimensions, indexing="ij"), axis=-1).reshape(-1, dimensions)
    keys = hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(side**dimensions))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def brute(x, ids, queries, k):
    out = {}
    for q in queries:
        score = (x * x[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if i != q][:k]
        out[int(ids[q])] = [(int(ids[i]), score[i]) for i in order]
    return out


def frame(spark, ids, x, extra=()):
    rows = [(int(i), [float(c) for c in v], 1, 2) for i, v in zip(ids, x)] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, at int, slot int").repartition(4)


def recall(found, want):
    hit = sum(len({r.vec_id for r in found if r.query_id == q} & {i for i, _ in v}) for q, v in want.items())
    return hit / sum(len(v) for v in want.values())


def test_recall_and_scores_with_a_family_of_copies(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 24))
    x = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 24)) * 0.5
    x[500:1300] = x[500]
    ids = np.arange(3000)
    want = brute(x, ids, range(0, 3000, 20), 20)
    found = nearest(frame(spark, ids, x), F.col("id") % 20 == 0, 20, tile=500).collect()
    assert recall(found, want) >= 0.9
    for r in found:
        assert r.score == pytest.approx(float(x[r.query_id] @ x[r.vec_id]), rel=1e-12) and r.query_id != r.vec_id
    for q in (500, 600):  # copies tie exactly and come by id
        got = [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q]
        copies = [i for i in got if 500 <= i < 1300]
        assert copies == [i for i in range(500, 1300) if i != q][:len(copies)] and len(copies) >= 10


def test_vectors_without_structure_still_reach_the_recall(spark):
    x = np.random.default_rng(2).normal(size=(1500, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = brute(x, np.arange(1500), range(0, 1500, 20), 20)
    assert recall(nearest(frame(spark, range(1500), x), F.col("id") % 20 == 0, 20).collect(), want) >= 0.9


def test_odd_vectors_take_no_part_and_few_are_all_returned(spark):
    x = [[1.0, 0.0], [0.5, 0.5], [0.5, 0.5], [-1.0, 0.2]]
    odd = [(100, None, 1, 1), (120, [0.0, 0.0], 1, 1), (140, [1.0, float("nan")], 1, 1), (160, [float("inf"), 1.0], 1, 1),
           (180, [1.0, None], 1, 1), (200, [], 1, 1), (220, [1.0, 2.0, 3.0], 1, 1), (None, [0.9, 0.0], 1, 1)]
    found = nearest(frame(spark, [0, 1, 2, 3], x, odd), F.col("id") % 20 == 0, 20).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(found, key=lambda r: r["rank"])] == [
        (0, 1, None), (0, 2, 1), (0, 3, 2), (0, 4, 3)]


def test_no_rows(spark):
    assert nearest(frame(spark, [0], [[1.0]]).limit(0), F.col("id") % 20 == 0, 5).count() == 0


def test_single_vectors_beside_families_get_whole_lists(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 16))
    x = np.concatenate([np.repeat(centres, 95, axis=0), rng.normal(size=(100, 16))])
    found = nearest(frame(spark, range(2000), x), F.col("id") % 20 == 0, 20).collect()
    for q in range(0, 2000, 20):
        assert sorted(r["rank"] for r in found if r.query_id == q) == list(range(1, 21))
    want = brute(x, np.arange(2000), range(0, 2000, 20), 20)
    assert recall(found, want) >= 0.9


def test_wide_ids_beside_a_missing_one(spark):
    big = 9007199254740993
    rows = [(big * 20, [1.0, 0.0]), (big, [0.9, 0.0]), (None, [0.8, 0.0]), (-3, [0.7, 0.0]), (-30, [0.7, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(nearest(df, F.col("id") == big * 20, 9).collect(), key=lambda r: r["rank"])
    assert [(r.query_id, r.vec_id) for r in found] == [(big * 20, i) for i in (big, None, -30, -3)]
    named = spark.createDataFrame([("b", [1.0]), ("a", [1.0]), (None, [2.0])], "vec_id string, embedding array<double>")
    assert [r.vec_id for r in sorted(nearest(named, F.col("id") == "b", 9).collect(), key=lambda r: r["rank"])] == [None, "a"]
