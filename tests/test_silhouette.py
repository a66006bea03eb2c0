import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import silhouette as blocks
from cadenza.operators.metrics import silhouette
from cadenza.operators.silhouette import silhouette_estimate
from cadenza.session import materialise


def blobs(spark, rows, seed=4):
    rng = np.random.default_rng(seed)
    label = rng.choice(4, rows, p=[0.6, 0.3, 0.09, 0.01])
    vectors = rng.normal(size=(rows, 3)) + label[:, None] * 1.5
    return materialise(spark.createDataFrame(
        [(i, int(c), v.tolist()) for i, (c, v) in enumerate(zip(label, vectors))], "id long, c int, v array<double>"), "test")


def test_exact_figure_lies_within_the_bound_and_the_sample_does_not_grow(spark):
    scored = []
    for rows in (3000, 9000):
        df = blobs(spark, rows)
        got = silhouette_estimate(df, "id", "v", "c", error=0.03, first=128).first()
        exact = silhouette(df, "id", "v", "c").first()["silhouette_score"]
        assert abs(got["silhouette_score"] - exact) <= got["error"] <= 0.03 and got["rows"] == rows
        scored.append(got["points"])
    assert scored[1] < 1.5 * scored[0] and scored[1] < 4000


def test_without_error_it_is_exact_and_partitions_do_not_matter(spark):
    df = blobs(spark, 700)
    got = silhouette_estimate(df, "id", "v", "c", error=0.0, first=64).first()
    assert got["points"] == 700 and got["error"] == 0
    assert got["silhouette_score"] == pytest.approx(silhouette(df, "id", "v", "c").first()["silhouette_score"], abs=1e-12)
    one, two = [silhouette_estimate(df.repartition(n), "id", "v", "c", 0.05, first=32).first() for n in (1, 7)]
    assert one["points"] == two["points"] and one["silhouette_score"] == pytest.approx(two["silhouette_score"], abs=1e-9)


def test_odd_rows(spark):
    schema = "id long, c int, v array<double>"
    none = silhouette_estimate(spark.createDataFrame([], schema), "id", "v", "c").first()
    assert none["silhouette_score"] is None and none["points"] == 0
    rows = [(1, 0, [0.0]), (1, 0, [0.0]), (2, None, [1.0]), (None, 1, [4.0]), (3, 0, None)]
    got = silhouette_estimate(spark.createDataFrame(rows, schema), "id", "v", "c").first()
    assert (got["points"], got["silhouette_score"]) == (3, pytest.approx(2 / 3))
    alone = spark.createDataFrame([(i, 0, [float(i)]) for i in range(5)], schema)
    assert silhouette_estimate(alone, "id", "v", "c").first()["silhouette_score"] == 0
    assert alone.filter(F.col("v").isNull()).count() == 0


def test_sums_of_distances_hold_for_close_far_and_endless_points():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(50, 6)) * 1e3 + 1e6
    a[10:20] = a[0]
    a[20:30] = a[0] + 1e-7 * rng.normal(size=(10, 6))
    odd = a.copy()
    odd[3, 2], odd[4, 1] = np.inf, np.nan
    member = blocks._members(np.arange(50) % 3, 3)
    for points in (a, odd, a * 1e160):
        with np.errstate(all="ignore"):
            want = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)) @ member
        np.testing.assert_allclose(blocks._sums(points, points, member), want, rtol=1e-9)


def test_blocks_of_several_groups_a_task(spark, monkeypatch):
    """Every point meets every other one, whatever the blocks, and no point reaches the driver when all are scored."""
    monkeypatch.setattr(blocks, "BLOCK_VALUES", 600)
    df = blobs(spark, 5000)
    monkeypatch.setattr(blocks, "_parts", lambda *_: pytest.fail("all points, yet through the driver"))
    got = silhouette_estimate(df, "id", "v", "c", error=0.0, first=64).first()
    rows = df.orderBy("id").collect()
    v, c = np.array([r["v"] for r in rows]), np.array([r["c"] for r in rows])
    total = np.stack([np.sqrt(((v[:, None] - v[None, c == k]) ** 2).sum(axis=2)).sum(axis=1) for k in range(4)], axis=1)
    size = np.bincount(c)
    within = total[np.arange(5000), c] / (size[c] - 1)
    other = total / size
    other[np.arange(5000), c] = np.inf
    near = other.min(axis=1)
    want = ((near - within) / np.maximum(near, within)).mean()
    assert got["points"] == 5000 and got["silhouette_score"] == pytest.approx(want, abs=1e-9)
    assert silhouette(df, "id", "v", "c").first()["silhouette_score"] == pytest.approx(want, abs=1e-9)
