import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import metrics, validate


def failed(report):
    return {(r["check"], r["column"]) for r in report.filter("NOT passed").collect()}


def test_good_table_passes(spark):
    df = spark.range(100).select(F.col("id").alias("x"), F.lit("pop").alias("genre"))
    report = validate.validation_report(df, "genre", ["x", "genre"])
    assert failed(report) == set()
    validate.require_valid(report)


def test_every_failure_is_named(spark):
    df = spark.range(40).select(
        F.when(F.col("id") < 5, "rare").otherwise("pop").alias("genre"),
        F.when(F.col("id") < 3, 1.0).alias("gaps"), F.lit(1).alias("fixed"),
        F.when(F.col("id") < 3, 1000.0).otherwise(F.col("id") % 2).alias("wild"),
    )
    report = validate.validation_report(df, "genre", ["genre", "tempo"])
    assert failed(report) == {
        ("schema", "tempo"), ("class_size", "rare"), ("small_classes", "genre"), ("missing_percent", "gaps"),
        ("duplicate_fraction", None), ("constant", "fixed"), ("constant", "gaps"), ("outlier_fraction", "wild"),
    }
    verdict = validate.verdict(report).first()
    assert (verdict["errors"], verdict["warnings"], verdict["passed"]) == (5, 3, False)
    with pytest.raises(ValueError):
        validate.require_valid(report)


def test_warnings_do_not_fail(spark):
    df = spark.range(40).select("id", F.lit("pop").alias("genre"), F.lit(1).alias("fixed"))
    validate.require_valid(validate.validation_report(df, "genre", ["genre"]))


def test_empty_table_and_absent_target(spark):
    df = spark.createDataFrame([], "genre string")
    assert failed(validate.quality_report(df, "genre")) == {("not_empty", None)}
    assert failed(validate.quality_report(df, "other")) == {("target_present", "other")}


def test_drift(spark):
    df = spark.range(1000).select((F.col("id") % 100).cast("double").alias("x"), (F.col("id") < 500).alias("first"))
    same = validate.drift(df.filter("first"), df.filter("NOT first"), ["x"]).first()
    assert same["psi"] == pytest.approx(0, abs=1e-9) and same["ks"] == pytest.approx(0, abs=1e-9)
    moved = df.withColumn("x", F.col("x") + 50)
    row = validate.drift_report(df, moved, ["x"]).first()
    assert not row["passed"] and row["severity"] == "warning"


def test_unseen_labels_block(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "y string, x double")
    test = spark.createDataFrame([("c", 1.0)], "y string, x double")
    assert ("unseen_labels", "y") in failed(validate.split_report(train, test, "y", ["x"]))


def test_weak_segment(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), F.lit(1).alias("y"), (F.col("id") >= 75).cast("int").alias("p"))
    worst = validate.weak_segments(df, "x", "y", "p").orderBy("bucket").collect()
    assert [r["error_rate"] for r in worst][:2] == [1.0, 1.0] and worst[-1]["error_rate"] == 0.0


def test_perfect_and_constant_predictions(spark):
    df = spark.createDataFrame([("a", "a", 1.0, 1.0), ("b", "b", 2.0, 2.0)], "y string, p string, t double, q double")
    assert tuple(metrics.classification_metrics(df, "y", "p").first()) == (1.0, 1.0, 1.0, 1.0)
    assert tuple(metrics.regression_metrics(df, "t", "q").first()) == (1.0, 0.0, 0.0, 0.0)
    same = df.withColumn("t", F.lit(1.0))
    assert metrics.regression_metrics(same, "t", "q").first()["r2_score"] is None


def test_silhouette(spark):
    rng = np.random.default_rng(0)
    points = np.vstack([rng.normal(0, .1, (20, 2)), rng.normal(5, .1, (20, 2)), [[9.0, 9.0]]])
    groups = ["a"] * 20 + ["b"] * 20 + ["lonely"]
    df = spark.createDataFrame([(i, [float(x) for x in p], g) for i, (p, g) in enumerate(zip(points, groups))],
                               "id long, vector array<double>, c string")
    got = {r["key"]: r["silhouette"] for r in metrics.silhouette_points(df, "id", "vector", "c").collect()}
    gaps = np.linalg.norm(points[:, None] - points[None], axis=2)
    for i, g in enumerate(groups):
        mine = [j for j, h in enumerate(groups) if h == g and j != i]
        if not mine:
            assert got[i] == 0.0
            continue
        within = gaps[i, mine].mean()
        nearest = min(gaps[i, [j for j, h in enumerate(groups) if h == o]].mean() for o in set(groups) - {g})
        assert got[i] == pytest.approx((nearest - within) / max(nearest, within))
    assert metrics.silhouette(df, "id", "vector", "c", sample=10).first()["points"] == 10
