import numpy as np
import pytest
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cadenza.operators import forest, kmeans, metrics, models
from cadenza.plans import jobs
from cadenza.streaming.interactions import score_stream


@pytest.fixture(scope="module")
def tracks(spark):
    """Genre and popularity follow from energy and valence; some cells are missing."""
    rng = np.random.default_rng(42)
    rows = []
    for i in range(240):
        energy, valence = rng.random(2)
        genre = "Pop" if energy > .6 else "Rock" if valence > .5 else "Jazz"
        rows.append((f"id_{i}", f"Artist{i}", f"Track{i}", genre, int(60 * energy + 40 * valence),
                     float(rng.random()) if i % 10 else None, float(energy), float(-20 * rng.random()), float(rng.random()),
                     float(rng.random()), float(rng.random()), float(valence)))
    return spark.createDataFrame(rows, "track_id string, artist_name string, track_name string, genre string, popularity int, "
                                 "danceability double, energy double, loudness double, speechiness double, acousticness double, "
                                 "instrumentalness double, valence double").repartition(3).cache()


@pytest.fixture(scope="module")
def classifier(tracks):
    return models.train_classifier(tracks, "genre", "track_id", trees=10)


def test_classifier(tracks, classifier):
    model, scored = classifier
    assert models.feature_names(model) == list(models.track_features(tracks.columns)) and len(models.feature_names(model)) == 11
    assert abs(scored.count() - 48) <= 1
    found = metrics.classification_metrics(scored, "genre", "predicted").first()
    base = metrics.majority_baseline(scored, "genre").first()[0]
    assert found["accuracy"] >= .5 and found["accuracy"] > base
    row = scored.first()
    assert sum(row["probabilities"].values()) == pytest.approx(1) and len(row["top_predictions"]) == 3
    assert row["top_predictions"][0]["name"] == row["predicted"]
    assert not [c for c in scored.columns if c.startswith("_")]


def test_saved_model_scores_raw_rows_without_label(spark, tracks, classifier, tmp_path):
    model, _ = classifier
    models.save(model, str(tmp_path / "m"))
    raw = tracks.drop("genre", "popularity")
    again = models.score_classes(raw, models.load(str(tmp_path / "m"))).select("track_id", "predicted")
    assert again.exceptAll(models.score_classes(raw, model).select("track_id", "predicted")).count() == 0
    with pytest.raises(ValueError):
        models.add_absent(raw.drop("valence"), ["valence"])
    assert models.score_classes(models.add_absent(raw.drop("valence"), ["valence"], "lenient"), model).count() == 240


def test_regressors(tracks):
    model, scored = models.train_regressor(tracks, "popularity", "track_id", trees=10)
    assert metrics.regression_metrics(scored, "popularity", "predicted").first()["r2_score"] > .7
    assert scored.count() == 48
    top = models.importances(model, 2)
    assert {r["feature"] for r in top.collect()} <= set(models.feature_names(model)) and top.count() == 2
    clamped = models.score_number(tracks, model, 0, 50).agg(F.min("predicted"), F.max("predicted")).first()
    assert clamped[0] >= 0 and clamped[1] <= 50
    judged = models.with_actual(models.score_number(tracks, model, 0, 100), "popularity", "predicted", True)
    assert judged.filter("abs_error < 0").count() == 0


def test_energy_features_do_not_leak(tracks):
    assert list(models.energy_features(tracks)) == [
        "danceability", "loudness", "speechiness", "acousticness", "instrumentalness", "valence",
        "Acoustic_Instrumental_Interaction"]


def test_missing_target_takes_the_median(spark, tracks):
    gaps = tracks.withColumn("popularity", F.when(F.col("track_id") != "id_7", F.col("popularity")))
    _, scored = models.train_regressor(gaps, "popularity", "track_id", trees=2, test_fraction=.5)
    assert scored.filter("popularity IS NULL").count() == 0


def test_clusters(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(np.vstack([rng.normal(0, .1, (30, 2)), rng.normal(4, .1, (50, 2))]))]
    df = spark.createDataFrame(rows, "track_id long, energy double, valence double")
    features = {"energy": "energy", "valence": "valence"}
    model = models.train_clusters(df, 2, features, restarts=3)
    scored = models.score_clusters(df, model)
    assert sorted(r["count"] for r in scored.groupBy("cluster").count().collect()) == [30, 50]
    for r in scored.limit(5).collect():
        assert int(np.argmin(r["centre_distances"])) == r["cluster"]
    assert metrics.silhouette(model.transform(df).select("track_id", "cluster", vector_to_array("_features").alias("v")),
                              "track_id", "v", "cluster").first()[0] > .9


def test_similar_songs_page(spark, tracks):
    scaler, index = models.similarity_index(tracks, ["track_id", "genre"])
    requested = spark.createDataFrame([("id_1",), ("id_2",), ("absent",)], "track_id string")
    served = tracks.filter("track_id IN ('id_1', 'id_3', 'id_5')")
    got = jobs.similar_songs(requested, served, index, scaler, 10).collect()
    assert {(r["query_id"], r["track_id"]) for r in got} == {("id_1", "id_3"), ("id_1", "id_5")}
    whole = jobs.similar_songs(requested, tracks, index, scaler, 10)
    assert whole.groupBy("query_id").count().select("count").distinct().first()[0] == 10


def test_all_five(spark, tracks, tmp_path):
    broken = {"energy": {"nothing": "`no_such_column`"}}
    report = models.train_all(tracks, trees=5, save_to=str(tmp_path), features=broken).collect()
    success = {r["model"]: r["success"] for r in report}
    assert success == {"genre_classification": True, "clustering": True, "similar_songs": True,
                       "popularity_regression": True, "energy_regression": False}
    assert any("no_such_column" in (r["error"] or "") for r in report)
    sizes = sum(r["value"] for r in report if r["metric"] and r["metric"].startswith("cluster_"))
    assert sizes == 240 and spark.read.parquet(str(tmp_path / "similar_songs_index")).count() == 240
    pages = jobs.song_pages(tracks.select("track_id").limit(3), tracks, {
        "genre": models.load(str(tmp_path / "genre_classification")),
        "popularity": models.load(str(tmp_path / "popularity_regression")),
        "clusters": models.load(str(tmp_path / "clustering")),
    })
    assert pages.count() == 3 and {"predicted_genre", "predicted_popularity", "cluster"} <= set(pages.columns)


def test_scoring_a_stream(spark, tracks, classifier, tmp_path):
    tracks.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(tracks.schema).parquet(str(tmp_path / "in"))
    scored = score_stream(stream, classifier[0], lambda df: df.select("track_id", "predicted"))
    scored.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 240


def test_partitions_to_train_on_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(models, "PARTITION_ROWS", 100)
    rows = spark.range(0, 3_000, 1, 2).selectExpr("id AS track_id", "CAST(id AS double) AS energy")
    with models._prepared(rows, {"energy": "`energy`"}) as (_, vectors):
        sizes = vectors.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(sizes) == 3_000 and len(sizes) == 30 and max(sizes) < 150


@pytest.mark.parametrize("classes", [0, 3])
def test_forest_is_the_same_by_histograms_in_one_task_and_in_parts(spark, monkeypatch, classes):
    """Nodes split by all tasks together, subtrees grown in one, and rows that meet the parts of a large model."""
    rng = np.random.default_rng(3)
    x = rng.random((2_000, 3)).round(2)
    y = (3 * (x[:, 0] * .6 + x[:, 1] * .4)).astype(int) if classes else x[:, 0] + x[:, 1] * x[:, 2]
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double").repartition(4).cache()
    df.count()
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="_features").transform(df)

    def scored(model):
        name = "_prediction" if classes else "predicted"
        return {(r["a"], r["b"], r["c"]): r[name] for r in model.transform(vectors).collect()}

    found, stored = {}, forest.store_binned(df, ["a", "b", "c"], "y")
    for name, local, narrow in (("task", 10_000, 10**6), ("levels", 0, 10**6), ("both", 300, 10**6), ("parts", 300, 0)):
        monkeypatch.setattr(forest, "LOCAL_ROWS", local)
        monkeypatch.setattr(forest, "NARROW_NODES", narrow)
        monkeypatch.setattr(forest, "PART_NODES", 100)
        monkeypatch.setattr(forest, "_SLICE", 300)
        model = forest.train_forest(*stored, classes, 6, 6, 3, 42)
        found[name] = scored(model)
        weights = model.featureImportances.toArray()
        assert weights.sum() == pytest.approx(1) and weights[0] > .3 and (not classes or weights[2] < .05)
        tops = sum(len(t["feature"]) for t in model.tops)
        assert (tops == 6) == (name == "task") and (model.pieces is None) == (name == "levels")
    for name in ("levels", "both", "parts"):
        assert found[name].keys() == found["task"].keys()
        assert max(abs(found[name][k] - found["task"][k]) for k in found["task"]) < 1e-9, name
    right = [abs(found["task"][tuple(map(float, r))] - v) < (.5 if classes else .1) for r, v in zip(x, y)]
    assert np.mean(right) > .9


def test_large_forest_does_not_pass_through_the_driver(spark, tracks, monkeypatch):
    """Neither training nor scoring may collect the nodes below the tops."""
    monkeypatch.setattr(forest, "NARROW_NODES", 0)
    model, scored = models.train_classifier(tracks, "genre", "track_id", trees=5)
    fitted = next(s for s in model.stages if isinstance(s, forest.ForestModel))
    assert sum(len(t["feature"]) for t in fitted.tops) == 5 < fitted.nodes
    monkeypatch.setattr(fitted, "_where_they_lie", None)
    again = models.score_classes(tracks, model).join(scored.select("track_id", F.col("predicted").alias("before")), "track_id")
    assert again.count() == scored.count() == 48 and again.filter("predicted <> before").count() == 0


def test_starts_of_clusters_share_their_passes(spark, monkeypatch, tmp_path):
    """As many passes for ten starts as for the longest of them, and the centres of plain Lloyd steps in memory."""
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(m, 1.0, (200, 2)) for m in (0, 3, 9)])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double").repartition(3).cache()
    monkeypatch.setattr(kmeans, "BLOCK_VALUES", 100)
    passes, visit = [], kmeans._Rows.visit
    monkeypatch.setattr(kmeans._Rows, "visit", lambda *a, **b: passes.append(1) or visit(*a, **b))
    alone = []
    for seed in range(42, 46):
        passes.clear()
        centres, cost = kmeans.best_of_starts(df, ["a", "b"], 3, [seed], 300, 1e-9)
        alone.append((cost, len(passes)))
        gaps = ((x[:, None] - centres) ** 2).sum(axis=2)
        assert cost == pytest.approx(gaps.min(axis=1).sum())
        for i, centre in enumerate(centres):
            assert centre == pytest.approx(x[gaps.argmin(axis=1) == i].mean(axis=0), abs=1e-6)
    passes.clear()
    centres, cost = kmeans.best_of_starts(df, ["a", "b"], 3, list(range(42, 46)), 300, 1e-9)
    assert cost == pytest.approx(min(c for c, _ in alone)) and len(passes) <= max(n for _, n in alone) + 6 < sum(n for _, n in alone)
    model = kmeans.clusters_model(centres, "_features", "cluster")
    model.write().overwrite().save(str(tmp_path / "m"))
    assert np.array(KMeansModel.load(str(tmp_path / "m")).clusterCenters()) == pytest.approx(centres)


def test_split_points_of_features_that_follow_from_each_other_differ(spark):
    df = spark.range(5_000).selectExpr("CAST(id AS double) AS a", "-CAST(id AS double) AS b", "CAST(greatest(id, 600) AS double) AS c")
    a, b, c = forest._split_points(df, ["a", "b", "c"])
    assert len(a) == len(b) == len(c) == 31
    assert min(abs(x + y) for x in a for y in b) > 10
