"""Registered queries: trained models. Their numbers have no SQL twin; the rows are checked in the tests."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cadenza.operators.features import select_by_importance
from cadenza.operators.metrics import classification_metrics, regression_metrics
from cadenza.operators.models import (
    energy_features, feature_names, importances, load, save, score_all, score_clusters, similarity_index, train_all,
    train_classifier, train_clusters, train_regressor, with_actual,
)
from cadenza.operators.profile import group_centroids, group_sizes
from cadenza.operators.similar import nearest
from cadenza.plans.registry import query, rounded, table
from cadenza.session import materialise, scratch_dir
from cadenza.streaming.interactions import score_stream

def _embedding_features(df):
    """One feature per component; the length comes from the data."""
    width = df.agg(F.max(F.size("vector"))).first()[0] or 0
    return {f"d{i}": f"vector[{i}]" for i in range(width)}


def _embedded(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("track_id"), F.col("embedding").alias("vector"), F.col("label").alias("genre"))


def _tracks(spark, folder):
    """Orders as tracks: one unique key, price as popularity, order and line figures as audio features.

    Stored once: training and scoring read them many times.
    """
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.avg("l_discount").alias("danceability"), F.avg("l_tax").alias("speechiness"),
        F.avg("l_quantity").alias("acousticness"), F.sum("l_extendedprice").alias("instrumentalness"),
        F.max("l_linenumber").cast("double").alias("valence"),
    )
    orders = table(spark, folder, "orders")
    tracks = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("track_id"), F.col("o_orderpriority").alias("genre"),
        (F.col("o_totalprice") / 5000).alias("popularity"), "danceability",
        (F.col("acousticness") / 50).alias("energy"), (-F.col("instrumentalness") / 10000).alias("loudness"),
        "speechiness", "acousticness", "instrumentalness", "valence",
    )
    return materialise(tracks, "tracks")


@query()
def genre_predictions(spark, folder):
    """Forest on a stratified split: each test row with its class, best three and correctness."""
    rows = _embedded(spark, folder)
    _, scored = train_classifier(rows, "genre", "track_id", _embedding_features(rows))
    judged = with_actual(scored, "genre", "predicted", numeric=False)
    return judged.select(
        "track_id", "genre", "predicted", "correct",
        F.col("top_predictions")[0]["score"].alias("best_score"), F.col("top_predictions")[1]["name"].alias("second"))


@query()
def genre_scores(spark, folder):
    rows = _embedded(spark, folder)
    _, scored = train_classifier(rows, "genre", "track_id", _embedding_features(rows))
    return classification_metrics(scored.withColumn("genre", F.col("genre").cast("string")), "genre", "predicted")


@query()
def popularity_scores(spark, folder):
    tracks = _tracks(spark, folder)
    _, scored = train_regressor(tracks, "popularity", "track_id")
    return regression_metrics(scored, "popularity", "predicted")


@query()
def energy_scores(spark, folder):
    """Without the features that give the target away."""
    tracks = _tracks(spark, folder)
    features = {n: e for n, e in energy_features(tracks).items() if n != "acousticness"}
    _, scored = train_regressor(tracks, "energy", "track_id", features)
    return regression_metrics(scored, "energy", "predicted")


@query()
def cluster_profile(spark, folder):
    tracks = _tracks(spark, folder)
    scored = score_clusters(tracks, train_clusters(tracks)).drop("centre_distances")
    sizes = group_sizes(scored, "cluster")
    return sizes.join(group_centroids(scored, "cluster", ["danceability", "energy", "loudness", "valence"]), "cluster")


@query()
def cluster_distances(spark, folder):
    tracks = _tracks(spark, folder)
    scored = score_clusters(tracks, train_clusters(tracks))
    return scored.select("track_id", "cluster", F.col("centre_distances")[0].alias("to_0"), F.col("centre_distances")[1].alias("to_1"))


@query()
def all_predictions(spark, folder):
    """Saved models, loaded again, side by side on every track."""
    tracks = _tracks(spark, folder)
    base = scratch_dir(spark, "models")
    energy, _ = train_regressor(tracks, "energy", "track_id", energy_features(tracks))
    popularity, _ = train_regressor(tracks, "popularity", "track_id")
    save(energy, f"{base}/energy")
    save(popularity, f"{base}/popularity")
    scored = score_all(tracks, energy=load(f"{base}/energy"), popularity=load(f"{base}/popularity"))
    return with_actual(scored, "energy", "predicted_energy", numeric=True).select(
        "track_id", "predicted_energy", "predicted_popularity", "abs_error")


@query()
def importance_ranking(spark, folder):
    model, _ = train_regressor(_tracks(spark, folder), "popularity", "track_id")
    return importances(model)


@query()
def columns_by_importance(spark, folder):
    """Tracks reduced to the features that matter to a forest."""
    tracks = _tracks(spark, folder)
    model, _ = train_regressor(tracks, "popularity", "track_id")
    weights = {r["feature"]: r["importance"] for r in importances(model, len(feature_names(model))).collect()}
    return select_by_importance(tracks, weights, ["track_id", "genre"], 0.05)


@query("""
    WITH lines AS (
        SELECT l_orderkey, avg(l_discount) AS danceability, avg(l_tax) AS speechiness, avg(l_quantity) AS acousticness,
               sum(l_extendedprice) AS instrumentalness, max(l_linenumber)::DOUBLE AS valence FROM lineitem GROUP BY 1),
    tracks AS (
        SELECT o_orderkey AS track_id, danceability, acousticness / 50 AS energy, -instrumentalness / 10000 AS loudness,
               speechiness, acousticness, instrumentalness, valence FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey),
    derived AS (
        SELECT *, danceability * energy AS a, valence / (energy + 0.000001::DOUBLE) AS b, acousticness * instrumentalness AS c,
               speechiness / (energy + 0.000001::DOUBLE) AS d FROM tracks),
    long AS (
        SELECT track_id, unnest(['danceability', 'energy', 'loudness', 'speechiness', 'acousticness', 'instrumentalness', 'valence', 'a', 'b', 'c', 'd']) AS f,
               unnest([danceability, energy, loudness, speechiness, acousticness, instrumentalness, valence, a, b, c, d]) AS v
        FROM derived),
    filled AS (SELECT track_id, f, coalesce(v, median(v) OVER (PARTITION BY f)) AS v FROM long),
    scaled AS (SELECT track_id, f, (v - avg(v) OVER (PARTITION BY f)) / stddev_pop(v) OVER (PARTITION BY f) AS z FROM filled)
    SELECT track_id, round(sqrt(sum(z * z)), 5) AS length FROM scaled GROUP BY 1
""")
def similarity_index_lengths(spark, folder):
    """The scaled vectors of the similarity index, told by their lengths."""
    _, index = similarity_index(_tracks(spark, folder), ["track_id"])
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    return index.select("track_id", F.round(F.sqrt(squares), 5).alias("length"))


@query()
def similar_in_feature_space(spark, folder):
    """Neighbours of the played tracks in the index of scaled features."""
    _, index = similarity_index(_tracks(spark, folder), ["track_id"])
    played = table(spark, folder, "events").select(F.get_json_object("props", "$.k").cast("long").alias("track_id"))
    queries = index.join(played.distinct(), "track_id", "left_semi")
    return rounded(nearest(queries, index, 10), similarity=6)


@query()
def model_training_report(spark, folder):
    """All five models in one job; a failure would be a row, not an end."""
    vectors = _embedded(spark, folder)
    components = _embedding_features(vectors)
    features = {name: components for name in ("genre", "popularity", "energy", "clusters", "similar")}
    tracks = vectors.join(
        table(spark, folder, "part"), F.col("track_id") == F.col("p_partkey"), "left"
    ).select("track_id", "vector", "genre", (F.col("p_size") * 2.0).alias("popularity"),
             (F.col("p_retailprice") / 3000).alias("energy"))
    return train_all(tracks, features=features).select("model", "success", "error", "metric", "value")


@query()
def stream_scores(spark, folder):
    """A saved clustering applied to rows as they arrive."""
    rows = _embedded(spark, folder)
    model = train_clusters(rows, 2, _embedding_features(rows))
    schema = table(spark, folder, "embeddings").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/embeddings.parquet*").select(
        F.col("vec_id").alias("track_id"), F.col("embedding").alias("vector"))
    base = scratch_dir(spark, "scores")
    scored = score_stream(stream, model, lambda df: df.select("track_id", "cluster", vector_to_array("_features")[0].alias("first")))
    scored.writeStream.format("parquet").option("path", f"{base}/rows").option(
        "checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(scored.schema).parquet(f"{base}/rows")
