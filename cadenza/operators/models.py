"""The five models: training, evaluation, saving, and batch scoring with ``pyspark.ml``.

A fitted pipeline holds everything scoring needs: the formulas of its features, the medians that
fill their gaps and the scaling. So training and scoring cannot drift apart, and a raw track row is
enough to get a prediction.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.constants import CORE_FEATURES, MODEL_FEATURES, SEED, TEST_FRACTION
from cadenza.functions.names import leak_free_features
from cadenza.functions.scalar import clamp, score_map, top_classes
from cadenza.operators.clean import fill
from cadenza.operators.features import MODEL_PARENTS, scaling_stats, standard_scale
from cadenza.operators.forest import store_binned, train_forest
from cadenza.operators.kmeans import best_of_starts, clusters_model
from cadenza.operators.metrics import (
    classification_metrics, regression_metrics, silhouette,
)
from cadenza.operators.profile import group_sizes
from cadenza.operators.quantiles import approximate_medians, exact_medians
from cadenza.operators.sampling import split_random, split_stratified
from cadenza.operators.silhouette import silhouette_estimate

# Forest size and depths, restarts of the clustering.
TREES = 100
REGRESSOR_DEPTH = 10
CLASSIFIER_DEPTH = 30  # the most Spark allows; the goal is unlimited depth
RESTARTS = 10
TOLERANCE = 1e-4  # summed squared shift of the centres, in units of the features' variance

#: Rows of a partition that is trained on: a forest keeps more than a kilobyte for each, and a task reads its partition whole.
PARTITION_ROWS = 250_000

_HIDDEN = "_f_"


def track_features(columns: Sequence[str], exclude: Sequence[str] = ()) -> dict[str, str]:
    """Feature name -> SQL expression over raw track columns, for the features the columns allow."""
    found = {c: f"`{c}`" for c in CORE_FEATURES if c in columns and c not in exclude}
    for name in MODEL_FEATURES:
        a, b = MODEL_PARENTS[name]
        if name in exclude or a not in columns or b not in columns:
            continue
        found[name] = f"try_divide(`{a}`, `{b}` + 1e-6D)" if name.endswith("_Ratio") else f"`{a}` * `{b}`"
    return found


def energy_features(df: DataFrame, target: str = "energy") -> dict[str, str]:
    """Track features without the target and without anything computed from it."""
    derived = df.withColumns({n: F.lit(None).cast("double") for n in MODEL_FEATURES if n not in df.columns})
    allowed = set(leak_free_features(derived, target, MODEL_PARENTS))
    return {n: e for n, e in track_features(df.columns).items() if n in allowed}


def _number(value: float | None) -> str:
    return "0D" if value is None else f"{float(value)!r}D"


def _clean(expression: str) -> str:
    """NULL for NaN and the infinities: neither is below infinity."""
    return f"CASE WHEN abs(CAST({expression} AS DOUBLE)) < DOUBLE('Infinity') THEN CAST({expression} AS DOUBLE) END"


@contextmanager
def _filled(df: DataFrame, features: Mapping[str, str], scale: bool = False, label: str | None = None,
            gaps: str = "median", exact: bool = True):
    """The feature stages fitted on ``df``, the columns of numbers without gaps (and label) to train on, their row count
    and their partitions.

    The input is evaluated once: statistics and the trainer read the cached numbers.
    """
    names = list(features)
    labels = [label] if label else []
    raw = df.selectExpr(*[f"{_clean(e)} AS `{n}`" for n, e in features.items()], *labels)
    raw = raw.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = raw.count()
        medians = {n: 0.0 for n in names}
        if gaps == "median":
            medians = exact_medians(raw, names, rows=rows) if exact else approximate_medians(raw, names)
        medians = {n: m or 0.0 for n, m in medians.items()}
        filled = fill(raw, medians)
        columns = {n: f"coalesce({_clean(features[n])}, {_number(medians[n])})" for n in names}
        if scale:
            stats = scaling_stats(filled, names)
            filled = standard_scale(filled, names, stats)
            columns = {n: f"({e} - {_number(stats[n][0])}) / {_number(stats[n][1] or 1.0)}" for n, e in columns.items()}
        listed = ", ".join(f"{e} AS `{_HIDDEN}{n}`" for n, e in columns.items())
        stages = [
            SQLTransformer(statement=f"SELECT *, {listed} FROM __THIS__"),
            VectorAssembler(inputCols=[f"{_HIDDEN}{n}" for n in names], outputCol="_features"),
        ]
        yield stages, filled.select(*names, *labels), rows, raw.rdd.getNumPartitions()
    finally:
        raw.unpersist()


@contextmanager
def _prepared(df: DataFrame, features: Mapping[str, str], scale: bool = False, label: str | None = None,
              gaps: str = "median", exact: bool = True):
    """The feature stages fitted on ``df``, and the vectors (and label) to train on.

    AQE packs a small table into one partition; training is bound by computing, not by bytes, so the
    vectors of such a table are spread over the cores. Those of a large one are dealt anew if its partitions would be of
    more than about ``PARTITION_ROWS`` rows.
    """
    with _filled(df, features, scale, label, gaps, exact) as (stages, filled, rows, partitions):
        vectors = VectorAssembler(inputCols=list(features), outputCol="_features").transform(filled).select(
            "_features", *([label] if label else []))
        wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // PARTITION_ROWS))
        if partitions < wanted:
            vectors = vectors.repartition(wanted)
        yield stages, vectors


def _spread(numbers: DataFrame, partitions: int) -> DataFrame:
    """Rows of a small table over the cores."""
    wanted = numbers.sparkSession.sparkContext.defaultParallelism
    return numbers.repartition(wanted) if partitions < wanted else numbers


def feature_names(model: PipelineModel) -> list[str]:
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            return [c.removeprefix(_HIDDEN) for c in stage.getInputCols()]
    raise ValueError("the pipeline has no feature vector")


def _visible(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


# --- training ---------------------------------------------------------------------------------


def train_classifier(df: DataFrame, target: str, key: str, features: Mapping[str, str] | None = None,
                     trees: int = TREES, depth: int = CLASSIFIER_DEPTH, test_fraction: float = TEST_FRACTION,
                     seed: int = SEED) -> tuple[PipelineModel, DataFrame]:
    """Random-forest classifier on a stratified split: the fitted pipeline and its scored test rows."""
    features = features or track_features(df.columns)
    labelled = split_stratified(df.filter(F.col(target).isNotNull()), key, target, test_fraction, seed)
    train, test = labelled.filter(~F.col("is_test")), labelled.filter("is_test")
    train = train.withColumn("_label_text", F.col(target).cast("string"))
    indexer = StringIndexer(inputCol="_label_text", outputCol="_label", stringOrderType="alphabetAsc")
    with _filled(train, features, label="_label_text") as (stages, numbers, _, partitions):
        indexed = indexer.fit(numbers)
        stored, points = store_binned(_spread(indexed.transform(numbers), partitions), list(features), "_label")
    fitted = train_forest(stored, points, len(indexed.labels), trees, depth, math.ceil(math.sqrt(len(features))), seed)
    names = IndexToString(inputCol="_prediction", outputCol="predicted", labels=indexed.labels)
    model = PipelineModel(stages=[*stages, fitted, names])
    return model, score_classes(test, model)


def train_regressor(df: DataFrame, target: str, key: str, features: Mapping[str, str] | None = None,
                    trees: int = TREES, depth: int = REGRESSOR_DEPTH, test_fraction: float = TEST_FRACTION,
                    seed: int = SEED) -> tuple[PipelineModel, DataFrame]:
    """Random-forest regressor on a random split. A missing target takes the target's median."""
    features = features or track_features(df.columns, exclude=[target])
    labelled = fill(df, exact_medians(df, [target])).withColumn("_label", F.col(target).cast("double"))
    split = split_random(labelled, key, test_fraction, seed)
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    with _filled(train, features, label="_label") as (stages, numbers, _, partitions):
        stored, points = store_binned(_spread(numbers, partitions), list(features), "_label")
    fitted = train_forest(stored, points, 0, trees, depth, len(features), seed)
    model = PipelineModel(stages=[*stages, fitted])
    return model, _visible(model.transform(test))


def train_clusters(df: DataFrame, k: int = 2, features: Mapping[str, str] | None = None, restarts: int = RESTARTS,
                   seed: int = SEED, max_iterations: int = 300) -> PipelineModel:
    """K-means on scaled features; of several starts the one with the least cost is kept."""
    features = features or track_features(df.columns)
    tolerance = math.sqrt(TOLERANCE / k)
    with _filled(df, features, scale=True) as (stages, numbers, _, partitions):
        centres, _ = best_of_starts(_spread(numbers, partitions), list(features), k, [seed + i for i in range(restarts)],
                                    max_iterations, tolerance)
    best = clusters_model(centres, "_features", "cluster")
    return PipelineModel(stages=[*stages, best])


def similarity_index(df: DataFrame, info: Sequence[str], features: Mapping[str, str] | None = None,
                     ) -> tuple[PipelineModel, DataFrame]:
    """Scaled feature vectors beside the columns shown for a hit: save it as Parquet to keep it."""
    features = features or track_features(df.columns)
    with _prepared(df, features, scale=True) as (stages, _):
        scaler = PipelineModel(stages=stages)
    return scaler, index_rows(df, scaler, info)


def index_rows(df: DataFrame, scaler: PipelineModel, info: Sequence[str]) -> DataFrame:
    """Vectors of any rows in the space of a saved index."""
    names = [F.col(f"{_HIDDEN}{n}") for n in feature_names(scaler)]
    return scaler.transform(df).select(*info, F.array(*names).alias("vector"))


# --- scoring ----------------------------------------------------------------------------------


def class_names(model: PipelineModel) -> list[str]:
    return model.stages[-1].getLabels()


def score_classes(df: DataFrame, model: PipelineModel, top: int = 3) -> DataFrame:
    """Adds the predicted class, the probability of each class and the best ``top`` classes."""
    names = class_names(model)
    scores = vector_to_array("_probability")
    scored = model.transform(df).withColumns({
        "probabilities": score_map(names, scores),
        "top_predictions": top_classes(names, scores, top),
    })
    return _visible(scored)


def score_number(df: DataFrame, model: PipelineModel, low: float, high: float, name: str = "predicted") -> DataFrame:
    """Adds the prediction of a regressor, kept within its range."""
    scored = model.transform(df).withColumn("predicted", clamp(F.col("predicted"), low, high))
    return _visible(scored).withColumnRenamed("predicted", name)


def score_clusters(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds the cluster and the distance to every centre, in scaled units."""
    inputs = [F.col(f"{_HIDDEN}{n}") for n in feature_names(model)]
    distances = []
    for centre in model.stages[-1].clusterCenters():
        squares = [(c - F.lit(float(v))) ** 2 for c, v in zip(inputs, centre)]
        distances.append(F.sqrt(sum(squares[1:], squares[0])))
    scored = model.transform(df).withColumn("centre_distances", F.array(*distances))
    return _visible(scored)


def score_all(df: DataFrame, genre: PipelineModel | None = None, energy: PipelineModel | None = None,
              popularity: PipelineModel | None = None, clusters: PipelineModel | None = None) -> DataFrame:
    """All available predictions beside each track: one narrow chain, no shuffle."""
    if genre is not None:
        df = score_classes(df, genre).withColumnRenamed("predicted", "predicted_genre")
    if energy is not None:
        df = score_number(df, energy, 0.0, 1.0, "predicted_energy")
    if popularity is not None:
        df = score_number(df, popularity, 0.0, 100.0, "predicted_popularity")
    if clusters is not None:
        df = score_clusters(df, clusters)
    return df


def with_actual(df: DataFrame, actual: str, predicted: str, numeric: bool) -> DataFrame:
    """Adds ``abs_error`` for numbers, ``correct`` for classes."""
    if numeric:
        return df.withColumn("abs_error", F.abs(F.col(actual) - F.col(predicted)))
    return df.withColumn("correct", F.col(actual).cast("string") == F.col(predicted))


def add_absent(df: DataFrame, columns: Sequence[str], policy: str = "strict") -> DataFrame:
    """Prepare rows for scoring: ``strict`` raises for an absent column, ``lenient`` adds it as 0.0."""
    absent = [c for c in columns if c not in df.columns]
    if absent and policy == "strict":
        raise ValueError(f"missing required features: {absent}")
    return df.withColumns({c: F.lit(0.0) for c in absent}) if absent else df


def importances(model: PipelineModel, top: int = 10) -> DataFrame:
    """Most important features of a forest, best first."""
    forest = next(s for s in model.stages if hasattr(s, "featureImportances"))
    weights = forest.featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(feature_names(model), weights)]
    spark = SparkSession.active()
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    ).limit(top)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- all five ---------------------------------------------------------------------------------


def run_jobs(spark: SparkSession, jobs: Mapping[str, Callable[[], Mapping[str, float]]]) -> DataFrame:
    """Run named jobs one after another; a failure is recorded and does not stop the rest.

    ``(model, success, seconds, error, metric, value)``, one row per metric.
    """
    rows = []
    for name, job in jobs.items():
        start = time.monotonic()
        try:
            found, error = dict(job()), None
        except Exception as e:  # a failed model is a result here
            found, error = {}, f"{type(e).__name__}: {e}"[:500]
        seconds = time.monotonic() - start
        for metric, value in (found or {None: None}).items():
            rows.append((name, error is None, seconds, error, metric, None if value is None else float(value)))
    return spark.createDataFrame(
        rows, "model string, success boolean, seconds double, error string, metric string, value double"
    )


def train_all(df: DataFrame, key: str = "track_id", genre: str = "genre", popularity: str = "popularity",
              energy: str = "energy", clusters: int = 2, save_to: str | None = None, trees: int = TREES,
              info: Sequence[str] = ("track_id", "artist_name", "track_name", "genre", "popularity"),
              features: Mapping[str, Mapping[str, str]] | None = None,
              silhouette_error: float | None = None) -> DataFrame:
    """Train, evaluate and optionally save all five models over one cached table.

    With ``silhouette_error`` the silhouette is estimated to that error, else it is exact and quadratic.
    """
    features = features or {}
    spark = df.sparkSession
    data = df.persist(StorageLevel.MEMORY_AND_DISK)

    def keep(model, name):
        if save_to:
            save(model, f"{save_to}/{name}")

    def genre_job():
        model, scored = train_classifier(data, genre, key, features.get("genre"), trees=trees)
        keep(model, "genre_classification")
        labels = scored.withColumn("_actual", F.col(genre).cast("string"))
        return classification_metrics(labels, "_actual", "predicted").first().asDict()

    def popularity_job():
        model, scored = train_regressor(data, popularity, key, features.get("popularity"), trees=trees)
        keep(model, "popularity_regression")
        return regression_metrics(scored, popularity, "predicted").first().asDict()

    def energy_job():
        model, scored = train_regressor(data, energy, key, features.get("energy") or energy_features(data, energy),
                                        trees=trees)
        keep(model, "energy_regression")
        return regression_metrics(scored, energy, "predicted").first().asDict()

    def cluster_job():
        model = train_clusters(data, clusters, features.get("clusters"))
        keep(model, "clustering")
        vectors = model.transform(data).select(
            F.col(key), "cluster", vector_to_array("_features").alias("vector")
        )
        found = (silhouette(vectors, key, "vector", "cluster") if silhouette_error is None else
                 silhouette_estimate(vectors, key, "vector", "cluster", silhouette_error)).first()
        sizes = {f"cluster_{r['cluster']}": r["count"] for r in group_sizes(vectors, "cluster").collect()}
        return {"silhouette_score": found["silhouette_score"], **sizes}

    def similar_job():
        scaler, index = similarity_index(data, [c for c in info if c in data.columns], features.get("similar"))
        keep(scaler, "similar_songs")
        if save_to:
            index.write.mode("overwrite").parquet(f"{save_to}/similar_songs_index")
        return {"indexed": index.count()}

    try:
        return run_jobs(spark, {
            "genre_classification": genre_job, "clustering": cluster_job, "similar_songs": similar_job,
            "popularity_regression": popularity_job, "energy_regression": energy_job,
        })
    finally:
        data.unpersist()
