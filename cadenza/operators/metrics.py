"""Quality figures of classifiers, regressors and clusterings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.constants import SEED
from cadenza.operators.sampling import seeded_sample
from cadenza.operators.silhouette import block_sums
from cadenza.session import materialise


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("count")
    )


def confusion_wide(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """One row per label, one column per listed class."""
    return df.groupBy(F.col(label).alias("label")).agg(*[
        F.count_if(F.col(prediction) == F.lit(c)).alias(f"predicted_{c}") for c in classes
    ])


def _over(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class. All work after the first count is on class pairs."""
    pairs = confusion(df, label, prediction)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("count").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"), F.col("count").alias("predicted")),
    )
    hit = F.when((F.col("label") == F.col("prediction")) & (F.col("side.support") > 0), F.col("count"))
    totals = (
        pairs.withColumn("side", F.explode(sides))
        .groupBy(F.col("side.class").alias("class"))
        .agg(
            F.sum("side.support").alias("support"),
            F.sum("side.predicted").alias("predicted"),
            F.coalesce(F.sum(hit), F.lit(0)).alias("correct"),
        )
    )
    precision = _over(F.col("correct").cast("double"), F.col("predicted"))
    recall = _over(F.col("correct").cast("double"), F.col("support"))
    return totals.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1_score", _over(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    ).select("class", "precision", "recall", "f1_score", "support", "predicted", "correct")


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 as one row."""
    report = class_report(df, label, prediction)
    support = F.sum("support")
    return report.agg(
        (F.sum("correct") / support).alias("accuracy"),
        *[(F.sum(F.col(m) * F.col("support")) / support).alias(m) for m in ("precision", "recall", "f1_score")],
    )


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """R², MSE, RMSE and MAE in one scan, over rows that have both; the label's spread is its variance."""
    error = F.col(label) - F.col(prediction)
    row = df.filter(error.isNotNull()).agg(
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(label).alias("_variance"),
    )
    return row.select(
        F.when(F.col("_variance") > 0, 1 - F.col("mse") / F.col("_variance")).alias("r2_score"),
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mae",
    )


def majority_baseline(df: DataFrame, label: str) -> DataFrame:
    """Accuracy of always answering the most frequent class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg((F.max("n") / F.sum("n")).alias("accuracy"))


def silhouette_points(df: DataFrame, key: str, vector: str, cluster: str, sample: int | None = None,
                      seed: int = SEED) -> DataFrame:
    """Euclidean silhouette of each point: ``(key, cluster, silhouette)``.

    All points are scored against all others: pairs of bounded blocks of points meet in one task, which
    adds up distances per cluster, so no pair of points is ever a row and nothing passes through the driver. The work is
    quadratic by definition; ``sample`` takes so many seeded points for a figure at less cost.
    """
    points = df.select(F.col(key).alias("key"), F.col(cluster).cast("string").alias("cluster"),
                       F.col(vector).cast("array<double>").alias("vector"))
    if sample is not None:
        points = seeded_sample(points, "key", sample, seed)
    points = materialise(points.withColumn("at", F.monotonically_increasing_id()), "silhouette")
    totals = block_sums(points.select("at", "vector"), points.select("cluster", "vector")).withColumnRenamed("other", "other_cluster")
    sizes = points.groupBy(F.col("cluster").alias("other_cluster")).agg(F.count(F.lit(1)).alias("size"))
    own = F.coalesce(F.col("other_cluster") == F.col("cluster"), F.lit(False))
    sums = totals.groupBy("at", "other_cluster").agg(F.sum("total").alias("total")).join(sizes, "other_cluster")
    scored = sums.join(points.select("at", "key", "cluster"), "at").groupBy("at", "key", "cluster").agg(
        F.max(F.when(own & (F.col("size") > 1), F.col("total") / (F.col("size") - 1))).alias("within"),
        F.min(F.when(~own, F.col("total") / F.col("size"))).alias("nearest"))
    best = F.greatest("within", "nearest")
    return scored.select("key", "cluster", F.when(
        F.col("within").isNotNull() & F.col("nearest").isNotNull() & (best > 0),
        (F.col("nearest") - F.col("within")) / best).otherwise(0.0).alias("silhouette"))


def silhouette(df: DataFrame, key: str, vector: str, cluster: str, sample: int | None = None,
               seed: int = SEED) -> DataFrame:
    points = silhouette_points(df, key, vector, cluster, sample, seed)
    return points.agg(F.avg("silhouette").alias("silhouette_score"), F.count(F.lit(1)).alias("points"))


def error_samples(df: DataFrame, label: str, prediction: str, key: str, n: int = 10) -> DataFrame:
    """First rows by key with their absolute error."""
    return df.orderBy(key).limit(n).withColumn("abs_error", F.abs(F.col(label) - F.col(prediction)))
