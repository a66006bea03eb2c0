"""Data-quality reports, drift between two tables, and model gates.

Every report is a DataFrame ``(check, column, value, threshold, severity, passed)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.constants import (
    MAX_DUPLICATE_FRACTION, MAX_MISSING_PERCENT, MAX_OUTLIER_FRACTION, MIN_ACCURACY, MIN_CLASS_ROWS,
    OUTLIER_IQR_FACTOR, REQUIRED_COLUMNS,
)
from cadenza.functions.names import missing_columns, numeric_columns
from cadenza.operators.metrics import classification_metrics, majority_baseline, regression_metrics
from cadenza.operators.profile import (
    constant_columns, duplicate_report, missing_profile, outlier_report, repeated_keys, small_classes,
)
from cadenza.operators.quantiles import exact_quantiles

REPORT = "check string, column string, value double, threshold double, severity string, passed boolean"


def _report(df: DataFrame, check: str, column, value, threshold, severity: str, passed) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"), column.cast("string").alias("column"), value.cast("double").alias("value"),
        F.lit(threshold).cast("double").alias("threshold"), F.lit(severity).alias("severity"), passed.alias("passed"),
    )


def _rows(df: DataFrame, rows) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, REPORT)


def schema_report(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """One row per required column; no job runs."""
    absent = set(missing_columns(df, required))
    return _rows(df, [("schema", c, float(c not in absent), 1.0, "error", c not in absent) for c in required])


def quality_report(df: DataFrame, target: str, min_class: int = MIN_CLASS_ROWS,
                   max_missing: float = MAX_MISSING_PERCENT,
                   max_duplicates: float = MAX_DUPLICATE_FRACTION) -> DataFrame:
    """Empty table, absent target, small classes, columns mostly missing, duplicate rows: all are errors.

    Passing classes are summed up in one row, so the report stays small with many classes.
    """
    if target not in df.columns:
        return _rows(df, [("target_present", target, 0.0, 1.0, "error", False)])
    if df.limit(1).count() == 0:
        return _rows(df, [("not_empty", None, 0.0, 1.0, "error", False)])
    few = small_classes(df, target, min_class)
    classes = _report(few, "class_size", F.col(target), F.col("count"), min_class, "error", F.lit(False))
    all_classes = few.agg(F.count(F.lit(1)).alias("n"))
    summary = _report(all_classes, "small_classes", F.lit(target), F.col("n"), 0, "error", F.col("n") == 0)
    percent = F.col("missing_percent")
    missing = _report(missing_profile(df), "missing_percent", F.col("column"), percent, max_missing, "error",
                      percent <= max_missing)
    copies = duplicate_report(df)
    fraction = F.col("duplicates") / F.col("rows")
    duplicates = _report(copies, "duplicate_fraction", F.lit(None), fraction, max_duplicates, "error",
                         F.col("duplicates") <= F.col("rows") * max_duplicates)
    return classes.unionByName(summary).unionByName(missing).unionByName(duplicates)


def key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many key values are repeated."""
    repeated = repeated_keys(df, keys).agg(F.count(F.lit(1)).alias("n"))
    return _report(repeated, "unique_key", F.lit(",".join(keys)), F.col("n"), 0, "error", F.col("n") == 0)


def distribution_report(df: DataFrame, columns: Sequence[str] | None = None,
                        factor: float = OUTLIER_IQR_FACTOR, max_outliers: float = MAX_OUTLIER_FRACTION) -> DataFrame:
    """Constant columns and columns with many extreme outliers: warnings only."""
    columns = list(columns if columns is not None else numeric_columns(df))
    constant = _report(constant_columns(df, columns), "constant", F.col("column"), F.col("constant").cast("int"), 0,
                       "warning", ~F.col("constant"))
    fraction = F.col("outliers") / F.col("rows")
    outliers = _report(outlier_report(df, columns, factor), "outlier_fraction", F.col("column"), fraction,
                       max_outliers, "warning", F.col("outliers") <= F.col("rows") * max_outliers)
    return constant.unionByName(outliers)


def validation_report(df: DataFrame, target: str, required: Sequence[str] = REQUIRED_COLUMNS,
                      numeric: Sequence[str] | None = None) -> DataFrame:
    return (
        schema_report(df, required)
        .unionByName(quality_report(df, target))
        .unionByName(distribution_report(df, numeric))
    )


def verdict(report: DataFrame) -> DataFrame:
    """Errors fail the job, warnings do not."""
    failed = ~F.col("passed")
    return report.agg(
        F.count_if(failed & (F.col("severity") == "error")).alias("errors"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("warnings"),
    ).withColumn("passed", F.col("errors") == 0)


def require_valid(report: DataFrame) -> None:
    """Raise if a report has errors."""
    row = verdict(report).first()
    if not row["passed"]:
        raise ValueError(f"validation failed: {row['errors']} errors, {row['warnings']} warnings")


def _bucket_number(column: str, edges: Sequence[float]):
    """Number of edges below the value: 0 … len(edges)."""
    c = F.col(column)
    return sum((F.when(c > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))


def quantile_edges(df: DataFrame, columns: Sequence[str], buckets: int = 10) -> dict[str, list[float]]:
    probs = [i / buckets for i in range(1, buckets)]
    found = exact_quantiles(df, columns, probs)
    return {c: sorted(set(e for e in edges if e is not None)) for c, edges in found.items()}


def bucket_counts(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Rows per column and bucket; one scan for all columns, at most a few rows per column and task leave it."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"),
                 F.when(F.col(c).isNotNull(), _bucket_number(c, e)).alias("bucket"))
        for c, e in edges.items()
    ])
    return (
        df.select(F.explode(cells).alias("cell")).select("cell.*").filter(F.col("bucket").isNotNull())
        .groupBy("column", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    )


def drift(reference: DataFrame, current: DataFrame, columns: Sequence[str], buckets: int = 10,
          floor: float = 1e-4) -> DataFrame:
    """Population stability index and largest gap of the cumulative shares, over the reference's quantile buckets."""
    edges = quantile_edges(reference, columns, buckets)
    spark = reference.sparkSession
    cells = spark.createDataFrame(
        [(c, b) for c, e in edges.items() for b in range(len(e) + 1)], "column string, bucket int"
    )
    a = bucket_counts(reference, edges).withColumnRenamed("rows", "a")
    b = bucket_counts(current, edges).withColumnRenamed("rows", "b")
    # counts of a few buckets per column on every side
    joined = cells.join(F.broadcast(a), ["column", "bucket"], "left").join(F.broadcast(b), ["column", "bucket"], "left").na.fill(
        0, subset=["a", "b"]
    )
    whole = Window.partitionBy("column")
    upto = whole.orderBy("bucket")
    share = {s: F.col(s) / F.sum(s).over(whole) for s in ("a", "b")}
    shares = joined.withColumns({"pa": share["a"], "pb": share["b"]})
    gaps = shares.withColumn("gap", F.abs(F.sum("pa").over(upto) - F.sum("pb").over(upto)))
    pa, pb = F.greatest("pa", F.lit(floor)), F.greatest("pb", F.lit(floor))
    return gaps.groupBy("column").agg(
        F.sum((pb - pa) * F.log(pb / pa)).alias("psi"), F.max("gap").alias("ks")
    )


def drift_report(reference: DataFrame, current: DataFrame, columns: Sequence[str], max_psi: float = 0.2,
                 buckets: int = 10) -> DataFrame:
    """Drift as warnings: it is reported and never blocks."""
    measured = drift(reference, current, columns, buckets)
    return _report(measured, "drift_psi", F.col("column"), F.col("psi"), max_psi, "warning", F.col("psi") <= max_psi)


def split_report(train: DataFrame, test: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Train/test checks: labels that only the test part has are errors, drift is a warning."""
    unseen = test.select(label).distinct().join(train.select(label).distinct(), label, "left_anti")
    count = unseen.filter(F.col(label).isNotNull()).agg(F.count(F.lit(1)).alias("n"))
    labels = _report(count, "unseen_labels", F.lit(label), F.col("n"), 0, "error", F.col("n") == 0)
    return labels.unionByName(drift_report(train, test, features))


def weak_segments(df: DataFrame, feature: str, label: str, prediction: str, buckets: int = 4) -> DataFrame:
    """Error rate per quantile bucket of a feature."""
    edges = quantile_edges(df, [feature], buckets)[feature]
    wrong = F.when(F.col(label) != F.col(prediction), 1.0).otherwise(0.0)
    return df.filter(F.col(feature).isNotNull()).groupBy(_bucket_number(feature, edges).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(wrong).alias("error_rate"),
        F.min(feature).alias("low"), F.max(feature).alias("high"),
    )


def integrity_report(df: DataFrame, target: str, numeric: Sequence[str] | None = None) -> DataFrame:
    return quality_report(df, target).unionByName(distribution_report(df, numeric))


def accuracy_gate(df: DataFrame, label: str, prediction: str, minimum: float = MIN_ACCURACY) -> DataFrame:
    measured = classification_metrics(df, label, prediction)
    return _report(measured, "accuracy", F.lit(prediction), F.col("accuracy"), minimum, "error",
                   F.col("accuracy") >= minimum)


def evaluation_report(df: DataFrame, label: str, prediction: str, split: str, regression: bool = False) -> DataFrame:
    """Informational ``(split, metric, value)`` rows, with the majority baseline for classifiers."""
    if regression:
        row, names = regression_metrics(df, label, prediction), ["r2_score", "mse", "rmse", "mae"]
    else:
        row, names = classification_metrics(df, label, prediction), ["accuracy", "precision", "recall", "f1_score"]
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
    rows = row.select(F.explode(cells).alias("cell")).select(F.lit(split).alias("split"), "cell.*")
    if not regression:
        base = majority_baseline(df, label).select(
            F.lit(split).alias("split"), F.lit("baseline_accuracy").alias("metric"), F.col("accuracy").alias("value")
        )
        rows = rows.unionByName(base)
    return rows
