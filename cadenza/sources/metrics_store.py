"""Model metrics as JSON rows ``(model, metric, value)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The five models, and what is said when one has no metrics.
MODEL_NOTES = {
    "genre_classification": "no accuracy stored; train the model first",
    "energy_regression": "no errors stored; train the model first",
    "popularity_regression": "no errors stored; train the model first",
    "clustering": "no silhouette stored; train the model first",
    "similar_songs": "a neighbour index has no metrics",
}
SCHEMA = "model string, metric string, value double"


def metric_rows(spark: SparkSession, metrics: Mapping[str, Mapping[str, float]]) -> DataFrame:
    return spark.createDataFrame(
        [(m, name, None if v is None else float(v)) for m, values in metrics.items() for name, v in values.items()],
        SCHEMA,
    )


def write_metrics(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.select("model", "metric", "value").write.mode(mode).json(path)


def read_metrics(spark: SparkSession, path: str, models: Sequence[str] | None = None) -> DataFrame:
    """Stored metrics of each model; a model without any gets one row with a note."""
    models = list(models or MODEL_NOTES)
    wanted = spark.createDataFrame(
        [(m, MODEL_NOTES.get(m, "nothing stored")) for m in models], "model string, missing_note string"
    )
    try:
        stored = spark.read.schema(SCHEMA).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], SCHEMA)  # nothing has been trained yet
    return wanted.join(stored, "model", "left").select(
        "model", "metric", "value", F.when(F.col("metric").isNull(), F.col("missing_note")).alias("note")
    )
