"""Counts, statistics and duplicate reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.names import numeric_columns
from cadenza.functions.scalar import label_missing, row_digest
from cadenza.operators.quantiles import exact_quantiles
from cadenza.constants import MIN_CLASS_ROWS, OUTLIER_IQR_FACTOR


def value_counts(df: DataFrame, column: str, missing_label: str | None = None) -> DataFrame:
    """Rows per value. NULLs are left out, or counted under ``missing_label`` if one is given."""
    value = F.col(column)
    if missing_label is None:
        df = df.filter(value.isNotNull())
    else:
        value = label_missing(value, missing_label)
    return df.groupBy(value.alias(column)).agg(F.count(F.lit(1)).alias("count"))


def most_frequent_first(counts: DataFrame, column: str) -> DataFrame:
    return counts.orderBy(F.desc("count"), F.asc_nulls_last(column))


def small_classes(df: DataFrame, column: str, minimum: int = MIN_CLASS_ROWS) -> DataFrame:
    return value_counts(df, column).filter(F.col("count") < minimum)


def _is_missing(df: DataFrame, column: str) -> Column:
    """NULL, or NaN in a float or double column."""
    c = F.col(column)
    floating = isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))
    return (c.isNull() | F.isnan(c)) if floating else c.isNull()


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: rows, missing rows, missing percent. One scan, constant-size buffers."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(_is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)],
    )
    return _one_row_per_column(counted, columns, "m", "missing", ["rows"]).withColumn(
        "missing_percent",
        F.when(F.col("rows") > 0, F.col("missing") * F.lit(100.0) / F.col("rows")),
    )


def _one_row_per_column(row: DataFrame, columns, prefix: str, name: str, carry: Sequence[str]) -> DataFrame:
    """Turn the single row ``(carry…, prefix0, prefix1, …)`` into ``(column, carry…, name)`` rows."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{prefix}{i}").alias(name)) for i, c in enumerate(columns)
    ])
    return row.select(*carry, F.explode(cells).alias("cell")).select("cell.column", *carry, f"cell.{name}")


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-NULL values per column, exact by default."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    row = df.agg(*[count(F.col(c)).alias(f"d{i}") for i, c in enumerate(columns)])
    return _one_row_per_column(row, columns, "d", "distinct_values", [])


def target_stats(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, range and exact median of one numeric column."""
    median = exact_quantiles(df, [column], [0.5])[column][0]
    c = F.col(column)
    return df.agg(
        F.count(c).alias("rows"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    ).withColumn("median", F.lit(median).cast("double"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column as ``(column, mode_number, mode_text, count)``, ties to the smallest.

    Values are counted before the shuffle, so a frequent value costs one row per task.
    """
    return typed_modes(df, columns).select(
        "column", F.coalesce("mode_number", F.col("mode_whole").cast("double")).alias("mode_number"), "mode_text", "count")


def typed_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As ``modes``, with whole numbers kept as they are in ``mode_whole``: a double has no room for a large long."""
    numeric = set(numeric_columns(df))
    integral = {f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)} & numeric

    def cell(c):
        number = F.col(c).cast("double")
        parts = {
            "whole": F.col(c).cast("long") if c in integral else F.lit(None).cast("long"),
            "number": F.when(~F.isnan(number), number) if c in numeric - integral else F.lit(None).cast("double"),
            "text": F.lit(None).cast("string") if c in numeric else F.col(c).cast("string"),
        }
        return F.struct(F.lit(c).alias("column"), *[v.alias(k) for k, v in parts.items()])

    values = (
        df.select(F.explode(F.array(*[cell(c) for c in columns])).alias("cell")).select("cell.*")
        .filter(F.col("whole").isNotNull() | F.col("number").isNotNull() | F.col("text").isNotNull())
        .groupBy("column", "whole", "number", "text")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    best = values.groupBy("column").agg(
        F.min(F.struct((-F.col("count")).alias("order"), "whole", "number", "text")).alias("best")
    )
    return best.select(
        "column",
        F.col("best.whole").alias("mode_whole"),
        F.col("best.number").alias("mode_number"),
        F.col("best.text").alias("mode_text"),
        (-F.col("best.order")).alias("count"),
    )


def iqr_bounds(df: DataFrame, columns: Sequence[str], factor: float = OUTLIER_IQR_FACTOR) -> dict[str, tuple]:
    """``{column: (q1, q3, low, high)}`` from exact quartiles; columns without values are left out."""
    bounds = {}
    for c, (q1, q3) in exact_quantiles(df, columns, [0.25, 0.75]).items():
        if q1 is not None:
            spread = factor * (q3 - q1)
            bounds[c] = (q1, q3, q1 - spread, q3 + spread)
    return bounds


def outlier_report(df: DataFrame, columns: Sequence[str], factor: float = OUTLIER_IQR_FACTOR) -> DataFrame:
    """Rows outside ``[q1 - factor*iqr, q3 + factor*iqr]`` per column; columns with iqr 0 are left out."""
    bounds = {c: b for c, b in iqr_bounds(df, columns, factor).items() if b[1] > b[0]}
    schema = "column string, q1 double, q3 double, low double, high double, outliers bigint, rows bigint"
    if not bounds:
        return df.sparkSession.createDataFrame([], schema)
    names = list(bounds)
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count_if((F.col(c) < F.lit(bounds[c][2])) | (F.col(c) > F.lit(bounds[c][3]))).alias(f"o{i}")
            for i, c in enumerate(names)
        ],
    )
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            *[F.lit(float(v)).alias(n) for n, v in zip(("q1", "q3", "low", "high"), bounds[c])],
            F.col(f"o{i}").alias("outliers"),
        )
        for i, c in enumerate(names)
    ])
    return counted.select(F.explode(cells).alias("cell"), "rows").select("cell.*", "rows")


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Numeric columns with exactly one distinct value: lowest equals highest, one scan, no shuffle of values."""
    columns = list(columns if columns is not None else numeric_columns(df))
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, constant boolean")
    row = df.agg(*[
        F.coalesce(F.min(c) == F.max(c), F.lit(False)).alias(f"k{i}") for i, c in enumerate(columns)
    ])
    return _one_row_per_column(row, columns, "k", "constant", [])


def nested_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}


def _comparable(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """-0.0 and 0.0 are one value, as they are for GROUP BY."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.select(*[(F.col(c) + F.lit(0.0)).alias(c) if c in floating else F.col(c) for c in columns])


def duplicate_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows and copies after the first. Rows travel as 32-byte digests, counted before the shuffle."""
    columns = list(columns or df.columns)
    groups = _comparable(df, columns).groupBy(F.unhex(row_digest(columns, nested_columns(df))).alias("row")).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    ).withColumn(
        "duplicate_percent",
        F.when(F.col("rows") > 0, F.col("duplicates") * F.lit(100.0) / F.col("rows")),
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def dataset_info(df: DataFrame, custom: bool = False) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(",".join(df.columns)).alias("columns"),
        F.lit(custom).alias("custom"),
    )


def group_shares(df: DataFrame, group: str, category: str) -> DataFrame:
    """Rows per (group, category) and their percent of the group, one scan.

    NULL categories are not listed, but their rows count as the group's.
    """
    counts = df.groupBy(group, category).agg(F.count(F.lit(1)).alias("count"))
    sizes = counts.groupBy(group).agg(F.sum("count").alias("group_rows"))
    return counts.filter(F.col(category).isNotNull()).join(sizes, group).withColumn(
        "percent", F.col("count") * F.lit(100.0) / F.col("group_rows")
    )


def group_sizes(df: DataFrame, group: str) -> DataFrame:
    """Rows per group and percent of all rows."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("count"))
    total = sizes.agg(F.sum("count")).first()[0]
    return sizes.withColumn("percent", F.col("count") * F.lit(100.0) / F.lit(total))


def group_centroids(df: DataFrame, group: str, columns: Sequence[str] | Sequence[Column]) -> DataFrame:
    return df.groupBy(group).agg(*[F.avg(c).alias(c) for c in columns])
