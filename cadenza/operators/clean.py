"""Row filters, category mapping, filling of missing values, deduplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.constants import (
    DROPPED_GENRES, GENRE_MAP, MEAN_FILL_COLUMNS, MODE_FILL_COLUMNS, UNKNOWN_GENRE,
)
from cadenza.functions.names import numeric_columns
from cadenza.functions.scalar import finite, label_missing, to_number
from cadenza.operators.profile import typed_modes, value_counts
from cadenza.operators.quantiles import approximate_medians, exact_medians
from cadenza.session import BROADCAST_ROWS, small_side


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL or NaN in any of the columns. An absent column is an error."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {absent}")
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    for c in columns:  # plain predicates, which the scan can use
        df = df.filter(F.col(c).isNotNull() & ~F.isnan(c) if c in floating else F.col(c).isNotNull())
    return df


def exclude_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Drop rows whose value is listed; NULLs stay."""
    return df.filter(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)))


def map_values(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace values found in ``mapping``, keep the others."""
    table = df.sparkSession.createDataFrame(list(mapping.items()), "_from string, _to string")
    if len(mapping) <= BROADCAST_ROWS:
        table = F.broadcast(table)
    mapped = df.join(table, F.col(column) == F.col("_from"), "left")
    return mapped.withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")


def map_genres(df: DataFrame, column: str = "genre", dropped: Sequence[str] = DROPPED_GENRES,
               mapping: Mapping[str, str] = GENRE_MAP, label: str = UNKNOWN_GENRE) -> DataFrame:
    """Drop excluded genres, map the rest to categories, label the missing."""
    kept = map_values(exclude_values(df, column, dropped), column, mapping)
    return kept.withColumn(column, label_missing(F.col(column), label))


def genre_counts(df: DataFrame, column: str = "genre") -> DataFrame:
    return value_counts(df, column).select(F.col(column).alias("Category"), F.col("count").alias("Count"))


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN and infinities become NULL in the float and double columns."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    chosen = [c for c in floating if columns is None or c in columns]
    return df.withColumns({c: finite(F.col(c)) for c in chosen})


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill NULLs with fixed values; a ``None`` value leaves its column as it is.

    A whole-number column filled with a float becomes double whatever the value is, so that the result's type
    depends on the types alone; filled with a whole number it keeps its type.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    filled = {}
    for c, v in values.items():
        if v is None:
            continue
        keep = isinstance(v, str) or isinstance(types[c], (T.FloatType, T.DoubleType))
        whole = not keep and isinstance(types[c], T.IntegralType) and isinstance(v, int)
        base = F.col(c) if keep or whole else F.col(c).cast("double")
        literal = F.lit(int(v) if whole else v)
        filled[c] = F.coalesce(base, literal.cast(types[c]) if keep or whole else literal)
    return df.withColumns(filled)


def mode_values(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """One row per column reaches the driver."""
    if not columns:
        return {}
    found = {r["column"]: next((r[k] for k in ("mode_whole", "mode_number", "mode_text") if r[k] is not None), None)
             for r in typed_modes(df, columns).collect()}
    return {c: found.get(c) for c in columns}


def median_values(df: DataFrame, columns: Sequence[str], exact: bool = True,
                  rows: int | None = None) -> dict[str, float | None]:
    return exact_medians(df, columns, rows=rows) if exact else approximate_medians(df, columns)


def gap_columns(df: DataFrame, columns: Sequence[str], mean: Sequence[str] = ()) -> tuple[int, list[str], dict]:
    """Row count, the columns that have NULLs, and the means of some: one scan."""
    if not columns:
        return 0, [], {}
    row = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(columns)],
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(mean)],
    ).first()
    gaps = [c for i, c in enumerate(columns) if row[f"c{i}"] < row["n"]]
    return row["n"], gaps, {c: row[f"m{i}"] for i, c in enumerate(mean)}


def fill_missing(df: DataFrame, mean: Sequence[str] = (), mode: Sequence[str] = (),
                 median: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """Fill each group of columns with its own statistic, computed over ``df`` for the columns that need it."""
    df = nan_to_null(df, [*mean, *mode, *median])
    whole = [f.name for f in df.schema.fields if f.name in (*mean, *median) and isinstance(f.dataType, T.IntegralType)]
    df = df.withColumns({c: F.col(c).cast("double") for c in whole})  # with gaps or without: one type
    rows, gaps, means = gap_columns(df, [*mean, *mode, *median], mean)
    values = {c: m for c, m in means.items() if c in gaps}
    values |= mode_values(df, [c for c in mode if c in gaps])
    values |= median_values(df, [c for c in median if c in gaps], exact, rows)
    return fill(df, values)


def handle_missing(df: DataFrame, text: Sequence[str] = ("artist_name", "track_name"),
                   mean: Sequence[str] = MEAN_FILL_COLUMNS, mode: Sequence[str] = MODE_FILL_COLUMNS) -> DataFrame:
    """Drop rows without names, then fill numeric columns by mean and coded columns by mode."""
    kept = drop_missing(df, text)
    present = {c.lower(): c for c in kept.columns}
    return fill_missing(
        kept,
        mean=[present[c.lower()] for c in mean if c.lower() in present],
        mode=[present[c.lower()] for c in mode if c.lower() in present],
    )


def coerce_and_fill(df: DataFrame, columns: Sequence[str], empty: float | None = 0.0,
                    exact: bool = True) -> DataFrame:
    """Text to numbers, gaps to the column median; ``empty`` where a column has no numbers at all."""
    present = [c for c in columns if c in df.columns]
    numbers = df.withColumns({c: to_number(F.col(c)) for c in present})
    rows, gaps, _ = gap_columns(numbers, present)
    medians = median_values(numbers, gaps, exact, rows)
    return fill(numbers, {c: empty if m is None else m for c, m in medians.items()})


def fill_numeric_medians(df: DataFrame, exact: bool = True) -> DataFrame:
    return fill_missing(df, median=numeric_columns(df), exact=exact)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep each key's first row in ``order``, which must be total.

    Spark cuts every task's rows to one per key before the shuffle, so a frequent key does not
    gather in one place.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def lookup(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose key is among the requested ids. Few ids are broadcast, so the table is not shuffled."""
    return df.join(small_side(ids.select(key).distinct()), key, "left_semi")


def not_found(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Requested ids that the table does not have. The table is cut to the ids first."""
    wanted = ids.select(key).distinct()
    return wanted.join(lookup(df.select(key), key, ids), key, "left_anti")


def top_rows(df: DataFrame, order: Sequence[Column | str], limit: int, where: Column | None = None) -> DataFrame:
    """First rows of a total order, optionally of a filtered table."""
    if where is not None:
        df = df.filter(where)
    return df.orderBy(*order).limit(limit)
