"""Derived features, scaling and feature selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.constants import CATALOGUE_FEATURES, MODEL_FEATURES
from cadenza.functions.names import keep_columns
from cadenza.functions.scalar import (
    distance_from, finite, finite_or_zero, per_second, product, safe_ratio, to_number,
)
from cadenza.operators.clean import fill_missing, nan_to_null

# The tempo other tempos are compared with.
REFERENCE_TEMPO = 120

# Derived feature -> the columns it is computed from.
MODEL_PARENTS = {
    "Dance_Energy_Interaction": ("danceability", "energy"),
    "Valence_Energy_Ratio": ("valence", "energy"),
    "Acoustic_Instrumental_Interaction": ("acousticness", "instrumentalness"),
    "Speechiness_Energy_Ratio": ("speechiness", "energy"),
}


def _model_expression(name: str):
    a, b = MODEL_PARENTS[name]
    return safe_ratio(a, b) if name.endswith("_Ratio") else product(a, b)


def catalogue_features(df: DataFrame, exact: bool = True) -> DataFrame:
    """Four derived columns of the catalogue; infinities become NULL, gaps the column's median."""
    derived = {
        "Dance_Energy_Interaction": product("danceability", "energy"),
        "Loudness_Duration_Ratio": per_second("loudness", "duration_ms"),
        "Tempo_vs_120": distance_from("tempo", REFERENCE_TEMPO),
        "Valence_Energy_Ratio": safe_ratio("valence", "energy"),
    }
    wide = nan_to_null(df.withColumns(derived))
    return fill_missing(wide, median=CATALOGUE_FEATURES, exact=exact)


def model_features(df: DataFrame, fill: str | None = "median", exact: bool = True) -> DataFrame:
    """Derived model features whose parents exist.

    ``fill``: ``"median"`` as in training, ``"zero"`` as in serving, ``None`` to leave gaps.
    """
    possible = [n for n in MODEL_FEATURES if all(p in df.columns for p in MODEL_PARENTS[n])]
    wide = nan_to_null(df.withColumns({n: _model_expression(n) for n in possible}))
    if fill == "median":
        return fill_missing(wide, median=possible, exact=exact)
    if fill == "zero":
        return wide.withColumns({n: finite_or_zero(F.col(n)) for n in possible})
    return wide


def assemble_features(df: DataFrame, features: Sequence[str], policy: str = "strict") -> DataFrame:
    """Make every feature a present double column.

    ``strict`` raises for an absent one. ``lenient`` computes it if it is a derived feature with
    its parents present, else uses 0.0; text that is no number counts as absent in its row.
    """
    if policy == "strict":
        absent = [f for f in features if f not in df.columns]
        if absent:
            raise ValueError(f"missing required features: {absent}")
        return df.withColumns({f: F.col(f).cast("double") for f in features})
    columns = {}
    for f in features:
        tries = [finite(to_number(F.col(f)))] if f in df.columns else []
        if f in MODEL_PARENTS and all(p in df.columns for p in MODEL_PARENTS[f]):
            tries.append(_lenient_derived(f))
        columns[f] = F.coalesce(*tries, F.lit(0.0))
    return df.withColumns(columns)


def _lenient_derived(name: str):
    a, b = (to_number(F.col(p)) for p in MODEL_PARENTS[name])
    value = F.try_divide(a, b + F.lit(1e-6)) if name.endswith("_Ratio") else a * b
    return finite(value)


def scaling_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, one scan."""
    row = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(columns)
                   for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def standard_scale(df: DataFrame, columns: Sequence[str],
                   stats: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """``(x - mean) / deviation``; a constant column becomes 0."""
    stats = stats or scaling_stats(df, columns)
    return df.withColumns({
        c: (F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1] or 1.0) for c in columns if stats[c][0] is not None
    })


def vector_column(df: DataFrame, columns: Sequence[str], name: str = "vector") -> DataFrame:
    return df.withColumn(name, F.array(*[F.col(c).cast("double") for c in columns]))


def select_by_importance(df: DataFrame, importances: Mapping[str, float], metadata: Sequence[str],
                         minimum: float) -> DataFrame:
    """Keep metadata and the features whose importance reaches ``minimum``, most important first."""
    ranked = sorted(importances, key=lambda f: (-importances[f], f))
    return keep_columns(df, metadata, [f for f in ranked if importances[f] >= minimum])
