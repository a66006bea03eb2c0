"""Column-name rules and column selection. Pure plan-time work: no job runs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cadenza.constants import COLUMN_ALIASES, CORE_FEATURES, MODEL_FEATURES

INDEX_COLUMNS = ("Unnamed: 0", "_c0")


def drop_index_column(df: DataFrame) -> DataFrame:
    """Drop the row-index column a CSV export leaves behind."""
    return df.drop(*INDEX_COLUMNS)


def clean_names(df: DataFrame) -> DataFrame:
    """Strip and lower-case all column names."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def upload_name(name: str) -> str:
    name = name.lower().replace(" ", "_").replace(".", "")
    return name.replace("#_of", "num_of").replace("(ind)", "ind")


def clean_upload_names(df: DataFrame) -> DataFrame:
    """Name rules for uploaded files: snake case, no dots, spelled-out counts."""
    return df.toDF(*[upload_name(c) for c in df.columns])


def rename_aliases(df: DataFrame, aliases: Mapping[str, str] = COLUMN_ALIASES) -> DataFrame:
    """Rename known aliases; an alias whose target already exists is left alone."""
    present = set(df.columns)
    renames = {old: new for old, new in aliases.items() if old in present and new not in present}
    return df.withColumnsRenamed(renames)


def keep_columns(df: DataFrame, metadata: Iterable[str], features: Iterable[str]) -> DataFrame:
    """Keep the listed columns that exist, metadata first."""
    wanted = [c for c in [*metadata, *features] if c in df.columns]
    return df.select(*wanted)


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def feature_columns(df: DataFrame, core=CORE_FEATURES, engineered=MODEL_FEATURES, exclude=()) -> list[str]:
    """Core features present in the table, then engineered ones, without the excluded."""
    return [c for c in [*core, *engineered] if c in df.columns and c not in exclude]


def leak_free_features(df: DataFrame, target: str, derived_from: Mapping[str, Iterable[str]],
                       core=CORE_FEATURES, engineered=MODEL_FEATURES) -> list[str]:
    """Feature list for predicting ``target``: without it and everything computed from it."""
    leaks = {target, *[f for f, parents in derived_from.items() if target in parents]}
    return feature_columns(df, core, engineered, exclude=leaks)


def columns_except(df: DataFrame, metadata: Iterable[str], id_prefix: str | None = "id") -> list[str]:
    """All columns that are neither metadata nor named like an id."""
    skip = set(metadata)
    return [c for c in df.columns if c not in skip and not (id_prefix and c.startswith(id_prefix))]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def borrow_id_column(df: DataFrame) -> str | None:
    """First column whose name mentions an id or a track."""
    for c in df.columns:
        if "id" in c.lower() or "track" in c.lower():
            return c
    return None
