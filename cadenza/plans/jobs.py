"""Whole jobs: raw file to stored catalogue, and the pages a service reads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.constants import CORE_FEATURES, REDUCED_FEATURES, REDUCED_METADATA
from cadenza.functions.names import drop_index_column, keep_columns
from cadenza.functions.scalar import text_matches
from cadenza.operators.clean import handle_missing, lookup, map_genres
from cadenza.operators.features import catalogue_features
from cadenza.operators.models import index_rows, score_all
from cadenza.operators.recommend import named_output
from cadenza.operators.similar import fallback_neighbours, nearest, raw_vector, with_fallback
from cadenza.operators.validate import require_valid, validation_report
from cadenza.session import materialise
from cadenza.sources.delimited import infer_numbers, read_csv


# Columns searched, the first of each that the table has.
SEARCH_NAMES = [("track_name", "title"), ("artist_name", "artists")]


def build_catalogue(raw: DataFrame, metadata: Sequence[str] = REDUCED_METADATA,
                    features: Sequence[str] = REDUCED_FEATURES) -> DataFrame:
    """Clean, map genres, derive features, reduce. Fill statistics run early, over ``raw``: store it first if it is dear."""
    cleaned = handle_missing(drop_index_column(raw))
    return keep_columns(catalogue_features(map_genres(cleaned)), metadata, features)


def catalogue_job(spark: SparkSession, source: str, target: str, target_column: str = "genre") -> None:
    """CSV in, validated Parquet out. Errors in the validation report stop the job before the write.

    The file is parsed once, into a staging folder of text columns: types, fills and medians read columns of that. The
    catalogue is staged too, so the reports and the write do not compute it again.
    """
    typed = infer_numbers(materialise(read_csv(spark, source), "catalogue-text"))
    catalogue = materialise(build_catalogue(typed), "catalogue")
    require_valid(validation_report(catalogue, target_column))
    catalogue.write.mode("overwrite").parquet(target)


def search(tracks: DataFrame, query: str, limit: int = 20, key: str = "track_id",
           columns: Sequence[str] | None = None, regex: bool = True) -> DataFrame:
    """Title or artist search. A query below two characters finds nothing.

    Without ``columns`` the names used are those the table has: track or title, artist or artists.
    """
    if columns is None:
        columns = [next(c for c in names if c in tracks.columns) for names in SEARCH_NAMES
                   if any(c in tracks.columns for c in names)]
    if len(query.strip()) < 2:
        return tracks.limit(0)
    return tracks.filter(text_matches(columns, query, regex)).orderBy(key).limit(limit)


def list_tracks(tracks: DataFrame, limit: int = 20, genre: str | None = None, key: str = "track_id") -> DataFrame:
    if genre is not None:
        tracks = tracks.filter(F.col("genre") == F.lit(genre))
    return tracks.orderBy(F.desc_nulls_last("popularity"), key).limit(limit)


def similar_songs(requested: DataFrame, tracks: DataFrame, index: DataFrame, scaler: PipelineModel, limit: int = 10,
                  key: str = "track_id", raw_columns: Sequence[str] | None = None, sample: int | None = None) -> DataFrame:
    """Similar songs of each requested id: index neighbours first, then neighbours by raw features.

    ``sample`` limits the second search to so many seeded rows.
    """
    wanted = lookup(tracks, key, requested)
    available = index.join(tracks.select(key).distinct(), key, "left_semi")
    first = nearest(index_rows(wanted, scaler, [key]), available, limit, key)
    columns = list(raw_columns or [c for c in CORE_FEATURES if c in tracks.columns])
    second = fallback_neighbours(
        wanted.withColumn("vector", raw_vector(columns)), tracks.withColumn("vector", raw_vector(columns)), limit, key,
        sample=sample,
    )
    return named_output(with_fallback(first, second, limit), tracks, key)


def song_pages(requested: DataFrame, tracks: DataFrame, models: Mapping[str, PipelineModel], key: str = "track_id") -> DataFrame:
    """Requested tracks with every available prediction."""
    return score_all(lookup(tracks, key, requested), **models)
