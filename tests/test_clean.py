import math

import pytest
from pyspark.sql import functions as F

from cadenza.constants import DROPPED_GENRES, GENRE_MAP
from cadenza.functions import names
from cadenza.functions import scalar as s
from cadenza.operators import clean, features, profile


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_fixed_tables():
    assert len(GENRE_MAP) == 67 and len(set(GENRE_MAP.values())) == 9
    assert len(DROPPED_GENRES) == 15 and not set(DROPPED_GENRES) & set(GENRE_MAP)


@pytest.fixture
def tracks(spark):
    return spark.createDataFrame(
        [(.5, .6, -10, 200000, 120, .5), (.7, .8, -5, 180000, 130, .8), (.9, .4, -15, 220000, 110, .3)],
        "danceability double, energy double, loudness int, duration_ms int, tempo int, valence double")


def test_catalogue_features_are_added_and_inputs_kept(tracks):
    out = features.catalogue_features(tracks)
    assert out.columns[:6] == tracks.columns and len(out.columns) == 10
    first = out.orderBy("danceability").first()
    assert first["Dance_Energy_Interaction"] == pytest.approx(.3)
    assert first["Loudness_Duration_Ratio"] == pytest.approx(-10 / 200)
    assert first["Tempo_vs_120"] == 0 and first["Valence_Energy_Ratio"] == pytest.approx(.5 / .600001)


def test_zero_energy_and_zero_duration_stay_finite(spark):
    df = spark.createDataFrame([(.5, 0.0, -10.0, 0, 120, .5)],
                               "danceability double, energy double, loudness double, duration_ms int, tempo int, valence double")
    row = features.catalogue_features(df).first()
    assert math.isfinite(row["Valence_Energy_Ratio"])
    assert row["Loudness_Duration_Ratio"] is None  # the median of no values fills nothing


def test_zero_duration_takes_the_median(spark):
    df = spark.createDataFrame([(.5, .1, -10.0, 0, 120, .5), (.5, .1, -10.0, 1000, 120, .5), (.5, .1, -20.0, 1000, 120, .5)],
                               "danceability double, energy double, loudness double, duration_ms int, tempo int, valence double")
    values = sorted(r["Loudness_Duration_Ratio"] for r in features.catalogue_features(df).collect())
    assert values == [-20.0, -15.0, -10.0]


def test_missing_names_are_dropped(spark):
    df = spark.createDataFrame([("a", "t", .1), (None, "u", .2), ("c", None, .3)], "artist_name string, track_name string, energy double")
    assert rows(clean.handle_missing(df)) == [("a", "t", .1)]
    with pytest.raises(ValueError):
        clean.drop_missing(df, ["absent"])


@pytest.mark.parametrize("case", [str.title, str.lower])
def test_means_and_modes_fill_either_spelling(spark, case):
    columns = [case("danceability"), case("energy"), case("key")]
    df = spark.createDataFrame(
        [("a", "t", .5, .6, 1), ("b", "u", None, .7, 1), ("c", "v", .7, None, 2), ("d", "w", .6, .65, 2), ("e", "x", .6, .65, None)],
        f"artist_name string, track_name string, {columns[0]} double, {columns[1]} double, {columns[2]} int")
    out = {r[0]: r for r in clean.handle_missing(df).collect()}
    assert out["b"][2] == pytest.approx(.6) and out["c"][3] == pytest.approx(.65)
    assert out["e"][4] == 1  # tie: the smallest


def test_fraction_fills_whole_number_column(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert sorted(r[0] for r in clean.fill_missing(df, mean=["x"]).collect()) == [1.0, 1.5, 2.0]


def test_genres(spark):
    df = spark.createDataFrame([("pop",), ("gospel",), (None,), ("zydeco",), ("ska",)], "genre string")
    assert sorted(rows(clean.map_genres(df))) == [("DANCE",), ("POP",), ("UNKNOWN_GENRE",), ("zydeco",)]


@pytest.mark.parametrize("text, want", [
    ("-710", -7.1), ("5", 0.0), ("abc", -12.0), (None, 0.0), ("nan", 0.0), ("-59.5", -59.5), ("-9000", -60.0),
    ("1.5f", -12.0), ("inf", 0.0), ("", -12.0)])
def test_loudness(spark, text, want):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(s.normalize_loudness(F.col("x"))).first()[0] == pytest.approx(want)


@pytest.mark.parametrize("text, want", [("1e-3", .001), (" 7 ", 7.0), ("x", None), ("2.5d", None), ("nan", None), (None, None)])
def test_numbers_from_text(spark, text, want):
    assert spark.createDataFrame([(text,)], "x string").select(s.to_number(F.col("x"))).first()[0] == want


def test_fill_rules_for_empty_columns(spark):
    df = spark.createDataFrame([("x", None), ("4", None), ("6", None)], "a string, b double")
    assert sorted(rows(clean.coerce_and_fill(df, ["a", "b"]))) == [(4.0, 0.0), (5.0, 0.0), (6.0, 0.0)]
    assert clean.coerce_and_fill(df, ["b"], empty=None).filter("b IS NULL").count() == 3


def test_first_row_wins(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "id string, n int, v string")
    assert sorted(rows(clean.first_per_key(df, ["id"], ["n"]))) == [("a", 1, "y"), ("b", 3, "z")]


def test_serving_features(spark):
    df = spark.createDataFrame([(None, .2), (.5, 0.0)], "danceability double, energy double")
    with pytest.raises(ValueError):
        features.assemble_features(df, ["tempo"])
    out = features.assemble_features(df, ["danceability", "Dance_Energy_Interaction", "tempo"], "lenient")
    assert [r["Dance_Energy_Interaction"] for r in out.collect()] == [0.0, 0.0]
    assert {r["tempo"] for r in out.collect()} == {0.0}
    assert features.model_features(df, fill="zero").first()["Dance_Energy_Interaction"] == 0.0


def test_scaling_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    assert sorted(rows(features.standard_scale(df, ["x", "k"]))) == [(-1.0, 0.0), (1.0, 0.0)]


def test_column_rules(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "`Unnamed: 0` int, ` Title ` int, `Song URL` int, energy int")
    cleaned = names.rename_aliases(names.clean_names(names.drop_index_column(df)))
    assert cleaned.columns == ["track_name", "song_url", "energy"]
    assert names.upload_name("# of Plays (Ind)") == "num_of_plays_ind"
    assert names.borrow_id_column(spark.createDataFrame([(1, 2)], "a int, my_track int")) == "my_track"
    wide = spark.createDataFrame([(1.0,) * 4], "danceability double, energy double, Dance_Energy_Interaction double, Acoustic_Instrumental_Interaction double")
    assert names.feature_columns(wide)[:2] == ["danceability", "energy"]
    assert names.leak_free_features(wide, "energy", features.MODEL_PARENTS) == ["danceability", "Acoustic_Instrumental_Interaction"]


def test_reduction_keeps_listed_columns(spark):
    from cadenza.constants import REDUCED_FEATURES, REDUCED_METADATA
    df = spark.createDataFrame([(2000, 1, .1, "a", "t", "pop", 9)],
                               "year int, duration_ms int, energy double, artist_name string, track_name string, genre string, other int")
    kept = names.keep_columns(df, REDUCED_METADATA, REDUCED_FEATURES).columns
    assert kept == ["artist_name", "track_name", "genre", "year", "duration_ms", "energy"]


def test_importance_selection(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, a int, b int")
    assert features.select_by_importance(df, {"a": .1, "b": .6, "c": .3}, ["id"], .1).columns == ["id", "b", "a"]


def test_top_classes_and_map(spark):
    df = spark.createDataFrame([([.2, .5, .2, .1],)], "p array<double>")
    names_ = ["d", "c", "b", "a"]
    top = df.select(s.top_classes(names_, F.col("p")).alias("t"), s.score_map(names_, F.col("p")).alias("m")).first()
    assert [(x["name"], x["score"]) for x in top["t"]] == [("c", .5), ("b", .2), ("d", .2)]
    assert top["m"] == {"d": .2, "c": .5, "b": .2, "a": .1}


def test_duplicates_see_nulls_and_signed_zero(spark):
    df = spark.createDataFrame([("a", None, 0.0), ("a", None, -0.0), ("a", "", 0.0), ("a,", "n", 0.0), ("a", ",n", 0.0)],
                               "x string, y string, z double")
    assert profile.duplicate_report(df).first()["duplicates"] == 1


def test_empty_table_statistics(spark):
    df = spark.createDataFrame([], "x double, y string")
    assert profile.target_stats(df, "x").first()["median"] is None
    assert profile.missing_profile(df).first()["missing_percent"] is None
    assert profile.outlier_report(df, ["x"]).count() == 0
    assert profile.duplicate_report(df).first()["rows"] == 0
