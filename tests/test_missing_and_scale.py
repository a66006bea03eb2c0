"""Missing values beyond NULL, and results that must not depend on size or type switches."""

import math

import pytest
from pyspark.sql import functions as F

from cadenza.operators import clean, metrics, profile, quantiles, recommend, similar
from cadenza.plans import jobs
from cadenza.sources import delimited, metrics_store, tables
from cadenza.streaming import interactions

NAN = float("nan")


def test_tokens_are_missing_at_ingest(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,n,x,t\nNA,1,1.5,a\nb,null,NaN,N/A\nnan,3,2,None\n")
    df = delimited.read_csv(spark, str(tmp_path / "a.csv"), infer=True)
    assert dict(df.dtypes) == {"name": "string", "n": "int", "x": "double", "t": "string"}
    assert sorted(map(tuple, df.collect()), key=str) == sorted([(None, 1, 1.5, "a"), ("b", None, None, None), (None, 3, 2.0, None)], key=str)
    typed = delimited.read_csv(spark, str(tmp_path / "a.csv"), schema="name string, n int, x double, t string")
    assert typed.filter("x is null").count() == 1 and typed.filter("name is null").count() == 2


def test_nan_is_missing_everywhere(spark):
    df = spark.createDataFrame([("a", "t", 1.0, 1), ("b", "t", NAN, 2), ("c", "t", 3.0, None)],
                               "artist_name string, track_name string, danceability double, key int")
    counted = {r["column"]: r["missing"] for r in profile.missing_profile(df).collect()}
    assert counted["danceability"] == 1 and counted["key"] == 1
    filled = clean.handle_missing(df)
    assert sorted(r["danceability"] for r in filled.collect()) == [1.0, 2.0, 3.0]
    assert {r["column"]: r["mode_number"] for r in profile.modes(df, ["danceability"]).collect()} == {"danceability": 1.0}


@pytest.mark.parametrize("small", [100_000, 1])
def test_quantiles_ignore_nan_on_both_sides_of_the_bound(spark, small):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(NAN,), (None,)], "x double")
    assert quantiles.exact_quantiles(df, ["x"], [0.25, 0.5, 1.0], small=small)["x"] == [25.0, 50.0, 100.0]


@pytest.mark.parametrize("strategy", ["catalogue", "queries", "cells"])
def test_neighbours_ignore_vectors_with_nan(spark, strategy):
    rows = [(i, [float(i), 1.0]) for i in range(8)] + [(8, [NAN, 1.0]), (9, [None, 1.0])]
    df = spark.createDataFrame(rows, "track_id long, vector array<double>")
    got = similar.nearest(df, df, 3, strategy=strategy).collect()
    assert len(got) == 8 * 3 and all(not math.isnan(r["similarity"]) for r in got)


def test_type_after_filling_follows_the_column_alone(spark):
    full = spark.createDataFrame([(1, 2), (3, 2)], "a int, b long")
    gaps = spark.createDataFrame([(1, 2), (None, None)], "a int, b long")
    for df in (full, gaps):
        assert dict(clean.fill_missing(df, mean=["a"], mode=["b"]).dtypes) == {"a": "double", "b": "bigint"}


def test_mode_of_large_longs_is_kept(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(big,), (big,), (1,), (None,)], "a long")
    assert clean.fill_missing(df, mode=["a"]).filter(F.col("a") == big).count() == 3


def test_r2_uses_the_rows_that_have_both(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (100.0, None)], "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert row["mse"] == 0.125 and row["r2_score"] == pytest.approx(0.5)


def test_nested_rows_are_told_apart(spark):
    df = spark.createDataFrame([(["a, b"],), (["a", "b"],), (None,), (["a", "b"],)], "x array<string>")
    assert profile.duplicate_report(df).first()["duplicates"] == 1


def test_upsert_keeps_rows_without_key_and_versions_switch(spark, tmp_path):
    stored = spark.createDataFrame([(1, "k1", "old")], "id long, k string, v string")
    incoming = spark.createDataFrame([("k1", "new", 1), ("k1", "newer", 2), (None, "x", 1), (None, "y", 2)],
                                     "k string, v string, n int")
    merged = tables.upsert(stored, incoming, "k", ["v"], [F.desc("n")])
    assert sorted(r["v"] for r in merged.collect()) == ["newer", "x", "y"]
    path = str(tmp_path / "t")
    stored.write.parquet(f"{path}/version=1")
    target = tables.replace_by_upsert(spark, path, incoming, "k", ["v"], [F.desc("n")])
    assert tables.current_version(spark, path).endswith("version=2") and target.endswith("version=2")
    ids = [r["id"] for r in spark.read.parquet(target).collect()]
    assert 1 in ids and len(set(ids)) == 3 and min(ids) == 1


def test_no_metrics_yet(spark, tmp_path):
    rows = metrics_store.read_metrics(spark, str(tmp_path / "absent")).collect()
    assert len(rows) == 5 and all(r["note"] and r["value"] is None for r in rows)


def test_search_names_and_regex_classes(spark):
    df = spark.createDataFrame([("1", "Ab1", "x"), ("2", "zz", "ÄB")], "track_id string, title string, artists string")
    assert [r["track_id"] for r in jobs.search(df, "ab").collect()] == ["1"]
    assert [r["track_id"] for r in jobs.search(df, r"^\D\D$").collect()] == ["2"]
    assert [r["track_id"] for r in jobs.search(df, "äb").collect()] == ["2"]


def test_default_order_prefers_filled_rows(spark):
    raw = spark.createDataFrame([("a", None, "0.5"), ("a", "title", "0.5")], "track_id string, title string, energy string")
    assert delimited.clean_upload(raw).first()["track_name" if "track_name" in delimited.clean_upload(raw).columns else "title"] == "title"


def test_events_without_time_do_not_stop_the_stream(spark, tmp_path):
    rows = [("u", "t1", "click", "2024-01-01 00:00:00", 1), ("u", "t2", "click", None, 2), ("u", "t3", "click", "2024-01-02 00:00:00", None)]
    df = spark.createDataFrame(rows, "user_id string, track_id string, action string, ts string, event_id long")
    df.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("user_id string, track_id string, action string, ts timestamp, event_id long").parquet(str(tmp_path / "in"))
    lists = interactions.latest_tracks(interactions.interactions(stream))
    interactions.write_latest(lists, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert [r["tracks"] for r in interactions.read_latest(spark, str(tmp_path / "out")).collect()] == [["t1"]]
    assert interactions.rejected(spark.read.parquet(str(tmp_path / "in"))).count() == 2


def test_no_default_caps(spark):
    df = spark.range(2500).selectExpr("id AS track_id", "array(cast(id AS double), 1D) AS vector")
    query = df.filter("track_id = 1")
    found = similar.fallback_neighbours(query, df, 2499).count()
    assert found == 2499 and similar.fallback_neighbours(query, df, 2499, sample=100).count() <= 100
    tracks = spark.range(700).selectExpr("id AS track_id", "0.9 AS energy", "0.9 AS danceability")
    assert recommend.browse_clusters(tracks, limit=650).count() == 650


def test_lookup_of_few_ids_does_not_shuffle_the_table(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = clean.lookup(spark.range(100_000).withColumnRenamed("id", "k"), "k", spark.createDataFrame([(5,)], "k long"))
        assert "SortMergeJoin" not in plan._jdf.queryExecution().executedPlan().toString()
        assert plan.count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
