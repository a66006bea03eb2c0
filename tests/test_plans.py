"""Plans that must hold at scale: no pair joins, early cuts for hot keys, pushed filters, no global windows."""

import contextlib
import io
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cadenza.operators import clean, recommend, sampling, similar

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


LAZY = [
    "genre_map_and_count", "dedupe_keep_first", "last_ten_per_user", "clean_serving_table", "full_validation",
    "classification_scores", "neighbours_of_all", "similar_with_fallback", "upsert_last_wins", "recommend_for_users",
    "stratified_split", "duplicate_rows", "feature_drift", "browse_rule_clusters",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_pairs_and_no_row_udfs(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in text


def test_hot_keys_are_cut_before_the_shuffle(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    first = plan(clean.first_per_key(events, ["user_id"], ["ts", "event_id"]))
    latest = plan(recommend.last_interactions(events, 50, item="event_id", action=None))
    for text in (first, latest):
        assert text.count("WindowGroupLimit (") >= 2  # before and after the exchange


def test_splits_do_not_shuffle_the_table(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").select("o_orderkey", "o_orderpriority")
    assert "Exchange" not in plan(sampling.split_random(orders, "o_orderkey"))
    stratified = plan(sampling.split_stratified(orders, "o_orderkey", "o_orderpriority"))
    assert stratified.count("BroadcastExchange") and "Exchange hashpartitioning" not in stratified


def test_few_queries_do_not_shuffle_the_catalogue(spark):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet").withColumnRenamed("vec_id", "track_id")
    text = plan(similar.nearest(vectors, vectors, 5, vector="embedding"))
    assert "Exchange" not in text and "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in text


def test_filters_and_columns_reach_the_scan(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = plan(clean.drop_missing(lines.select("l_tax", "l_quantity").filter(F.col("l_quantity") > 40), ["l_tax"]))
    assert "GreaterThan(l_quantity,40.0)" in text and "IsNotNull(l_tax)" in text
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in text
