import hashlib
import math
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadenza.operators import sampling


def order(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{k}{seed}".encode()).hexdigest(), k))


def test_sample_is_exact_and_ignores_partitioning(spark):
    a = spark.range(0, 1000, 1, 3)
    b = spark.range(0, 1000, 1, 11)
    want = order(range(1000))[:37]
    for df in (a, b):
        assert [r["id"] for r in sampling.seeded_sample(df, "id", 37).collect()] == want
    assert sampling.seeded_sample(a, "id", 5000).count() == 1000
    for n, rows in ((37, want), (1000, order(range(1000))), (5000, order(range(1000)))):
        assert [r["id"] for r in sampling.seeded_sample(a, "id", n, large=10).collect()] == rows


def test_sample_of_repeated_keys(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("id"))  # three digests, a hundred rows each
    got = [r["id"] for r in sampling.seeded_sample(df, "id", 150, large=10).collect()]
    assert got == [k for k in order(range(3)) for _ in range(100)][:150]


def test_shuffle_numbers_every_row_once(spark):
    got = {r["id"]: r["position"] for r in sampling.shuffle(spark.range(500), "id").collect()}
    assert got == {k: i + 1 for i, k in enumerate(order(range(500)))}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(0, 200), fraction=st.sampled_from([0.0, 0.2, 0.37, 1.0]))
def test_random_split_size(spark, n, fraction):
    split = sampling.split_random(spark.range(n), "id", fraction)
    test = {r["id"] for r in split.filter("is_test").collect()}
    assert test == set(order(range(n))[:math.ceil(fraction * n)])


def test_stratified_split_with_a_hot_class_and_nulls(spark):
    df = spark.range(900).withColumn(
        "genre", F.when(F.col("id") < 600, "hot").when(F.col("id") < 640, "rare").when(F.col("id") < 895, F.lit(None)).otherwise("tiny"))
    rows = sampling.split_stratified(df, "id", "genre").collect()
    assert len(rows) == 900
    total, test = Counter(r["genre"] for r in rows), Counter(r["genre"] for r in rows if r["is_test"])
    assert test == {g: round(0.2 * n) for g, n in total.items()}
    hot = [r["id"] for r in rows if r["genre"] == "hot" and r["is_test"]]
    assert set(hot) == set(order(range(600))[:120])


def test_ids_for_rows_without_key_keep_copies(spark):
    df = spark.createDataFrame([("same", None)] * 300 + [(f"r{i}", i) for i in range(20)], "a string, b int")
    rows = sampling.sequential_ids(df, "track_id", "custom_").collect()
    assert sorted(int(r["track_id"].removeprefix("custom_")) for r in rows) == list(range(320))
    assert Counter(r["a"] for r in rows)["same"] == 300
