import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import shift
from cadenza.sources import tables


def test_planted_rows_are_found_and_others_are_not(spark):
    train = spark.range(5_000).select("id", (F.col("id") % 7).alias("v"), F.array(F.lit(1).cast("long"), F.col("id")).alias("list"))
    train = train.unionByName(train.filter("id < 3")).unionByName(spark.createDataFrame([(None, None, None)], "id long, v long, list array<long>"))
    test = spark.range(4_990, 5_300).select("id", (F.col("id") % 7).alias("v"), F.array(F.lit(1).cast("long"), F.col("id")).alias("list"))
    test = test.unionByName(train.filter("id = 2")).unionByName(spark.createDataFrame([(None, None, None)], "id long, v long, list array<long>"))
    got = {r["id"]: (r["train_rows"], r["test_rows"]) for r in shift.shared_rows(train, test).collect()}
    assert got == {None: (1, 1), 2: (2, 2), **{i: (1, 1) for i in range(4_990, 5_000)}}
    assert shift.leakage_report(train, test).first()["value"] == pytest.approx(13 / 313)
    assert shift.leakage_report(train, test.limit(0)).first()["passed"]


def test_the_filter_is_bounded_and_never_loses_a_row(spark, monkeypatch):
    monkeypatch.setattr(shift, "MOST_BITS", 1024)
    both = spark.range(2_000)
    assert shift.shared_rows(both, both).count() == 2_000
    digests = both.select(F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    assert len(shift.bloom_words(digests, 1000)) == 16


@pytest.mark.parametrize("values", [3, 1_000])
def test_auc_against_all_pairs(spark, values):
    rng = np.random.default_rng(values)
    rows = [(float(rng.integers(values) + y), int(y)) for y in rng.integers(0, 2, 400)]
    df = spark.createDataFrame([*rows, (None, 1), (1.0, None)], "s double, y int").repartition(5)
    got = shift.auc(df, "s", "y", buckets=16).first()
    pos, neg = np.array([s for s, y in rows if y]), np.array([s for s, y in rows if not y])
    want = ((pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2)
    assert got["auc"] == pytest.approx(want) and (got["positives"], got["negatives"]) == (len(pos), len(neg))
    assert shift.auc(df.filter("y = 1"), "s", "y").first()["auc"] is None
    assert shift.auc(df.limit(0), "s", "y").first()["auc"] is None


def test_a_shift_of_columns_together_shows(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(3_000, 2)), rng.normal(size=(3_000, 2))
    b[:, 1] = 0.9 * b[:, 0] + np.sqrt(1 - 0.81) * b[:, 1]  # each column alone is as before
    frame = lambda x, at: spark.createDataFrame([(at + i, float(p), float(q) if i % 50 else None) for i, (p, q) in enumerate(x)], "id long, p double, q double")
    assert shift.domain_auc(frame(a, 0), frame(b, 9_000), ["p", "q"], "id").first()["auc"] > 0.75
    again = rng.normal(size=(3_000, 2))
    report = shift.domain_report(frame(a, 0), frame(again, 9_000), ["p", "q"], "id").first()
    assert 0.45 < report["value"] < 0.55 and report["passed"]


def test_a_segment_of_two_features(spark):
    df = spark.range(4_000).select(
        (F.col("id") % 100).alias("a"), ((F.col("id") / 100).cast("long") % 40).alias("b"), F.lit(0).alias("label")).withColumn(
        "prediction", F.when((F.col("a") >= 75) & (F.col("b") >= 30), 1).otherwise(0))
    found = shift.weak_pairs(df, ["a", "b"], "label", "prediction").collect()
    assert [(r["feature_a"], r["bucket_a"], r["feature_b"], r["bucket_b"], r["rows"]) for r in found] == [("a", 3, "b", 3, 250)]
    assert found[0]["error_rate"] == 1.0 and found[0]["excess"] == pytest.approx(0.75, abs=0.02)
    assert shift.weak_pairs(df, ["a", "b"], "label", "prediction", min_rows=251).count() == 0


def test_of_two_writers_one_starts_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id long, k string, v int").write.parquet(f"{path}/version=1")
    rows = lambda *x: spark.createDataFrame([(k, v, v) for k, v in x], "k string, v int, n int")
    plain, times = tables.publish, []

    def late(session, staged, target):
        times.append(target)
        if len(times) == 1:  # the other writer is first
            monkeypatch.setattr(tables, "publish", plain)
            tables.replace_by_upsert(spark, path, rows(("b", 20), ("c", 30)), "k", ["v"], [F.desc("n")])
            monkeypatch.setattr(tables, "publish", late)
        plain(session, staged, target)

    monkeypatch.setattr(tables, "publish", late)
    target = tables.replace_by_upsert(spark, path, rows(("a", 10), ("d", 40)), "k", ["v"], [F.desc("n")])
    assert [t.rsplit("/", 1)[1] for t in times] == ["version=2", "version=3"] and target.endswith("version=3")
    got = {r["k"]: r["v"] for r in spark.read.parquet(target).collect()}
    assert got == {"a": 10, "b": 20, "c": 30, "d": 40}
    assert not [p for p in (tmp_path / "table").iterdir() if p.name.startswith("_staged")]
    with pytest.raises(tables.VersionConflict):
        plain(spark, f"{path}/version=1", f"{path}/version=2")
