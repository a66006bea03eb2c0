import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy_and_clean_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = T.classify(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    assert found.count() == 10_000 and found.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    told = found.filter("held_out").join(labels, "doc_id").select("toxic", "predicted").toPandas()
    hit = ((told["toxic"] == 1) & (told["predicted"] == 1)).sum()
    assert hit / (told["toxic"] == 1).sum() > 0.9
    assert ((told["toxic"] == 0) & (told["predicted"] == 1)).sum() / (told["toxic"] == 0).sum() < 0.02


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("toxic", F.when(T.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted(map(tuple, T.classify(docs, x).drop("posterior").collect())) for x in (labels, turned))
    assert [r[:2] + r[3:] for r in one] == [r[:2] + r[3:] for r in two]
    assert np.allclose([r[2] for r in one], [r[2] for r in two])


def test_label_model_learns_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    y = rng.random(6000) < 0.2
    vote = lambda sure: np.where(rng.random(6000) < sure, 2 * y, rng.integers(0, 3, 6000))
    columns = [vote(0.9), vote(0.6), vote(0.6), vote(0.05)]
    columns.append(np.where(rng.random(6000) < 0.9, columns[3], columns[1]))  # follows the useless fourth
    patterns, where, counts = np.unique(np.stack(columns, axis=1), axis=0, return_inverse=True, return_counts=True)
    known = rng.random(6000) < 0.2
    toxic, other = (np.bincount(where.ravel()[known & (y == c)], minlength=len(patterns)).astype(float) for c in (True, False))
    model = T.fit_label_model(patterns, counts.astype(float), toxic, other)
    assert model.parent[4] == 3 or model.parent[3] == 4
    belief = model.posterior(patterns)[where.ravel()]
    assert ((belief >= 0.5) == y).mean() > 0.95
    joint = np.exp(model.log_joint(np.array(np.meshgrid(*[range(3)] * 5)).reshape(5, -1).T))
    assert joint.sum() == pytest.approx(1.0)


def test_newton_against_plain_gradient(spark):
    rng = np.random.default_rng(2)
    rows = [(float(rng.random()), *[float(v) for v in rng.integers(0, 4, len(T.FEATURES))]) for _ in range(300)]
    df = spark.createDataFrame(rows, ["posterior", *T.FEATURES])
    p = np.array([r[0] for r in df.select(T.fit_classifier(df)).collect()])
    x = np.log1p(np.array([r[1:] for r in rows]))
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    beta = np.linalg.lstsq(np.hstack([np.ones((300, 1)), x]), np.log(p / (1 - p)), rcond=None)[0]
    gradient = np.hstack([np.ones((300, 1)), x]).T @ (np.array([r[0] for r in rows]) - p) / 300
    gradient[1:] -= 1e-3 * beta[1:]
    assert np.abs(gradient).max() < 1e-4


def test_voters_count_whole_words_and_beginnings(spark):
    class Shared:
        value = [" bad ", " vil"]

    import pyarrow as pa

    texts = ["Bad, BAD villain; badly evil", None, "", "a vilé bad"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, None]), pa.array(texts)], ["doc_id", "text"])
    got = next(T.search(Shared)(iter([batch]))).to_pydict()
    assert got["hits0"] == [2, 0, 0, 1] and got["hits3"] == [1, 0, 0, 1] and got["words"] == [5, 0, 0, 3]


def test_odd_rows_and_missing_labels(spark, documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 0)], "doc_id long, toxic int")
    assert T.classify(documents, labels).count() == documents.count()
    assert T.classify(no_documents, labels).count() == 0
    assert {r["score"] for r in T.classify(documents, labels.limit(0)).collect()} == {0.0}
    named = documents.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    told = labels.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    assert T.classify(named, told).count() == documents.count()
