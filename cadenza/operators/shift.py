"""What a look at single columns does not show: rows that two parts share, a shift of several columns together, and
segments of two features in which a model is weak."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, PolynomialExpansion, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.constants import SEED
from cadenza.functions.scalar import finite, row_digest
from cadenza.operators.profile import nested_columns
from cadenza.operators.validate import _bucket_number, _report, quantile_edges
from cadenza.session import materialise

#: Bits of the Bloom filter for each of the test part's distinct rows, and at most altogether (8 MB).
BITS_PER_ROW = 12
MOST_BITS = 1 << 26
_PROBES = 4


def _positions(digest: str, bits: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), digest), F.lit(bits)) for i in range(_PROBES)])


def bloom_words(digests: DataFrame, bits: int) -> np.ndarray:
    """The filter's words of 64 bits for a column ``digest``, or-ed per task before the shuffle."""
    at = digests.select(F.explode(_positions("digest", bits)).alias("at"))
    words = at.groupBy((F.col("at") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))).alias("set"))
    found = words.toPandas()
    out = np.zeros(-(-bits // 64), dtype=np.uint64)
    out[found["word"].to_numpy(dtype=np.int64)] = found["set"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def _may_hold(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            at = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, _PROBES)
            bit = (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["digest"]).filter(pa.array(bit.all(axis=1)))

    return run


def shared_rows(train: DataFrame, test: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows that both parts have, with how often: the ``columns`` (by default all that both have),
    ``train_rows``, ``test_rows``. NULLs are equal to each other.

    Rows travel as digests, counted before they are shuffled, so a row that makes up much of a part does not gather. A
    Bloom filter of the test part, of bounded size, keeps most of the training part out of the join.
    """
    names = list(columns or [c for c in train.columns if c in test.columns])
    spark = train.sparkSession
    nested = nested_columns(test.select(*[F.col(f"`{c}`") for c in names]))
    digest = row_digest(names, nested)
    mine = materialise(test.withColumn("digest", digest).groupBy("digest").agg(
        F.count("*").alias("test_rows"), *[F.any_value(f"`{c}`").alias(c) for c in names]), "shared-test")
    bits = int(min(MOST_BITS, max(1024, BITS_PER_ROW * mine.count())))
    shared = spark.sparkContext.broadcast(bloom_words(mine.select("digest"), bits))
    seen = train.select(digest.alias("digest")).select("digest", _positions("digest", bits).alias("at"))
    counted = seen.mapInArrow(_may_hold(shared), "digest string").groupBy("digest").agg(F.count("*").alias("train_rows"))
    return mine.join(counted, "digest").select(*[F.col(f"`{c}`") for c in names], "train_rows", "test_rows")


def leakage_report(train: DataFrame, test: DataFrame, columns: Sequence[str] | None = None,
                   max_share: float = 0.0) -> DataFrame:
    """A check row: the share of the test part's rows that the training part has too."""
    total = test.count()
    found = shared_rows(train, test, columns).agg((F.coalesce(F.sum("test_rows"), F.lit(0)) / max(1, total)).alias("share"))
    return _report(found, "shared_rows", F.lit(None).cast("string"), F.col("share"), max_share, "error",
                   F.col("share") <= max_share)


def auc(df: DataFrame, score: str, label: str, buckets: int = 256) -> DataFrame:
    """``auc``, ``positives``, ``negatives``: the chance that a row of label 1 scores above one of label 0, ties half.

    Exact, from rank sums: equal scores are counted first, score ranges get the counts of all lower ranges, and ranks are
    counted within a range. NULL scores and labels take no part; ``auc`` is NULL if a class has no rows.
    """
    told = df.filter(F.col(score).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(score).alias("score")).agg(
        F.sum(label).cast("long").alias("pos"), F.sum(1 - F.col(label)).cast("long").alias("neg"))
    told = materialise(told, "auc")
    numbers = told.select(F.col("score").cast("double").alias("score"), "pos", "neg")
    edges = sorted(set(numbers.approxQuantile("score", [i / buckets for i in range(1, buckets)], 0.5 / buckets)))
    number = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < F.col("score"))) if edges else F.lit(0)
    placed = numbers.withColumn("bucket", number.cast("int"))
    totals = sorted(placed.groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect())
    lower, below = 0, []
    for r in totals:  # at most ``buckets`` rows
        below.append((r["bucket"], lower))
        lower += r["neg"]
    positives, negatives = sum(r["pos"] for r in totals), lower
    offsets = F.broadcast(df.sparkSession.createDataFrame(below, "bucket int, lower long"))
    upto = Window.partitionBy("bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.join(offsets, "bucket").withColumn(
        "under", F.col("lower") + F.coalesce(F.sum("neg").over(upto), F.lit(0)))
    won = F.sum((F.col("pos") * (F.col("under") + F.col("neg") / 2)).cast("double"))
    return ranked.agg((won / F.nullif(F.lit(float(positives) * negatives), F.lit(0.0))).alias("auc")).select(
        "auc", F.lit(positives).cast("long").alias("positives"), F.lit(negatives).cast("long").alias("negatives"))


def domain_auc(reference: DataFrame, current: DataFrame, features: Sequence[str], key: str, seed: int = SEED) -> DataFrame:
    """How well a classifier tells ``current`` rows from ``reference`` rows, as the AUC on rows it was not trained on: near
    0.5 without a shift. Products of two features enter, so a change in how columns go together shows, too.

    Half of the rows, by hash of ``key``, train a logistic regression; gaps take the mean.
    """
    columns = [finite(F.col(f"`{c}`").cast("double")).alias(f"f{i}") for i, c in enumerate(features)]
    part = lambda df, label: df.select(F.lit(label).alias("label"), F.xxhash64(F.lit(seed), f"`{key}`").alias("hash"), *columns)
    rows = materialise(part(reference, 0.0).unionByName(part(current, 1.0)), "domain")
    present = [f"f{i}" for i, n in enumerate(rows.agg(*[F.count(f"f{i}") for i in range(len(features))]).first()) if n]
    if not present:
        return auc(rows.withColumn("score", F.lit(0.5)), "score", "label")
    filled = [f"{f}_filled" for f in present]
    model = Pipeline(stages=[
        Imputer(inputCols=present, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="plain"),
        StandardScaler(inputCol="plain", outputCol="scaled", withMean=True),
        PolynomialExpansion(degree=2, inputCol="scaled", outputCol="products"),
        LogisticRegression(featuresCol="products", labelCol="label", regParam=1e-3, maxIter=50),
    ]).fit(rows.filter(F.pmod("hash", F.lit(2)) == 0))
    judged = model.transform(rows.filter(F.pmod("hash", F.lit(2)) == 1))
    return auc(judged.select("label", vector_to_array("probability")[1].alias("score")), "score", "label")


def domain_report(reference: DataFrame, current: DataFrame, features: Sequence[str], key: str, max_auc: float = 0.65) -> DataFrame:
    """A check row: a shift of several columns together is reported and never blocks."""
    found = domain_auc(reference, current, features, key)
    return _report(found, "domain_auc", F.lit(None).cast("string"), F.col("auc"), max_auc, "warning", F.col("auc") <= max_auc)


def weak_pairs(df: DataFrame, features: Sequence[str], label: str, prediction: str, buckets: int = 4,
               min_rows: int = 100, min_excess: float = 0.1) -> DataFrame:
    """Segments of two features whose error rate exceeds that of either feature's own segment by ``min_excess``.

    ``feature_a``, ``bucket_a``, ``feature_b``, ``bucket_b``, ``rows``, ``error_rate``, ``excess``. Buckets are between exact
    quantiles of each feature. One scan counts all single segments and pairs; a pair needs ``min_rows``, and so must both
    of its parents, which are looked up in the counts. NULL values are in no segment.
    """
    edges = quantile_edges(df, features, buckets)
    wrong = F.when(F.col(label) == F.col(prediction), 0).otherwise(1)
    placed = df.select(wrong.alias("wrong"), *[
        F.when(F.col(f"`{c}`").isNotNull(), _bucket_number(c, edges[c])).alias(f"b{i}") for i, c in enumerate(features)])
    n = len(features)
    cells = F.array(*[F.struct(F.lit(i).alias("a"), F.col(f"b{i}").alias("bucket_a"), F.lit(j).alias("b"),
                               F.col(f"b{j}").alias("bucket_b")) for i in range(n) for j in range(i, n)])
    counts = placed.select("wrong", F.explode(cells).alias("c")).filter(
        "c.bucket_a IS NOT NULL AND c.bucket_b IS NOT NULL").groupBy("c").agg(
        F.count("*").alias("rows"), F.sum("wrong").alias("errors")).filter(F.col("rows") >= min_rows).select("c.*", "rows", "errors")
    counts = materialise(counts, "weak-pairs")  # at most (features * buckets) squared rows
    single = counts.filter("a = b").select("a", "bucket_a", (F.col("errors") / F.col("rows")).alias("rate"))
    pairs = counts.filter("a < b").withColumn("error_rate", F.col("errors") / F.col("rows"))
    named = F.array(*[F.lit(c) for c in features])
    return pairs.join(F.broadcast(single.withColumnRenamed("rate", "rate_a")), ["a", "bucket_a"]).join(
        F.broadcast(single.toDF("b", "bucket_b", "rate_b")), ["b", "bucket_b"]).withColumn(
        "excess", F.col("error_rate") - F.greatest("rate_a", "rate_b")).filter(F.col("excess") >= min_excess).select(
        F.get(named, F.col("a")).alias("feature_a"), "bucket_a", F.get(named, F.col("b")).alias("feature_b"), "bucket_b",
        "rows", "error_rate", "excess")
