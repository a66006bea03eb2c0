"""Mixing sources to target weights.

Tokens are summed per source, targets and repetition rates follow from the sums, and each document is emitted
floor(rate) times plus one more copy with probability equal to the fraction, by a coin that a hash of the document
seeds. Coins need no state, so reruns, retries and other partitionings agree.

A source of few documents would miss its target by the luck of one seed. So ``SEEDS`` coins per document are summed by
source in the same scan, and each source takes the seed whose words come nearest to its target; for every one of the
seeds a document's chance is the fraction.

Defined results: NULL text has size 0. NULL is a source of its own, last in order. A source without words has target 0
and none of its documents is taken. Rows repeated in all of id, text are repeated alike. An empty table gives no rows.
Input columns other than those named pass through untouched in :func:`mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import fresh, n_words

WEIGHTS = (5, 2, 1)
CAP = 3
SEEDS = 64
COIN_SCALE = 1 << 30


def targets(sizes: dict, weights: dict, cap: float = CAP) -> dict:
    """Words to take per source: shares of the total by weight, stopped at ``cap`` times the source, the excess
    shared again by weight among the others until none is above."""
    left, open_, out = float(sum(sizes.values())), dict(weights), {}
    while open_:
        whole = sum(open_.values())
        over = [s for s, w in open_.items() if left * w / whole > cap * sizes[s]]
        if not over:
            return out | {s: left * w / whole for s, w in open_.items()}
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
            del open_[s]
    return out


def cycled_weights(sources: list, cycle: tuple = WEIGHTS) -> dict:
    """Weights in turn for the sources by code point, NULL last."""
    ordered = sorted((s for s in sources if s is not None)) + [None] * (None in sources)
    return {s: cycle[i % len(cycle)] for i, s in enumerate(ordered)}


def coin(seed: Column, *document: Column) -> Column:
    """A number from 0 to COIN_SCALE - 1 that depends on the seed and the document alone."""
    return F.pmod(F.xxhash64(seed, *document), F.lit(COIN_SCALE))


def rates(rows: DataFrame, weights=cycled_weights, cap: float = CAP) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``, ``whole`` (copies for sure), ``below`` (a coin
    under it adds one) and ``seed``. ``rows`` has ``source``, ``size`` and ``mark`` (hash of the document).

    ``weights`` maps the list of sources to their weights: a mixture is given source by source, so it is small.
    """
    spark = rows.sparkSession
    sizes = {r["source"]: int(r["n"] or 0) for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    aims = targets(sizes, weights(list(sizes)), cap)
    plan = []
    for s, n in sizes.items():
        rate = aims[s] / n if n else 0.0
        whole = min(int(rate), int(cap))
        plan.append((s, n, aims[s], whole, int(round((rate - whole) * COIN_SCALE))))
    schema = "source string, source_size long, target double, whole int, below long"
    table = spark.createDataFrame(plan, schema)
    drawn = rows.join(F.broadcast(table), rows["source"].eqNullSafe(table["source"])).groupBy(table["source"]).agg(
        *[F.sum(F.when(coin(F.lit(k), F.col("mark")) < F.col("below"), F.col("size")).otherwise(0)).alias(f"s{k}")
          for k in range(SEEDS)])
    took = {r["source"]: [int(r[f"s{k}"] or 0) for k in range(SEEDS)] for r in drawn.collect()}
    seeds = []
    for s, n, aim, whole, below in plan:
        off = [abs(whole * n + x - aim) for x in took.get(s, [0] * SEEDS)]
        seeds.append((s, n, aim, whole, below, off.index(min(off))))
    return spark.createDataFrame(seeds, schema + ", seed int")


def marked(docs: DataFrame, id: str, text: str, source: str) -> DataFrame:
    return docs.select(
        F.col(f"`{id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
        F.col(f"`{text}`").alias("text")).select(
        "doc_id", "source", n_words("text").alias("size"),
        F.xxhash64("doc_id", F.crc32(F.encode("text", "UTF-8"))).alias("mark"))


def copies() -> Column:
    return F.col("whole") + (coin(F.col("seed"), F.col("mark")) < F.col("below")).cast("int")


def mix_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
               weights=cycled_weights, cap: float = CAP, store=lambda df: df) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` words."""
    rows = store(marked(docs, id, text, source))
    plan = rates(rows, weights, cap).withColumnRenamed("source", "of")
    return rows.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", copies().alias("copies"),
        (F.col("size") * copies()).cast("long").alias("taken"))


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
        weights=cycled_weights, cap: float = CAP) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, with the input's columns."""
    size, mark, of = fresh("size"), fresh("mark"), fresh("of")
    plan = rates(marked(docs, id, text, source), weights, cap).select(
        F.col("source").alias(of), *[F.col(c).alias(of + c) for c in ("whole", "below", "seed")])
    number = F.col(of + "whole") + (coin(
        F.col(of + "seed"), F.xxhash64(F.col(f"`{id}`"), F.crc32(F.encode(F.col(f"`{text}`"), "UTF-8"))))
        < F.col(of + "below")).cast("int")
    joined = docs.join(F.broadcast(plan), F.col(f"`{source}`").cast("string").eqNullSafe(F.col(of)))
    return joined.withColumn(mark, number).filter(F.col(mark) > 0).withColumn(
        size, F.explode(F.sequence(F.lit(1), F.col(mark)))).select(*[docs[f"`{c}`"] for c in docs.columns])
