"""Repeatable samples, shuffles and splits.

Rows are ordered by a hash of their key and a seed. The result depends on the data alone, not on
how Spark partitioned it, and sizes are exact. The hash is uniform, so its leading hex digits cut
the rows into even buckets: ranks come from bucket counts, never from one global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.constants import SEED, TEST_FRACTION
from cadenza.functions.scalar import digest, row_digest
from cadenza.session import small_side

_BUCKET_DIGITS = 4  # 65,536 buckets
LARGE_TABLE = 10_000_000


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = SEED, large: int = LARGE_TABLE) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: the first in hash order.

    Each task keeps at most ``n`` rows and one task merges them. With the thousands of tasks of a
    large table that merge would be slow, so there the bucket counts first tell how far in hash
    order to look, and only those rows are sorted.
    """
    order = digest(key, seed)
    if df.count() > large:
        edge = _edge_bucket(df.select(order.alias("_digest")), F.lit(n))
        if edge is not None:
            df = df.filter(F.substring(order, 1, _BUCKET_DIGITS) <= F.lit(edge["_bucket"]))
    return df.orderBy(order, F.col(key)).limit(n)


def _edge_bucket(hashed: DataFrame, place: Column):
    """The bucket ``(_bucket, _n, _upto, _place)`` that holds the row at ``place`` (1-based) in hash order; None if there is
    no such row. ``place`` may use ``_rows``, the number of all rows."""
    buckets = hashed.groupBy(F.substring("_digest", 1, _BUCKET_DIGITS).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    # At most 16**_BUCKET_DIGITS rows, whatever the table's size.
    running = buckets.withColumn("_upto", F.sum("_n").over(Window.orderBy("_bucket"))).withColumn(
        "_rows", F.sum("_n").over(Window.partitionBy())).withColumn("_place", place.cast("long"))
    return running.filter((F.col("_place") > 0) & (F.col("_upto") >= F.col("_place"))).orderBy("_bucket").first()


def shuffle(df: DataFrame, key: str, seed: int = SEED, position: str = "position") -> DataFrame:
    """Number all rows 1..n in hash order."""
    hashed = df.withColumn("_digest", digest(key, seed))
    return _number(hashed, ["_digest", key], position).drop("_digest")


def _number(df: DataFrame, order: Sequence[str], position: str, weight: str | None = None) -> DataFrame:
    """Rank rows of ``df``, which has a uniform ``_digest``; ``weight`` makes a row take several places."""
    bucketed = df.withColumn("_bucket", F.substring("_digest", 1, _BUCKET_DIGITS))
    size = F.sum(weight) if weight else F.count(F.lit(1))
    # At most 16**_BUCKET_DIGITS rows from here on, whatever the table's size.
    counts = bucketed.groupBy("_bucket").agg(size.alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_bucket").orderBy(*order)
    if weight:
        rank = F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(weight) + 1
    else:
        rank = F.row_number().over(inside)
    return (
        bucketed.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(position, (F.col("_offset") + F.col("_rank")).cast("long"))
        .drop("_bucket", "_rank", "_offset")
    )


def sequential_ids(df: DataFrame, name: str, prefix: str, seed: int = SEED) -> DataFrame:
    """Give rows without a key the ids ``prefix0, prefix1, …`` in the hash order of their content.

    Equal rows are counted first and spread out again afterwards, so many copies of one row do not
    end up in one bucket.
    """
    columns = df.columns
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    hashed = groups.withColumn("_digest", digest(row_digest(columns), seed))
    numbered = _number(hashed, ["_digest"], "_first", weight="_copies")
    step = 100_000
    chunks = numbered.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(step))))
    spread = chunks.repartition("_digest", "_chunk")
    last = F.least(F.col("_chunk") + step, F.col("_copies")) - 1
    copy = F.explode(F.sequence(F.col("_chunk"), last))
    return spread.withColumn("_copy", copy).select(
        *columns,
        F.concat(F.lit(prefix), (F.col("_first") - 1 + F.col("_copy")).cast("string")).alias(name),
    )


def split_random(df: DataFrame, key: str, test_fraction: float = TEST_FRACTION, seed: int = SEED,
                 flag: str = "is_test") -> DataFrame:
    """Mark exactly ``ceil(test_fraction * rows)`` rows as test: those first in hash order.

    Bucket counts and one bucket's rows give the hash of the last test row; marking the rows is then
    a plain expression without a shuffle. ``key`` must be unique.
    """
    hashed = df.withColumn("_digest", digest(key, seed))
    edge = _edge_bucket(hashed, F.ceil(F.lit(test_fraction) * F.col("_rows")))
    if edge is None:
        return df.withColumn(flag, F.lit(False))
    rank = edge["_place"] - (edge["_upto"] - edge["_n"])
    last = (
        hashed.filter(F.col("_digest").startswith(edge["_bucket"]))
        .select("_digest", key).orderBy("_digest", key).offset(rank - 1).first()
    )
    first_part = F.col("_digest") < F.lit(last["_digest"])
    on_edge = (F.col("_digest") == F.lit(last["_digest"])) & (F.col(key) <= F.lit(last[key]))
    return hashed.withColumn(flag, first_part | on_edge).drop("_digest")


def split_stratified(df: DataFrame, key: str, label: str, test_fraction: float = TEST_FRACTION,
                     seed: int = SEED, flag: str = "is_test") -> DataFrame:
    """Mark ``round(test_fraction * class rows)`` rows of every class as test, first in hash order.

    Only each class's boundary bucket is ranked, 1/65,536 of its rows; so a class that holds most of
    the table is no hot spot. The per-class limits are broadcast if there are few of them.
    """
    hashed = df.withColumn("_digest", digest(key, seed)).withColumn(
        "_bucket", F.substring("_digest", 1, _BUCKET_DIGITS)
    )
    narrow = hashed.select(F.col(label).alias("_label"), "_bucket", "_digest")
    counts = narrow.groupBy("_label", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    ordered = Window.partitionBy("_label").orderBy("_bucket")
    whole = Window.partitionBy("_label")
    edges = (
        counts.withColumn("_upto", F.sum("_n").over(ordered))
        .withColumn("_wanted", F.round(F.lit(test_fraction) * F.sum("_n").over(whole)).cast("long"))
        .filter((F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("_n") < F.col("_wanted")))
        .select(F.col("_label").alias("_edge_label"), F.col("_bucket").alias("_edge_bucket"),
                (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_rest"))
    )
    boundary = narrow.join(
        small_side(edges),
        F.col("_label").eqNullSafe(F.col("_edge_label")) & (F.col("_bucket") == F.col("_edge_bucket")),
    )
    rank = F.row_number().over(Window.partitionBy("_label").orderBy("_digest"))
    limits = (
        boundary.withColumn("_rank", rank).filter(F.col("_rank") == F.col("_rest"))
        .select(F.col("_label").alias("_limit_label"), F.col("_digest").alias("_last"))
    )
    marked = hashed.join(small_side(limits), F.col(label).eqNullSafe(F.col("_limit_label")), "left")
    return marked.withColumn(
        flag, F.coalesce(F.col("_digest") <= F.col("_last"), F.lit(False))
    ).drop("_digest", "_bucket", "_last", "_limit_label")
