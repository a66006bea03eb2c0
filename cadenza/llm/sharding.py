"""Sharding by longest-processing-time scheduling.

Groups of documents that must stay together are sorted by size and go, largest first, to the least-loaded shard.
A heap over all groups would be one task over the whole corpus, so the schedule has two levels with the same rule:

* A group above ``total / (shards * HEAVY)`` is heavy; there are at most ``shards * HEAVY`` of them.
* The others are dealt by key hash into ``BUCKETS`` buckets. Each bucket's groups stream past a heap, largest first,
  into ``shards`` bins of that bucket; the state of a task is one heap.
* Heavy groups and bins, at most ``shards * (HEAVY + BUCKETS)`` items whatever the input, go largest first through the
  final heap on the driver.

A light group is below 1/HEAVY of a shard, so shards differ by little more than that unless a heavy group is itself
larger than a shard.

Defined results: NULL text has size 1 and forms one group of its own; the empty text another. Repeated rows are placed
each by itself, in the shard of their group. An empty table gives no rows. Input columns other than the two named are
not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import copies_key, narrow, stored, unsigned_crc32

HEAVY = 1024
BUCKETS = 2048
BLOCKS = 512


def least_loaded(items: list[tuple], shards: int) -> dict:
    """Key -> shard for (size, key) items: largest first, ties by key, each to the shard with the least load."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for size, key in sorted(items, key=lambda x: (-x[0], str(x[1]))):
        load, s = heapq.heappop(heap)
        placed[key] = s
        heapq.heappush(heap, (load + size, s))
    return placed


def bucket_bins(shards: int):
    """A function for ``mapInPandas``: rows sorted by bucket and falling size get the bin of their bucket."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, heap = None, []
        for batch in batches:
            bins = []
            for bucket, size in zip(batch["bucket"], batch["group_size"]):
                if bucket != current:
                    current, heap = bucket, [(0, b) for b in range(shards)]
                load, b = heapq.heappop(heap)
                bins.append(b)
                heapq.heappush(heap, (load + size, b))
            yield batch.assign(bin=pd.Series(bins, dtype="int32"))[["key", "bucket", "bin", "group_size"]]

    return assign


def shard_groups(groups: DataFrame, shards: int) -> DataFrame:
    """``key``, ``shard`` for one row per group with ``key`` (string) and ``group_size`` (long)."""
    spark = groups.sparkSession
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    heavy_above = total / (shards * HEAVY)
    heavy = [(r["group_size"], r["key"]) for r in groups.filter(F.col("group_size") > heavy_above).collect()]
    light = groups.filter(F.col("group_size") <= heavy_above).select(
        "key", "group_size", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int").alias("bucket"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    binned = stored(
        light.repartition(parts, "bucket").sortWithinPartitions("bucket", F.desc("group_size"), "key")
        .mapInPandas(bucket_bins(shards), "key string, bucket int, bin int, group_size long"), "shard-bins")
    bins = binned.groupBy("bucket", "bin").agg(F.sum("group_size").alias("size")).collect()
    placed = least_loaded(heavy + [(r["size"], (r["bucket"], r["bin"])) for r in bins], shards)
    of_bins = spark.createDataFrame([(*k, s) for k, s in placed.items() if isinstance(k, tuple)],
                                    "bucket int, bin int, shard int")
    of_heavy = spark.createDataFrame([(k, s) for k, s in placed.items() if isinstance(k, str)],
                                     "key string, shard int")
    return binned.join(F.broadcast(of_bins), ["bucket", "bin"]).select("key", "shard").unionByName(of_heavy)


def slots(rows: DataFrame, shard: str, order: str) -> DataFrame:
    """Number the rows of each shard from 0 without a gap. ``order`` is unique and must be stored.

    Rows are numbered within BLOCKS blocks of a shard, which start where the blocks before them end.
    """
    blocked = rows.withColumn("block", F.pmod(F.xxhash64(order), F.lit(BLOCKS)).cast("int"))
    before = Window.partitionBy(shard).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocked.groupBy(shard, "block").agg(F.count("*").alias("n")).select(
        shard, "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy(shard, "block").orderBy(order)
    return blocked.withColumn("within", F.row_number().over(within) - 1).join(
        F.broadcast(starts), [shard, "block"]).withColumn("slot", (F.col("start") + F.col("within")).cast("long")).drop(
        "block", "within", "start")


def shard_documents(docs: DataFrame, shards: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``size`` (UTF-8 bytes + 1), ``text_crc32``, ``shard`` and ``slot``."""
    read = narrow(docs, doc_id=id, text=text)
    rows = stored(read.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        unsigned_crc32("text").alias("text_crc32"), copies_key("text").alias("key"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("group_size")), "shard-groups")
    placed = stored(rows.join(shard_groups(groups, shards), "key").drop("key"), "shard-placed")
    return slots(placed, "shard", "row").select("doc_id", "size", "text_crc32", "shard", "slot")
