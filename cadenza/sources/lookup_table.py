"""A stored table for point lookups: clustered by the hash of its key, with Bloom filters.

Rows lie in a folder per hash bucket of the key, sorted by key; each row group carries a Bloom filter of its keys. Ids
that are asked for reach the scan as literals: it opens the folders of their buckets only, and skips row groups by their
least and greatest key and by the filter. Many ids are joined, still bucket by bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256
ROWS_PER_BUCKET = 1_000_000
#: So many ids are pushed to the scan as literals.
LITERALS = 1_000
_ABOUT = "key string, buckets int"
BUCKET = "_bucket"


def bucket_of(key: Column, buckets: int) -> Column:
    """Bucket of a key, the same for whole numbers of any width; rows without a key are in bucket 0."""
    return F.coalesce(F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)), F.lit(0)).cast("int")


def write_lookup(df: DataFrame, path: str, key: str, buckets: int | None = None, row_group: int = 16 << 20) -> None:
    """Write ``df`` to the new folder ``path``. Keys may repeat: a bucket that is far larger than others is split over
    several tasks and files. Without ``buckets`` their number follows the number of rows."""
    rows = df.count()
    buckets = buckets or max(1, min(4096, max(math.ceil(rows / ROWS_PER_BUCKET), min(BUCKETS, rows // 1000))))
    placed = df.withColumn(BUCKET, bucket_of(F.col(f"`{key}`"), buckets))
    placed.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, F.col(f"`{key}`")).write.partitionBy(BUCKET).option(
        f"parquet.bloom.filter.enabled#{key}", "true").option(
        f"parquet.bloom.filter.expected.ndv#{key}", str(max(1000, min(ROWS_PER_BUCKET, rows // buckets * 2)))).option(
        "parquet.block.size", str(row_group)).parquet(f"{path}/rows")
    df.sparkSession.createDataFrame([(key, buckets)], _ABOUT).coalesce(1).write.json(f"{path}/about")


def find(spark: SparkSession, path: str, ids: DataFrame | list) -> DataFrame:
    """Rows whose key is among ``ids``: a list, or a DataFrame with the key's column. NULL ids find nothing."""
    about = spark.read.schema(_ABOUT).json(f"{path}/about").first()
    key, buckets = about["key"], about["buckets"]
    rows = spark.read.parquet(f"{path}/rows")
    kind = rows.schema[key].dataType
    if isinstance(ids, list):
        ids = spark.createDataFrame([(i,) for i in ids if i is not None], f"`{key}` {kind.simpleString()}")
    wanted = ids.select(F.col(f"`{key}`").cast(kind).alias(key)).dropna().distinct().withColumn(
        BUCKET, bucket_of(F.col(f"`{key}`"), buckets))
    few = wanted.limit(LITERALS + 1).collect()
    if len(few) <= LITERALS:
        places = sorted({r[BUCKET] for r in few})
        return rows.filter(F.col(BUCKET).isin(places) & F.col(f"`{key}`").isin([r[key] for r in few])).drop(BUCKET)
    return rows.join(wanted, [BUCKET, key], "left_semi").drop(BUCKET).select(*[c for c in rows.columns if c != BUCKET])


def missing(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """The ids, once each, that the table does not have."""
    key = spark.read.schema(_ABOUT).json(f"{path}/about").first()["key"]
    wanted = ids.select(F.col(f"`{key}`")).distinct()
    return wanted.join(find(spark, path, ids).select(key).distinct(), key, "left_anti")
