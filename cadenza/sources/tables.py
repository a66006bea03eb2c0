"""Stored tables: typed schema, append, overwrite, upsert, checks after loading, JDBC options."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.scalar import to_number
from cadenza.operators.clean import first_per_key, nan_to_null

# The stored track table.
TRACK_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("track_name", T.StringType()),
    T.StructField("track_id", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("popularity", T.IntegerType()),
    T.StructField("danceability", T.DoubleType()),
    T.StructField("energy", T.DoubleType()),
    T.StructField("loudness", T.DoubleType()),
    T.StructField("speechiness", T.DoubleType()),
    T.StructField("acousticness", T.DoubleType()),
    T.StructField("instrumentalness", T.DoubleType()),
    T.StructField("valence", T.DoubleType()),
    T.StructField("created_at", T.TimestampType()),
])
LOADED_COLUMNS = [f.name for f in TRACK_SCHEMA.fields if f.name not in ("id", "created_at")]


def create_table(spark: SparkSession, name: str, schema: T.StructType = TRACK_SCHEMA, path: str | None = None,
                 partition_by: Sequence[str] = ()) -> None:
    """Create an empty Parquet table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{place}")


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the stored types: text to numbers where needed, NaN to NULL, absent columns NULL."""
    present = set(df.columns)
    columns = []
    for f in schema.fields:
        if f.name not in present:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.NumericType) and isinstance(df.schema[f.name].dataType, T.StringType):
            columns.append(to_number(F.col(f.name)).try_cast(f.dataType).alias(f.name))
        else:
            columns.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return nan_to_null(df.select(*columns))


def append(df: DataFrame, table: str) -> None:
    df.write.mode("append").insertInto(table)


def replace_rows(df: DataFrame, table: str) -> None:
    """Truncate, then load."""
    df.write.mode("overwrite").insertInto(table)


def upsert(existing: DataFrame, incoming: DataFrame, key: str, columns: Sequence[str], latest: Sequence[Column | str],
           new_row: Mapping[str, Column] | None = None) -> DataFrame:
    """Merge ``incoming`` into ``existing``; the last incoming row of a key wins.

    Matched rows take the incoming ``columns``, NULLs included, and keep the other stored columns.
    New rows get ``new_row`` for those. ``latest`` orders incoming rows, the winner first. Write the
    result to a new place and switch to it; it reads the old one. Rows without a key conflict with
    nothing: all of them are added.
    """
    keyed = first_per_key(incoming.filter(F.col(key).isNotNull()), [key], latest)
    winners = keyed.unionByName(incoming.filter(F.col(key).isNull())).select(
        key, *[F.col(c).alias(f"_in_{c}") for c in columns], F.lit(True).alias("_given")
    )
    stored = existing.withColumn("_stored", F.lit(True))
    merged = stored.join(winners, key, "full_outer")
    given = F.coalesce(F.col("_given"), F.lit(False))
    fresh = F.col("_stored").isNull()
    out = []
    for c in existing.columns:
        if c in columns:
            out.append(F.when(given, F.col(f"_in_{c}")).otherwise(F.col(c)).alias(c))
        elif new_row and c in new_row:
            out.append(F.when(fresh, new_row[c]).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return merged.select(*out)


def load_summary(df: DataFrame, category: str) -> DataFrame:
    """Rows per category as SQL GROUP BY sees them (NULL is a group), with the table's total."""
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("count"))
    total = df.count()
    return counts.withColumn("total_rows", F.lit(total).cast("long")).orderBy(F.desc("count"), category)


def run_sql(spark: SparkSession, text: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """Run SQL with bound parameters (``:name``)."""
    return spark.sql(text, args=dict(args or {}))


def as_dicts(df: DataFrame, limit: int) -> list[dict]:
    """The first ``limit`` rows as dicts, for callers that need records."""
    return [r.asDict(recursive=True) for r in df.limit(limit).collect()]


def table_names(spark: SparkSession) -> DataFrame:
    names = sorted(t.name for t in spark.catalog.listTables())
    return spark.createDataFrame([(n,) for n in names], "table_name string")


def project(df: DataFrame, columns: Sequence[str] = LOADED_COLUMNS, limit: int | None = None,
            order: Sequence[str] = ("track_id",)) -> DataFrame:
    """Column projection, optionally bounded in a repeatable way."""
    chosen = df.select(*columns)
    return chosen if limit is None else chosen.orderBy(*order).limit(limit)


class VersionConflict(RuntimeError):
    """Another writer has published the version first."""


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Give a completely written folder its final name, which must not exist: :class:`VersionConflict` if it does.

    The file system's rename without overwriting is the commit, so of two writers one wins. It is one step on HDFS and
    local disks; stores that copy instead of renaming need a committer of their own.
    """
    jvm = spark._jvm
    names = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    names[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    path = jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(path(staged), path(target), names)
    except Exception as e:
        if files.exists(path(target)) and files.exists(path(staged)):
            raise VersionConflict(target) from e
        raise


def replace_by_upsert(spark: SparkSession, path: str, incoming: DataFrame, key: str, columns: Sequence[str],
                      latest: Sequence[Column | str], id: str = "id", created: str = "created_at", attempts: int = 10) -> str:
    """Upsert into the newest version of the Parquet table under ``path`` and return the new version's folder.

    Each version is a folder of its own, written in full under another name before :func:`publish` makes it visible, so
    readers never see half a table. If another writer has published that version meanwhile, the upsert starts again on
    the other's result: nothing of either is lost. New rows get ids above the largest one (unique, not gapless) and the
    current time.
    """
    for _ in range(attempts):
        now = current_version(spark, path)
        existing = spark.read.parquet(now)
        top = existing.agg(F.max(id)).first()[0] or 0
        new_row = {id: F.monotonically_increasing_id() + F.lit(top + 1), created: F.current_timestamp()}
        merged = upsert(existing, incoming, key, columns, latest, {c: v for c, v in new_row.items() if c in existing.columns})
        base, staged = path.rstrip("/"), f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
        merged.write.parquet(staged)
        target = f"{base}/version={int(now.rsplit('=', 1)[1]) + 1}"
        try:
            publish(spark, staged, target)
            return target
        except VersionConflict:
            place = spark._jvm.org.apache.hadoop.fs.Path(staged)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    raise VersionConflict(f"{attempts} times another writer was first in {path}")


def current_version(spark: SparkSession, path: str) -> str:
    """Folder of the newest completely written version of a table kept by :func:`replace_by_upsert`."""
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [s.getPath() for s in files.listStatus(base) if s.getPath().getName().startswith("version=")
            and files.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    if not done:
        raise ValueError(f"no version of a table in {path}")
    return max((p.toString() for p in done), key=lambda p: int(p.rsplit("=", 1)[1]))


def jdbc_options(url: str, table: str, columns: Sequence[str] = LOADED_COLUMNS, partition_column: str | None = "id",
                 bounds: tuple[int, int] | None = None, partitions: int = 64, fetch_size: int = 10_000,
                 **extra: str) -> dict[str, str]:
    """Options of a parallel JDBC scan of chosen columns. Credentials come in through ``extra``."""
    options = {"url": url, "fetchsize": str(fetch_size), **extra}
    names = list(columns)
    if partition_column and bounds:
        if partition_column not in names:
            names.append(partition_column)
        options |= {
            "partitionColumn": partition_column, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    options["dbtable"] = f"(SELECT {', '.join(names)} FROM {table}) AS source"
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    """A parallel scan. Without ``bounds`` those of the partition column are asked for first; one task reads all only if
    ``partition_column`` is None."""
    column = options.get("partition_column", "id")
    if column and not options.get("bounds"):
        asked = jdbc_options(**{**options, "columns": [f"MIN({column}) AS low", f"MAX({column}) AS high"],
                                "partition_column": None})
        row = spark.read.format("jdbc").options(**asked).load().first()
        if row[0] is not None:
            options["bounds"] = (int(row[0]), int(row[1]) + 1)
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 1000, **extra: str) -> None:
    """Append in batches, or ``mode="overwrite"`` to truncate and load."""
    df.write.format("jdbc").mode(mode).options(
        url=url, dbtable=table, batchsize=str(batch_size), truncate="true", **extra
    ).save()
