"""Session helpers: scratch folders and size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cadenza")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder set in ``spark.checkpoint.dir``.

    A temporary folder stands in only when the setting is absent and Spark runs in one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cadenza-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once to shared scratch and read it back, so later steps do not recompute it. ``options`` are the writer's."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_blocks(df: DataFrame, label: str) -> DataFrame:
    """:func:`materialise` for rows of some megabytes each, to be read by Python functions alone.

    Parquet's writer looks at a row group's size after a hundred rows only, and a reader holds a row group at once; Spark
    sends thousands of rows or 64 MB to Python at once. Here a few rows are in each. The copy of the session that reads
    them has the same settings but for that.
    """
    spark = df.sparkSession
    stored = materialise(df, label, **{"parquet.block.row.count.limit": "4"})
    session = spark._jsparkSession.cloneSession()
    session.conf().set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    files = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 1)
    files[0] = stored.inputFiles()[0].rsplit("/", 1)[0]
    return DataFrame(session.read().schema(stored._jdf.schema()).parquet(files), spark)


def discard(df: DataFrame) -> None:
    """Delete the scratch folder that :func:`materialise` wrote for ``df``. Nothing may read it any more: all that was made
    from it must be stored itself. Other folders are left alone."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if re.fullmatch(r"[\w-]+-[0-9a-f]{32}", folder.rsplit("/", 1)[1]):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``max_rows`` rows, else return it unchanged.

    Only ``max_rows + 1`` rows are ever fetched. Beyond the bound the caller's join is a shuffle
    join, which AQE splits on skewed keys.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
