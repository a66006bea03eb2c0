"""Each user's latest tracks as list state with a time to live, and their lists as a versioned, compacted table.

State: one list per user, of the last n events by event time. An event that is delivered again changes nothing. A user
whose last event is older, by event time, than the latest of all less the time to live loses state and list; the next event
starts a new one. The state lies in RocksDB, so it may outgrow memory.

Output: every micro-batch writes the lists that changed into a folder of its own, an empty one for a user who left. Each ``every`` batches the newest list of
every user goes into a new version, and what the version before last replaced is deleted: the number of files
does not grow with the number of batches. A batch that Spark repeats writes the same folders again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from cadenza.operators.recommend import KEPT_INTERACTIONS
from cadenza.streaming.interactions import _cut_batches, latest_of

_HELD = "ts_us bigint, event_id bigint, track_id string"
_LISTS = "user_id string, tracks array<string>, last_event_id bigint, last_ts timestamp"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LatestTracks(StatefulProcessor):
    """Keeps the last ``n`` events of a user and emits the list when it changes, an empty one when the user has left."""

    def __init__(self, n: int, ttl_ms: int | None):
        self.n, self.ttl_ms = n, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", _HELD)

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        before = [tuple(x) for x in self.held.get()] if self.held.exists() else []
        held = latest_of(before, rows, self.n)
        if held == before:
            return
        self.held.put(held)
        if self.ttl_ms is not None and (not before or held[-1][0] != before[-1][0]):
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(held[-1][0] // 1000 + self.ttl_ms)
        yield pd.DataFrame({
            "user_id": [key[0]], "tracks": [[c for _, _, c in held]], "last_event_id": [held[-1][1]],
            "last_ts": [pd.Timestamp(held[-1][0], unit="us")],
        })

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import pandas as pd

        self.held.clear()
        yield pd.DataFrame({"user_id": [key[0]], "tracks": [[]], "last_event_id": pd.array([None], dtype="Int64"),
                            "last_ts": pd.array([pd.NaT], dtype="datetime64[us]")})

    def close(self) -> None:
        pass


def kept_tracks(stream: DataFrame, n: int = KEPT_INTERACTIONS, ttl_seconds: float | None = None) -> DataFrame:
    """``user_id``, ``tracks`` (oldest first), ``last_event_id``, ``last_ts`` of every user whose list changed.

    Without ``ttl_seconds`` the state stays. Events without a time or an id are left out. Late events find their place as
    long as the user's state is there. Each task cuts a user's events to ``n`` before the shuffle. Start the query with
    :func:`write_lists`, or with RocksDB as the state store.
    """
    placed = stream.filter(F.col("ts").isNotNull() & F.col("event_id").isNotNull())
    if ttl_seconds is not None:
        placed = placed.withWatermark("ts", "0 seconds")
    timed = placed.select("user_id", "track_id", F.unix_micros("ts").alias("ts_us"), "event_id")
    cut = timed.mapInPandas(_cut_batches(n), timed.schema)
    ttl = None if ttl_seconds is None else max(1, int(ttl_seconds * 1000))
    return cut.groupBy("user_id").transformWithStateInPandas(
        LatestTracks(n, ttl), _LISTS, "Update", "None" if ttl is None else "EventTime")


def _newest(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy(F.desc("batch"))
    return rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == 1).drop("_rank")


@dataclass(frozen=True)
class ListTable:
    """The lists under ``path``: ``changes/batch=b`` per micro-batch and ``version=b`` with all lists up to batch b.

    A folder counts once its writer has finished it, so readers see whole batches and whole versions only.
    """

    path: str
    every: int = 10

    def _done(self, spark: SparkSession, folder: str, prefix: str) -> list[int]:
        base = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = base.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(base):
            return []
        return sorted(int(s.getPath().getName()[len(prefix):]) for s in files.listStatus(base)
                      if s.getPath().getName().startswith(prefix)
                      and files.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))

    def versions(self, spark: SparkSession) -> list[int]:
        return self._done(spark, self.path, "version=")

    def changes(self, spark: SparkSession) -> list[int]:
        return self._done(spark, f"{self.path}/changes", "batch=")

    def save(self, batch: DataFrame, batch_id: int) -> None:
        """Write one micro-batch; for ``foreachBatch``."""
        spark = batch.sparkSession
        batch.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            f"{self.path}/changes/batch={batch_id}")
        if (batch_id + 1) % self.every == 0:
            self.compact(spark, batch_id)

    def compact(self, spark: SparkSession, batch_id: int) -> None:
        """Write version ``batch_id`` and delete what only versions before the last one need."""
        before = [v for v in self.versions(spark) if v < batch_id]
        newest = _newest(self._rows(spark, before[-1] if before else None, batch_id)).filter(F.size("tracks") > 0)
        newest.write.mode("overwrite").parquet(f"{self.path}/version={batch_id}")
        if before:  # readers may still be at the last version, at none before it
            for v in before[:-1]:
                self._delete(spark, f"{self.path}/version={v}")
            for b in self.changes(spark):
                if b <= before[-1]:
                    self._delete(spark, f"{self.path}/changes/batch={b}")

    def _delete(self, spark: SparkSession, folder: str) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def _rows(self, spark: SparkSession, version: int | None, upto: int | None = None) -> DataFrame:
        later = [b for b in self.changes(spark) if (version is None or b > version) and (upto is None or b <= upto)]
        folders = [f"{self.path}/changes/batch={b}" for b in later]
        if version is not None:
            folders.append(f"{self.path}/version={version}")
        schema = f"{_LISTS}, batch bigint"
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest list of every user who has one."""
        done = self.versions(spark)
        return _newest(self._rows(spark, done[-1] if done else None)).filter(F.size("tracks") > 0).drop("batch")


def write_lists(lists: DataFrame, table: ListTable, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start the query that keeps ``table`` up to date. The state store of this query is RocksDB; the session's own
    setting stays as it was."""
    spark = lists.sparkSession
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        writer = lists.writeStream.foreachBatch(table.save).option("checkpointLocation", checkpoint).outputMode("update")
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        spark.conf.set(_PROVIDER, before)
