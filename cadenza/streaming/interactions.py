"""Streaming jobs over the interaction feed: the log, each user's latest tracks, scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cadenza.operators.clean import first_per_key
from cadenza.operators.recommend import COUNTED_ACTIONS, KEPT_INTERACTIONS

DEFAULT_USER = "anonymous"
DEFAULT_ACTION = "click"


def interactions(events: DataFrame, actions: Sequence[str] = COUNTED_ACTIONS) -> DataFrame:
    """Counted interactions ``(user_id, track_id, action, ts, event_id)``. Works on batch and stream.

    Events without a track are rejected; a missing action or user takes the default.
    """
    return events.select(
        F.coalesce(F.col("user_id").cast("string"), F.lit(DEFAULT_USER)).alias("user_id"),
        F.col("track_id").cast("string").alias("track_id"),
        F.coalesce("action", F.lit(DEFAULT_ACTION)).alias("action"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").cast("long").alias("event_id"),
    ).filter(F.col("track_id").isNotNull() & F.col("action").isin(list(actions)))


def rejected(events: DataFrame) -> DataFrame:
    """Events that cannot be logged or ordered: no track, no time or no id. Works on batch and stream."""
    return events.filter(F.col("track_id").isNull() | F.col("ts").isNull() | F.col("event_id").isNull())


def once(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Events that can be ordered, each event id once. On a stream the ids are kept as state until the watermark, the
    latest time seen less ``delay``, has passed them; events that come later than that are left out, since they can no
    longer be told from repeats. Works on batch and stream."""
    placed = events.filter(F.col("ts").isNotNull() & F.col("event_id").isNotNull())
    if not placed.isStreaming:
        return first_per_key(placed, ["event_id"], ["ts", "user_id", "track_id"])
    return placed.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def write_log(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append counted interactions to a Parquet log, exactly once."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


_STATE = "ts array<bigint>, event_id array<bigint>, track_id array<string>"
_OUTPUT = "user_id string, tracks array<string>, last_event_id bigint"


def _cut_batches(n: int):
    """Keep each user's latest ``n`` rows of an Arrow batch, so a very active user shuffles little."""

    def cut(batches):
        for batch in batches:
            latest = batch.sort_values(["ts_us", "event_id"], ascending=False, kind="stable")
            yield latest.drop_duplicates(["user_id", "event_id"]).groupby("user_id", sort=False).head(n)

    return cut


def latest_of(held: list[tuple], batches, n: int) -> list[tuple]:
    """The latest ``n`` of (time, event, track) triples and new rows, oldest first. An event that comes again is one event:
    it is either still held or older than all that are."""
    for batch in batches:
        rows = zip(batch["ts_us"].tolist(), batch["event_id"].tolist(), batch["track_id"].tolist())
        newest = {event: (int(time), int(event), track) for time, event, track in sorted([*held, *rows], key=lambda x: x[:2])}
        held = sorted(newest.values(), key=lambda x: x[:2])[-n:]
    return held


def _keep_latest(n: int):
    def update(key, batches, state: GroupState):
        import pandas as pd

        held = latest_of(list(zip(*state.get)) if state.exists else [], batches, n)
        state.update(tuple(list(x) for x in zip(*held)))
        yield pd.DataFrame({
            "user_id": [key[0]], "tracks": [[c for _, _, c in held]], "last_event_id": [held[-1][1]],
        })

    return update


def latest_tracks(stream: DataFrame, n: int = KEPT_INTERACTIONS) -> DataFrame:
    """Keyed state: each user's last ``n`` tracks by event time, so late events find their place.

    Emits a user's new list whenever it changes (update mode). Events without a time or an id have no place in the
    order and are left out; :func:`rejected` selects them for a side folder.
    """
    placed = stream.filter(F.col("ts").isNotNull() & F.col("event_id").isNotNull())
    timed = placed.select("user_id", "track_id", F.unix_micros("ts").alias("ts_us"), "event_id")
    cut = timed.mapInPandas(_cut_batches(n), timed.schema)
    return cut.groupBy("user_id").applyInPandasWithState(
        _keep_latest(n), _OUTPUT, _STATE, "update", GroupStateTimeout.NoTimeout
    )


def write_latest(lists: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write each micro-batch's changed lists to its own folder. A repeated batch overwrites itself."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = lists.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).outputMode("update")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest list of every user."""
    rows = spark.read.schema(f"{_OUTPUT}, batch bigint").parquet(path)
    newest = Window.partitionBy("user_id").orderBy(F.desc("batch"))
    return rows.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank", "batch")


def score_stream(stream: DataFrame, model: PipelineModel, shape: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Apply a fitted pipeline to new rows as they arrive. Stateless: each row is scored once."""
    scored = model.transform(stream)
    return shape(scored) if shape else scored
