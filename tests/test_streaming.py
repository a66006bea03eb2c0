import json

from pyspark.sql import functions as F

from cadenza.operators.recommend import last_interactions
from cadenza.streaming import interactions as feed

SCHEMA = "event_id long, ts timestamp, user_id string, track_id string, action string"


def drop_file(folder, name, rows):
    lines = [json.dumps({"event_id": i, "ts": f"2024-01-01T00:{m:02d}:00Z", "user_id": u, "track_id": t, "action": a})
             for i, m, u, t, a in rows]
    (folder / name).write_text("\n".join(lines))


def run(spark, tmp_path, n):
    stream = feed.interactions(spark.readStream.schema(SCHEMA).json(str(tmp_path / "in")))
    feed.write_latest(feed.latest_tracks(stream, n), str(tmp_path / "lists"), str(tmp_path / "cp")).awaitTermination()
    return {r["user_id"]: r["tracks"] for r in feed.read_latest(spark, str(tmp_path / "lists")).collect()}


def test_late_events_find_their_place(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    drop_file(folder, "a.json", [(i, i, "u", f"t{i}", "click") for i in range(10, 20)] + [(50, 5, None, "x", None), (51, 6, "u", None, "click")])
    assert run(spark, tmp_path, 5) == {"u": [f"t{i}" for i in range(15, 20)], "anonymous": ["x"]}
    drop_file(folder, "b.json", [(60, 17, "u", "late", "like"), (61, 1, "u", "too-late", "click"), (62, 59, "u", "v", "view")])
    assert run(spark, tmp_path, 5)["u"] == ["t16", "t17", "late", "t18", "t19"]


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    events = [(i, (i * 7) % 60, f"u{i % 3 if i % 2 else 0}", f"t{i % 11}", "click") for i in range(400)]
    for part in range(4):
        drop_file(folder, f"{part}.json", events[part::4])
    got = run(spark, tmp_path, 50)
    batch = last_interactions(spark.read.schema(SCHEMA).json(str(folder)), 50)
    want = {r["user_id"]: [t[1] for t in r["x"]] for r in batch.groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("age")).alias("o"), "track_id"))).alias("x")).collect()}
    assert got == want


def test_log_keeps_counted_actions(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    drop_file(folder, "a.json", [(1, 1, "u", "a", "click"), (2, 2, "u", "b", "view"), (3, 3, None, "c", None), (4, 4, "u", None, "like")])
    stream = feed.interactions(spark.readStream.schema(SCHEMA).json(str(folder)))
    for _ in range(2):  # a second run finds nothing new
        feed.write_log(stream, str(tmp_path / "log"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "log"))
    assert sorted((r["user_id"], r["track_id"]) for r in got.collect()) == [("anonymous", "c"), ("u", "a")]
