import json

from pyspark.sql import functions as F

from cadenza.operators.recommend import last_interactions
from cadenza.streaming import interactions as feed
from cadenza.streaming.latest import ListTable, kept_tracks, write_lists

SCHEMA = "event_id long, ts timestamp, user_id string, track_id string, action string"


def drop_file(folder, name, rows):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"event_id": i, "ts": f"2024-01-01T00:{m:02d}:00Z", "user_id": u, "track_id": t, "action": "click"})
             for i, m, u, t in rows]
    (folder / name).write_text("\n".join(lines))


def run(spark, tmp_path, n, every=10, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    table = ListTable(str(tmp_path / "lists"), every)
    write_lists(kept_tracks(feed.interactions(stream), n, **options), table, str(tmp_path / "cp")).awaitTermination()
    return table, {r["user_id"]: r["tracks"] for r in table.read(spark).collect()}


def test_repeats_and_late_events_equal_the_batch(spark, tmp_path):
    events = [(i, (i * 7) % 60, f"u{i % 3 if i % 2 else 0}", f"t{i % 11}") for i in range(120)]
    for part in range(3):  # every file repeats half of the one before
        again = events[part - 1::3][::2] if part else []
        drop_file(tmp_path / "in", f"{part}.json", events[part::3] + again + events[part::3][:5])
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    _, got = run(spark, tmp_path, 8, every=2)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider
    batch = last_interactions(feed.once(feed.interactions(spark.read.schema(SCHEMA).json(str(tmp_path / "in")))), 8)
    want = {r["user_id"]: [t[1] for t in r["x"]] for r in batch.groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("age")).alias("o"), "track_id"))).alias("x")).collect()}
    assert got == want


def test_repeats_take_no_second_place_without_time_to_live(spark, tmp_path):
    drop_file(tmp_path / "in", "a.json", [(1, 1, "u", "a"), (2, 2, "u", "b"), (2, 2, "u", "b"), (1, 1, "u", "a"), (3, 3, "u", "c")])
    stream = feed.interactions(spark.readStream.schema(SCHEMA).json(str(tmp_path / "in")))
    feed.write_latest(feed.latest_tracks(stream, 4), str(tmp_path / "lists"), str(tmp_path / "cp")).awaitTermination()
    assert feed.read_latest(spark, str(tmp_path / "lists")).first()["tracks"] == ["a", "b", "c"]


def test_state_of_an_idle_user_goes(spark, tmp_path):
    drop_file(tmp_path / "in", "a.json", [(1, 1, "left", "a"), (2, 2, "stays", "b")])
    assert run(spark, tmp_path, 5, ttl_seconds=600)[1] == {"left": ["a"], "stays": ["b"]}
    drop_file(tmp_path / "in", "b.json", [(3, 9, "stays", "c"), (4, 3, "other", "late")])
    drop_file(tmp_path / "in", "c.json", [(5, 18, "stays", "d")])
    assert run(spark, tmp_path, 5, ttl_seconds=600)[1] == {"stays": ["b", "c", "d"]}
    drop_file(tmp_path / "in", "d.json", [(6, 20, "left", "e")])
    assert run(spark, tmp_path, 5, ttl_seconds=600)[1] == {"left": ["e"], "stays": ["b", "c", "d"]}


def test_log_has_a_repeated_event_once_over_batches(spark, tmp_path):
    rows = [(i, i, "u", f"t{i}") for i in range(6)]
    for name in "abc":
        drop_file(tmp_path / "in", f"{name}.json", rows)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    feed.write_log(feed.once(feed.interactions(stream)), str(tmp_path / "log"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "log"))
    assert sorted(r["event_id"] for r in got.collect()) == list(range(6))


def test_files_stay_bounded_over_fifty_batches(spark, tmp_path):
    table, most = ListTable(str(tmp_path / "lists"), every=5), 0
    for b in range(50):
        rows = [(f"u{b % 7}", [f"t{b}"], b, None), (f"v{b}", ["x"], b, None)]
        batch = spark.createDataFrame(rows, "user_id string, tracks array<string>, last_event_id long, last_ts timestamp").coalesce(1)
        table.save(batch, b)
        most = max(most, len(list((tmp_path / "lists").rglob("part-*.parquet"))))
    assert most <= 2 * 4 + 2 * 5 + 1  # two versions of at most four files, the changes since the older one
    table.save(batch, 49)  # a repeated batch changes nothing
    lists = {r["user_id"]: r["tracks"] for r in table.read(spark).collect()}
    assert len(lists) == 57 and lists["u0"] == ["t49"] and lists["v3"] == ["x"]
    assert table.versions(spark) == [44, 49] and min(table.changes(spark)) > 39
