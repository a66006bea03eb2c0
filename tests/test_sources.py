import uuid

import pytest
from pyspark.sql import functions as F

from cadenza.plans import jobs
from cadenza.session import materialise, scratch_dir, small_side
from cadenza.sources import delimited, metrics_store, tables


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("line, want", [("a;b;c", ";"), ("a,b;c,d", ","), ("a\tb", "\t"), ('"x;y;z",b', ","), ("one", ";")])
def test_delimiter(line, want):
    assert delimited.detect_delimiter(line) == want


@pytest.mark.parametrize("encoding", ["utf-8", "iso-8859-1", "utf-8-sig"])
def test_unknown_files(spark, tmp_path, encoding):
    path = tmp_path / "songs.csv"
    path.write_bytes("Title,Artists,ID,Energy\nÉté,A,1,0.5\nOther,B,2,x\nAgain,C,2,0.9\n".encode(encoding))
    got = delimited.load_upload(spark, str(path), order=["track_name"])
    assert rows(got.select("track_name", "track_id", "energy")) == [("Again", "2", .9), ("Été", "1", .5)]


def test_upload_without_ids(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text("name;energy\nx;1\nx;1\ny;\n")
    got = delimited.load_upload(spark, str(path))
    assert {r["track_id"] for r in got.collect()} == {"custom_0", "custom_1", "custom_2"}
    assert {r["energy"] for r in got.collect()} == {1.0}


def test_upload_checks(spark, tmp_path):
    with pytest.raises(ValueError):
        delimited.check_upload("songs.xlsx")
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    with pytest.raises(ValueError):
        delimited.load_upload(spark, str(empty))


def test_served_file(spark, tmp_path):
    path = tmp_path / "served.csv"
    path.write_text(" Title ;Artists;Song URL;Loudness;Energy\nA;x;http://h/t/1;-710;0.6\nB;y;http://h/t/2?si=1;abc;\nA2;x;http://h/t/1;0;0.9\n")
    got = {r["track_id"]: r for r in delimited.load_serving(spark, str(path), order=["track_name"]).collect()}
    assert set(got) == {"1", "2?si=1"}
    assert got["1"]["track_name"] == "A" and got["1"]["loudness"] == pytest.approx(-7.1)
    assert got["2?si=1"]["loudness"] == -12.0 and got["2?si=1"]["energy"] == pytest.approx(.6)  # median after deduplication
    assert dict(delimited.load_serving(spark, str(path)).dtypes)["energy"] == "float"


def test_quotes_survive_a_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", you', 1)], "a string, b int")
    delimited.write_csv(df, str(tmp_path / "out"))
    assert rows(delimited.read_csv(spark, str(tmp_path / "out"), schema=df.schema)) == rows(df)
    assert delimited.peek(spark, str(tmp_path / "out")).columns == ["a", "b"]


def test_upsert(spark):
    stored = spark.createDataFrame([(1, "a", 5.0, "old"), (2, "b", 6.0, "old")], "id long, track_id string, energy double, created_at string")
    incoming = spark.createDataFrame([("a", 1.0, 1), ("a", None, 2), ("c", 3.0, 1)], "track_id string, energy double, n int")
    got = tables.upsert(stored, incoming, "track_id", ["energy"], [F.desc("n")], {"created_at": F.lit("new")})
    assert sorted((r["track_id"], r["energy"], r["created_at"]) for r in got.collect()) == [
        ("a", None, "old"), ("b", 6.0, "old"), ("c", 3.0, "new")]


def test_table_life(spark, tmp_path):
    name = f"tracks_{uuid.uuid4().hex}"
    tables.create_table(spark, name, path=str(tmp_path / "t"))
    tables.create_table(spark, name, path=str(tmp_path / "t"))
    raw = spark.createDataFrame([("t1", "pop", "1.5e-3"), ("t2", None, "bad")], "track_id string, genre string, instrumentalness string")
    tables.append(tables.to_schema(raw, tables.TRACK_SCHEMA), name)
    tables.append(tables.to_schema(raw, tables.TRACK_SCHEMA), name)
    assert spark.table(name).count() == 4
    tables.replace_rows(tables.to_schema(raw, tables.TRACK_SCHEMA), name)
    assert rows(spark.table(name).select("track_id", "instrumentalness")) == [("t1", .0015), ("t2", None)]
    summary = {r["genre"]: (r["count"], r["total_rows"]) for r in tables.load_summary(spark.table(name), "genre").collect()}
    assert summary == {"pop": (1, 2), None: (1, 2)}
    assert name in {r[0] for r in tables.table_names(spark).collect()}
    assert tables.run_sql(spark, f"SELECT track_id FROM {name} WHERE genre = :g", {"g": "pop"}).first()[0] == "t1"
    assert tables.as_dicts(spark.table(name).select("track_id").orderBy("track_id"), 1) == [{"track_id": "t1"}]
    spark.sql(f"DROP TABLE {name}")


def test_jdbc_options():
    options = tables.jdbc_options("jdbc:x", "tracks", ["track_id", "energy"], "id", (1, 1000), 8, user="u")
    assert options["dbtable"] == "(SELECT track_id, energy, id FROM tracks) AS source"
    assert options["numPartitions"] == "8" and options["upperBound"] == "1000" and options["user"] == "u"
    assert "numPartitions" not in tables.jdbc_options("jdbc:x", "tracks", ["a"])


def test_metrics(spark, tmp_path):
    path = str(tmp_path / "metrics")
    metrics_store.write_metrics(metrics_store.metric_rows(spark, {"clustering": {"silhouette_score": .4}}), path)
    got = {r["model"]: r for r in metrics_store.read_metrics(spark, path).collect()}
    assert got["clustering"]["value"] == .4 and got["clustering"]["note"] is None
    assert got["similar_songs"]["value"] is None and "no metrics" in got["similar_songs"]["note"]


class _Session:
    """A session as a cluster would set it up."""

    def __init__(self, settings, master="spark://host:7077"):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": lambda self: None})()


def test_scratch_follows_the_session_setting(spark):
    assert scratch_dir(_Session({"spark.checkpoint.dir": "hdfs://shared/x/"}), "rows").startswith("hdfs://shared/x/rows-")
    with pytest.raises(RuntimeError):  # never a machine's own folder on a cluster
        scratch_dir(_Session({}), "rows")
    assert materialise(spark.range(3), "rows").count() == 3


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(20)
    assert "ResolvedHint" in str(small_side(df, 20)._jdf.queryExecution().analyzed())
    assert small_side(df, 19) is df


def test_search_and_listing(spark):
    df = spark.createDataFrame([("1", "Blue Moon", None, "pop", 5), ("2", "Red", "Moonlight", "pop", None), ("3", "nan", "x", "jazz", 9)],
                               "track_id string, track_name string, artist_name string, genre string, popularity int")
    assert [r["track_id"] for r in jobs.search(df, "MOON").collect()] == ["1", "2"]
    assert [r["track_id"] for r in jobs.search(df, "^r.d$").collect()] == ["2"]
    assert jobs.search(df, "^r.d$", regex=False).count() == 0 and jobs.search(df, "m").count() == 0
    assert [r["track_id"] for r in jobs.list_tracks(df, genre="pop").collect()] == ["1", "2"]
    assert [r["track_id"] for r in jobs.list_tracks(df, 1).collect()] == ["3"]


def raw_tracks():
    header = "Unnamed: 0,artist_name,track_name,track_id,genre,popularity,danceability,energy,loudness,liveness,acousticness,instrumentalness,valence,tempo,key,year,duration_ms"
    return header, [f"{i},a{i},t{i},id{i},{'pop' if i % 2 else 'techno'},{i},0.{i % 9 + 1},0.5,-{i},0.1,0.2,0.3,0.{i % 7},1{i % 9}0,{i % 12},2000,{1000 * (i + 1)}" for i in range(40)]


def test_catalogue_job(spark, tmp_path):
    source = tmp_path / "raw.csv"
    header, lines = raw_tracks()
    lines[3] = lines[3].replace("a3", "", 1)
    source.write_text("\n".join([header, *lines]))
    jobs.catalogue_job(spark, str(source), str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 39 and {r[0] for r in out.select("genre").distinct().collect()} == {"POP", "ELECTRONIC"}
    assert "Unnamed: 0" not in out.columns and out.columns[:3] == ["artist_name", "track_name", "track_id"]


def test_catalogue_job_parses_its_source_once(spark, tmp_path, monkeypatch):
    source, kept = tmp_path / "raw.csv", jobs.materialise
    header, lines = raw_tracks()
    source.write_text("\n".join([header, *lines]))

    def then_without_source(df, label):
        out = kept(df, label)
        source.unlink(missing_ok=True)  # whatever reads the file again fails from here on
        return out

    monkeypatch.setattr(jobs, "materialise", then_without_source)
    jobs.catalogue_job(spark, str(source), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40
