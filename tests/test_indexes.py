"""Stored indexes: approximate neighbours, trigram search, point lookups."""

import contextlib
import io
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.functions.scalar import text_matches
from cadenza.operators import lsh, search_index
from cadenza.operators.similar import nearest
from cadenza.sources import lookup_table


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "track_id long, vector array<double>")


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


# --- neighbours ---------------------------------------------------------------------------------


def test_probes_follow_the_distance_to_the_hyperplanes():
    rng = np.random.default_rng(0)
    h = lsh.Hasher.of(2, 5, np.zeros(4), 1)
    margins = h.margins(rng.normal(size=(6, 4)))
    got = h.probes(margins, 32)
    assert (got[:, :, 0] == h.buckets(margins)).all()
    for r in range(6):
        for t in range(2):
            assert sorted(got[r, t]) == list(range(32))
            crossed = got[r, t] ^ got[r, t, 0]
            cost = [sum(margins[r, t, b] ** 2 for b in range(5) if c >> b & 1) for c in crossed]
            assert cost == sorted(cost)


def test_recall_copies_and_blocks(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 12))
    rows = [(i, centres[i % 30] + rng.normal(scale=0.3, size=12)) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(700)]  # a hot vector
    rows += [(5000, np.zeros(12)), (5001, [float("nan")] * 12)]
    df = vectors(spark, rows)
    monkeypatch.setattr(lsh, "BLOCK_ROWS", 50)
    index = lsh.write_index(df, str(tmp_path / "index"), rows_per_bucket=64, most=20)
    assert lsh.read_index(spark, index.path).hasher.planes.tolist() == index.hasher.planes.tolist()
    # of the hot vector only the first 21 ids are kept, so no bucket grows with its copies
    assert index.sizes(spark).agg(F.sum("n")).first()[0] == 8 * (900 + 20 + 1)
    probes, recall = lsh.probes_for(index, df, df, 5)
    assert recall >= 0.95
    got, want = found(lsh.lsh_nearest(index, df, 5, probes, df)), found(nearest(df, df, 5))
    assert set(got) == set(want) and all(len(got[q]) == 5 and q not in got[q] for q in got)
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) >= 0.9
    assert got[1500] == want[1500]  # copies find the copies with the smallest ids


def test_short_lists_are_filled_exactly(spark, tmp_path):
    rng = np.random.default_rng(5)
    df = vectors(spark, [(i, rng.normal(size=6)) for i in range(60)])
    index = lsh.write_index(df, str(tmp_path / "index"), tables=1, rows_per_bucket=2)
    assert any(len(v) < 10 for v in found(lsh.lsh_nearest(index, df, 10, 1)).values())
    got, want = found(lsh.lsh_nearest(index, df, 10, 1, df)), found(nearest(df, df, 10))
    assert {q: len(v) for q, v in got.items()} == {q: 10 for q in want}
    with pytest.raises(ValueError):
        lsh.lsh_nearest(index, df, 101, 1)


def test_empty_index(spark, tmp_path):
    none = vectors(spark, [(1, [1.0, 2.0])]).limit(0)
    index = lsh.write_index(none, str(tmp_path / "index"))
    some = vectors(spark, [(1, [1.0]), (2, [2.0])])
    assert lsh.lsh_nearest(index, none, 3, 1).count() == 0
    assert lsh.lsh_nearest(index, some, 3, 1).count() == 0


# --- text search --------------------------------------------------------------------------------

TEXTS = [
    (1, "Bohemian Rhapsody", "Queen"), (2, "queen of hearts", None), (3, None, "The Kinks"), (4, "", "KISS"),
    (5, "Kaſa İstanbul", "Kiss"), (6, "東京の夜 live", "椎名"), (7, "a.b*c (live)", "x"), (8, "ab", "Elvis"),
    (9, "Été sans fin", "Naïve"), (10, "rhapsody in blue", "G. Gershwin"), (11, "x" * 5000 + "needle", "y"),
]
LITERAL = ["queen", "QUEEN", "iss", "kiss", "live", "東京の", "c (li", "ab", "été", "needle", "istanbul", "İstan", "kasa", "absent", "q"]
REGEX = ["rhaps.dy", "quee?n", "^the k", "live\\)", "queen|kiss", "(rhap)sody", "[kq]i?ss", "elv+is", "x{20,}needle", "東京.夜",
         "ka.a", "gershwin$", "(?i)QUEEN", "rhapsody( in)? blue", "\\.b\\*c"]


@pytest.fixture(scope="module")
def text_index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("search") / "index")
    rows = spark.createDataFrame(TEXTS, "id long, title string, artist string").repartition(3)
    search_index.write_index(rows, path, "id", ["title", "artist"], buckets=16)
    return path, rows


@pytest.mark.parametrize("text,regex", [(t, False) for t in LITERAL] + [(t, True) for t in REGEX])
def test_search_finds_what_a_scan_finds(spark, text_index, text, regex):
    path, rows = text_index
    got = [r["id"] for r in search_index.search(spark, path, text, 50, regex).collect()]
    want = [] if len(text) < 2 else [r["id"] for r in rows.filter(
        text_matches(["title", "artist"], text, regex)).orderBy("id").collect()]
    assert got == want


def test_only_the_buckets_of_the_trigrams_are_read(spark, text_index):
    path, _ = text_index
    text = plan(search_index.candidates(spark, path, ["que", "uee"], 1, 16))
    assert re.search(r"PartitionFilters: .*bucket#", text) and "ReadSchema: struct<gram:string,segment:bigint,deltas:array<int>>" in text
    assert "PushedFilters: [In(gram" in text


def test_runs_that_every_match_contains():
    assert search_index.required_runs(r"ion\s+the") == ["ion", "the"]
    assert search_index.required_runs("colou?r") == ["colo", "r"]
    assert search_index.required_runs("ab+c{2}d") == ["ab", "d"]
    assert search_index.required_runs("x(yz)+w[abc]v") == ["x", "w", "v"]
    for odd in ("a|b", "(?i)abc", r"\x41bc", r"\Qa.b\E", "[a&&b]c", "abc\\"):
        assert search_index.required_runs(odd) == []


def test_many_hits_are_joined_and_lists_cross_segments(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search_index, "LITERALS", 5)
    rows = spark.range(300).select("id", F.concat(F.lit("common words "), F.col("id").cast("string")).alias("title")).repartition(5)
    search_index.write_index(rows, str(tmp_path / "index"), "id", ["title"], buckets=4)
    assert search_index.search(spark, str(tmp_path / "index"), "on wor", 1000, False).count() == 300
    assert [r["id"] for r in search_index.search(spark, str(tmp_path / "index"), "words 299", 9, False).collect()] == [299]
    lists = spark.read.parquet(str(tmp_path / "index" / "postings"))
    assert lists.agg(F.max(F.size("deltas"))).first()[0] <= search_index.SEGMENT and lists.select("segment").distinct().count() > 1


def test_lists_come_from_bounded_numbers_of_characters(monkeypatch):
    """What a task holds and hands on is bounded, and a trigram's places leave it as a list, not as a row each."""
    import pyarrow as pa

    monkeypatch.setattr(search_index, "CHARACTERS", 50)
    texts = ["abcab" * 40, None, "ab", "bca", "東京の夜😀x"] + ["abcd"] * 100
    batch = pa.RecordBatch.from_arrays([pa.array(range(65_530, 65_530 + len(texts))), pa.array(texts)], ["_place", "t0"])
    out = list(search_index._postings([batch]))
    got = {}
    for part in out:
        assert sum(map(len, part.column(2).to_pylist())) <= 50 + 4
        for gram, segment, places in zip(*(c.to_pylist() for c in part.columns)):
            got.setdefault(gram, set()).update(segment * search_index.SEGMENT + p for p in places)
    want = {}
    for place, text in enumerate(texts, 65_530):
        for i in range(len(text or "") - 2):
            want.setdefault(f"0:{text[i:i + 3]}", set()).add(place)
    assert got == want and sum(part.num_rows for part in out) < sum(map(len, want.values()))


def test_a_text_in_pieces_has_each_place_once(spark, tmp_path):
    repeats = 2 * search_index.CHARACTERS // 5 + 1
    rows = spark.createDataFrame([(1, 1), (2, 0)], "id long, n int").select(
        "id", F.expr(f"CASE WHEN n = 1 THEN repeat('abcab', {repeats}) ELSE 'cab' END").alias("title"))
    search_index.write_index(rows, str(tmp_path / "index"), "id", ["title"], buckets=2)
    lists = spark.read.parquet(str(tmp_path / "index" / "postings"))
    assert lists.filter("gram = '0:cab'").agg(F.sum("n")).first()[0] == 2
    assert [r["id"] for r in search_index.search(spark, str(tmp_path / "index"), "bca", 9, False).collect()] == [1]


# --- point lookups ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def lookup_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lookup") / "table")
    rows = spark.range(40_000).select((F.col("id") * 3).alias("key"), F.col("id").alias("value")).unionByName(
        spark.range(5_000).select(F.lit(30).cast("long").alias("key"), (-F.col("id") - 1).alias("value"))).unionByName(
        spark.createDataFrame([(None, 7)], "key long, value long"))
    lookup_table.write_lookup(rows, path, "key", buckets=16)
    return path


def test_few_ids_open_few_files_and_row_groups(spark, lookup_path):
    hits = lookup_table.find(spark, lookup_path, [3, 4, None, 119_997])
    assert sorted(tuple(r) for r in hits.collect()) == [(3, 1), (119_997, 39_999)]
    text = plan(hits)
    assert re.search(r"PartitionFilters: \[.*_bucket#\d+ IN \(", text) and "In(key, [" in text
    scan = hits._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numPartitions").value() <= 3
    assert scan.metrics().apply("numFiles").value() < spark.read.parquet(f"{lookup_path}/rows").inputFiles().__len__()


def test_the_bloom_filter_skips_a_row_group(spark, lookup_path):
    bucket = lookup_table.bucket_of(F.lit(4).cast("long"), 16)
    number = spark.range(1).select(bucket).first()[0]
    rows = spark.read.parquet(f"{lookup_path}/rows").filter(F.col("_bucket") == number)
    read = rows.filter(F.col("key") == 4)  # within the range of the keys, yet in no row group
    low, high = rows.agg(F.min("key"), F.max("key")).first()
    absent = next(k for k in range(low + 1, high) if k % 3)
    read = rows.filter(F.col("key") == absent)
    assert read.count() == 0
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = rows.filter(F.col("key") == absent)
        read.collect()
        scan = read._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().apply("numOutputRows").value() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_hot_key_many_ids_and_missing(spark, lookup_path, monkeypatch):
    assert lookup_table.find(spark, lookup_path, [30]).count() == 5_001
    ids = spark.range(0, 3_000, 2).select(F.col("id").alias("key"))
    many = lookup_table.find(spark, lookup_path, ids)
    assert many.columns == ["key", "value"] and many.count() == 500 + 5_000
    gone = lookup_table.missing(spark, lookup_path, spark.createDataFrame([(3,), (4,), (4,)], "key long"))
    assert [r[0] for r in gone.collect()] == [4]


def test_text_keys(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "`odd key` string, _x int")
    lookup_table.write_lookup(rows, str(tmp_path / "t"), "odd key")
    got = lookup_table.find(spark, str(tmp_path / "t"), ["b", "c"])
    assert sorted(r["_x"] for r in got.collect()) == [2, 3]


def test_a_query_travels_once_to_a_region_and_leaves_with_its_best():
    rng = np.random.default_rng(3)
    probed = np.array([[rng.choice(16, 5, replace=False) for _ in range(2)] for _ in range(7)])
    rows, tables, buckets, starts = lsh._asks(probed, 2)
    told = list(zip(rows[starts], tables[starts], buckets[starts] >> 2))
    assert len(told) == len(set(told)) == len({(r, t, b >> 2) for r in range(7) for t in range(2) for b in probed[r, t]})
    vectors, queries = rng.integers(-2, 3, (60, 4)).astype(float), rng.integers(-2, 3, (7, 4)).astype(float)
    held, at, asked = rng.integers(0, 20, 60), rows[tables == 0], buckets[tables == 0]
    for pairs in (1, 10, 10_000):
        got = list(zip(*(x.tolist() for x in lsh._bucket_pairs(queries, at, asked, vectors, held, 3, 9, pairs))))
        want = []
        for q in range(7):
            scored = [(-float(queries[q] @ vectors[j]), j) for j in range(60) if held[j] in probed[q, 0]]
            want += [(q, j, -s) for s, j in sorted(scored)[:3]]
        assert got == want
    assert lsh._region_shift(600_000, 12) == 9 and lsh._region_shift(5, 1) == 1 and lsh._region_shift(0, 3) == 3
