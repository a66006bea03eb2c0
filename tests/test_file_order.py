"""Positions in files against the files themselves and against DuckDB's reading of them."""

import duckdb
import pytest
from pyspark.sql import functions as F

from cadenza.session import materialise
from cadenza.sources.file_order import (
    first_rows, ids_in_order, in_file_order, keep_first_in_file, load_upload_in_order, read_csv_in_order)


@pytest.fixture()
def folder(tmp_path):
    lines = [f"k{(i * 7) % 40},{i}" for i in range(5000)]
    for n, (a, b) in enumerate([(0, 3000), (3000, 3000), (3000, 3001), (3001, 5000)]):
        (tmp_path / f"part-{n}.csv").write_text("key,n\n" + "".join(x + "\n" for x in lines[a:b]))
    return str(tmp_path)


@pytest.fixture()
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_positions_are_those_of_the_files_in_many_splits(spark, folder, small_splits):
    read = read_csv_in_order(spark, folder)
    assert spark.read.csv(folder).rdd.getNumPartitions() > 8
    got = read.select(F.col("position") - 1, F.col("n").cast("int")).collect()
    assert len(got) == 5000 and all(a == b for a, b in got)


def test_first_rows_and_keep_first_equal_duckdb(spark, folder, small_splits):
    read = materialise(read_csv_in_order(spark, folder), "test")
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t AS SELECT *, row_number() OVER () AS p FROM read_csv('{folder}/*.csv', header=true)")
    assert sorted(tuple(r) for r in first_rows(read, 7).selectExpr("key", "int(n)", "position").collect()) == sorted(
        con.execute("SELECT key, n, p FROM t WHERE p <= 7").fetchall())
    want = con.execute("SELECT key, arg_min(n, p), min(p) FROM t GROUP BY key").fetchall()
    got = keep_first_in_file(read, ["key"]).selectExpr("key", "int(n)", "position").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
    ids = ids_in_order(read, "id", "custom_").filter("n = 4321").first()
    assert ids["id"] == "custom_4321"


def test_odd_files(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text("file,start,at,c0\n1,2,3,4\n\n1,2,3,4\nNA,,x,y\n")  # names the operator uses, a blank line, copies
    got = read_csv_in_order(spark, str(path)).orderBy("position").collect()
    assert [tuple(r) for r in got] == [("1", "2", "3", "4", 1), ("1", "2", "3", "4", 2), (None, None, "x", "y", 3)]
    (tmp_path / "none.csv").write_text("a,b\n")
    assert read_csv_in_order(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "clash.csv").write_text("position,b\n1,2\n")
    with pytest.raises(ValueError):
        in_file_order(spark.read.option("header", True).csv(str(tmp_path / "clash.csv")))


def test_upload_keeps_the_first_row_of_an_id_and_numbers_rows_without(spark, tmp_path):
    path = tmp_path / "with_ids.csv"
    path.write_text("track_id;tempo\nb;9\na;5\nb;1\na;7\n")
    got = {r.track_id: r.tempo for r in load_upload_in_order(spark, str(path), ["tempo"]).collect()}
    assert got == {"b": 9.0, "a": 5.0}
    path = tmp_path / "without.csv"
    path.write_text("tempo,energy\n3,1\n2,1\n3,1\n")
    got = {r.track_id: r.tempo for r in load_upload_in_order(spark, str(path), ["tempo", "energy"]).collect()}
    assert got == {"custom_0": 3.0, "custom_1": 2.0, "custom_2": 3.0}
