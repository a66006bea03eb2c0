import pytest

from cadenza.sources.mixed_files import read_mixed


def test_each_file_is_read_in_its_own_format(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("\ufeffid;name;Genre\n1;Füße;pop\n\n2;\"a;b \"\"c\"\"\";NA\n".encode())
    (tmp_path / "b.csv").write_bytes("name,id\nCafé,3\nplain,4\nshort\n".encode("latin-1"))
    (tmp_path / "c.tsv").write_bytes("ID\tgenre\textra\n5\trock\tä\n".encode())
    (tmp_path / "d.csv").write_bytes(b"\n  \n")
    (tmp_path / "e.csv").write_bytes(b"id;name;name;\n6;x;y;z\n")
    got = read_mixed(spark, str(tmp_path), file_column="file")
    assert got.columns == ["ID", "genre", "extra", "name", "_c2", "_c3", "file"]  # as the headers come by code point
    rows = {(r["ID"] or r["name"]): r.asDict() for r in got.collect()}
    assert set(rows) == {"1", "2", "3", "4", "5", "6", "short"} and got.count() == 7
    assert (rows["1"]["name"], rows["1"]["genre"]) == ("Füße", "pop") and rows["1"]["file"].endswith("a.csv")
    assert rows["2"]["name"] == 'a;b "c"' and rows["2"]["genre"] is None
    assert rows["3"]["name"] == "Café" and rows["4"]["extra"] is None
    assert (rows["5"]["extra"], rows["5"]["genre"]) == ("ä", "rock")
    assert (rows["6"]["name"], rows["6"]["_c2"], rows["6"]["_c3"]) == ("x", "y", "z")


def test_headers_are_found_in_many_splits(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        for n, sep in enumerate(",;\t"):
            (tmp_path / f"{n}.csv").write_text(f"id{sep}v\n" + "".join(f"{n * 2000 + i}{sep}{i}\n" for i in range(2000)))
        rows = read_mixed(spark, str(tmp_path)).selectExpr("int(id)", "int(v)").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 6000 and all(r["id"] % 2000 == r["v"] for r in rows) and len({r["id"] for r in rows}) == 6000


def test_no_lines_and_zero_bytes(spark, tmp_path):
    (tmp_path / "empty.csv").write_bytes(b"")
    none = read_mixed(spark, str(tmp_path / "empty.csv"))
    assert none.columns == [] and none.count() == 0
    (tmp_path / "wide.csv").write_bytes("a,b\n1,2\n".encode("utf-16"))
    with pytest.raises(ValueError):
        read_mixed(spark, str(tmp_path / "wide.csv"))
