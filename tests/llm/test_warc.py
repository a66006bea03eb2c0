import gzip
import hashlib

import pytest

from cadenza.llm import warc
from cadenza.session import scratch_dir


def rows(spark, html):
    return spark.createDataFrame(html, "page_id long, url string, html string").selectExpr(
        "*", "1 AS digest", "2 AS row").repartition(2).cache()


CASES = [
    (1, "http://a", "short"), (2, "http://b", "short"), (3, None, None), (4, "http://d\nx", ""),
    (5, "u", "é𝄞" * 3000), (6, "u", "é𝄞" * 3000), (7, "u", "é𝄞" * 3000), (8, "u", "y" * 999), (9, "u", "y" * 999),
    (10, "u", "a\r\n\r\nWARC/1.1\r\n" * 200), (None, "u", "no id " * 300), (11, "u", "z" * 100_000),
    (12, "u", "twice " * 400), (12, "u", "twice " * 400),
]


def test_round_trip_equals_brute_force(spark):
    pages, path = rows(spark, CASES), scratch_dir(spark, "warc-test")
    warc.write_archives(pages, path, archive_records=5)
    found = warc.read_archives(spark, path).collect()
    assert len(found) == len(CASES)
    by_id = {r.record_id: r for r in found}
    top = {}
    for p, _, h in CASES:
        if len((h or "").encode()) >= 1000:
            top[h] = max(top.get(h, -1), p if p is not None else -1)
    for p, url, h in CASES:
        mine = [r for r in found if r.page_id == p]
        payload = (h or "").encode()
        assert all(r.digest == hashlib.sha1(payload).hexdigest() for r in mine)
        if p == 12:
            assert sorted(r.type for r in mine) == ["response", "revisit"]
        elif len(payload) >= 1000 and p is not None and top[h] != p:
            assert mine[0].type == "revisit" and by_id[mine[0].refers_to].page_id == top[h] and mine[0].payload is None
        else:
            assert mine[0].type == "response" and bytes(mine[0].payload) == payload
        assert all(r.url == (None if url is None else url.replace("\n", "%0A")) for r in mine)
    report = {r.page_id: r for r in warc.payload_report(warc.read_archives(spark, path)).collect()}
    assert report[5].payload_bytes == len(("é𝄞" * 3000).encode()) and report[5].refers_to == 7
    assert report[12].refers_to in (12, None) and report[3].payload_bytes == 0


def test_archives_are_warc_files_with_segments(spark):
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(rows(spark, CASES), path, segment_bytes=4000)
    text = b"".join(gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect())
    assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
    assert b"WARC-Type: continuation" in text and b"WARC-Segment-Total-Length" in text
    assert len(list(warc.records_of(text))) > len(CASES)


def test_chunked_framing_round_trip():
    for payload in (b"", b"x", "é𝄞".encode() * 5000, b"\r\n0\r\n\r\n" * 900):
        assert warc.unchunked(warc.chunked(payload, 7)) == payload
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_a_missing_segment_is_an_error(spark):
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(rows(spark, [(1, "u", "q" * 50_000)]), path)
    text = b"".join(gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect())
    records = text.split(b"\r\n\r\nWARC/1.1")
    lost = b"\r\n\r\nWARC/1.1".join(records[:2] + records[3:]).decode().removesuffix("\r\n\r\n")
    broken = scratch_dir(spark, "warc-test")
    spark.createDataFrame([(lost,)], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(broken)
    with pytest.raises(Exception, match="segments"):
        warc.read_archives(spark, broken).collect()


def test_no_pages(spark):
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(rows(spark, [(1, "u", "h")]).limit(0), path)
    assert warc.read_archives(spark, path).count() == 0


def test_registered_query_agrees_with_its_sql_where_payloads_repeat(spark, tmp_path):
    import duckdb

    from cadenza.llm.queries import ORACLE, op10_warc

    rows = [(1, "u", "x" * 1000), (2, "u", "x" * 1000), (9007199254740993, "v", "x" * 1000), (3, None, "é" * 500), (4, "w", "é" * 500),
            (5, "w", "x" * 999), (6, "w", "x" * 999), (7, "w", None), (8, "w", ""), (9, "y", "\r\n" * 900)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    columns = "page_id, payload_bytes, payload_digest, record_type, refers_to"
    got = sorted(tuple(r) for r in op10_warc(spark, str(tmp_path)).selectExpr(*columns.split(", ")).collect())
    base = duckdb.connect()
    base.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(base.execute(f"SELECT {columns} FROM ({ORACLE['op10_warc']})").fetchall())
    assert [r[3] for r in got].count("revisit") == 3
