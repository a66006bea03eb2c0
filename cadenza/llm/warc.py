"""WARC archives: writing with deduplicated payloads, reading back with reassembly of segmented records.

Writing: a page becomes an HTTP response in chunked transfer framing, inside a WARC record. Blocks above
``SEGMENT_BYTES`` are cut into a first record and continuation records, which may land in other archives. Of records
with equal payloads of at least ``MIN_REVISIT_BYTES`` the one with the largest id stays a response, the others become
revisit records without payload. Archives are compressed text files written by Spark (records end with two line ends,
which is the separator between lines here), so they go wherever Spark writes. Each holds at most ``ARCHIVE_RECORDS``
records of bounded size; nothing is shuffled to write them.

Reading: archives are parsed file by file; continuation records are grouped by origin id, ordered by segment number and
joined; missing segments, a wrong total length or a wrong digest raise an error that names the record. Then the chunked
framing is removed. Only segmented records are shuffled. A group is one record, so it is as large as one page and no larger.

Defined results: NULL html is an empty payload, NULL url and NULL id leave their header out. Empty payloads are responses
with 0 bytes. Of repeated rows with the largest id, one stays the response (a row number decides). An empty table gives
one empty archive and no records. Extra columns are not written.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import checked_broadcast, narrow, stored

MIN_REVISIT_BYTES = 1000
CHUNK_BYTES = 4096
SEGMENT_BYTES = 8192
ARCHIVE_RECORDS = 4096
RECORD_DATE = "2024-01-01T00:00:00Z"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def cut(data: bytes, size: int) -> list[bytes]:
    """Pieces of at most ``size`` bytes that end between characters, so that archives stay valid UTF-8."""
    pieces, at = [], 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        pieces.append(data[at:end])
        at = end
    return pieces


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    return b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in cut(payload, size)) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        n = int(body[at:line].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        out.append(body[line + 2:line + 2 + n])
        if len(out[-1]) != n or body[line + 2 + n:line + 4 + n] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        at = line + 4 + n


def record_id(row: int, segment: int = 1) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(b'%d/%d' % (row, segment)).digest(), version=4)}>"


def record(fields: dict, block: bytes) -> str:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n" + block.decode("utf-8")


def to_records(segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES):
    """A function for ``mapInPandas``: pages become record texts."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for p in batch.itertuples(index=False):
                url = None if p.url is None else p.url.replace("\r", "%0D").replace("\n", "%0A")
                common = {"WARC-Date": RECORD_DATE, "WARC-Target-URI": url,
                          "X-Page-Id": p.page_id}
                first = {"WARC-Record-ID": record_id(p.row), **common, "Content-Type": "application/http;msgtype=response",
                         "WARC-Payload-Digest": f"sha1:{p.digest}"}
                if not pd.isna(p.refers_row):
                    out.append(record(
                        {"WARC-Type": "revisit", **first, "WARC-Profile": REVISIT_PROFILE,
                         "WARC-Refers-To": record_id(int(p.refers_row))}, HTTP_HEAD))
                    continue
                block = HTTP_HEAD + chunked(p.payload, chunk_bytes)
                parts = cut(block, segment_bytes)
                if len(parts) == 1:
                    out.append(record({"WARC-Type": "response", **first}, block))
                    continue
                out.append(record({"WARC-Type": "response", **first, "WARC-Segment-Number": 1}, parts[0]))
                for k, part in enumerate(parts[1:], 2):
                    out.append(record({
                        "WARC-Type": "continuation", "WARC-Record-ID": record_id(p.row, k), **common,
                        "WARC-Segment-Origin-ID": record_id(p.row), "WARC-Segment-Number": k,
                        "WARC-Segment-Total-Length": len(block) if k == len(parts) else None}, part))
                if len(out) >= 1000:
                    yield pd.DataFrame({"value": out})
                    out = []
            yield pd.DataFrame({"value": out})

    return write


def write_archives(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html",
                   min_revisit_bytes: int = MIN_REVISIT_BYTES, segment_bytes: int = SEGMENT_BYTES,
                   archive_records: int = ARCHIVE_RECORDS) -> None:
    """Write every page as WARC records into new files under ``path``.

    ``pages`` is read twice, first for sizes and digests only, and must give the same rows in the same partitions, as a
    stored table does.
    """
    read = narrow(pages, page_id=id, url=url, html=html).select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
        F.monotonically_increasing_id().alias("row")).withColumn("digest", F.sha1("payload"))
    sized = stored(read.filter(F.octet_length("payload") >= min_revisit_bytes).select("page_id", "row", "digest"),
                   "warc-sizes")
    copied = sized.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("page_id", "row")).alias("top")).filter(
        "n > 1").select("digest", F.col("top.row").alias("refers_row"))
    again = stored(sized.join(copied, "digest").filter("row <> refers_row").select("row", "refers_row"), "warc-revisits")
    decided = read.join(checked_broadcast(again), "row", "left").withColumn(
        "payload", F.when(F.col("refers_row").isNull(), F.col("payload")))
    # numbers are text in pandas, which would turn them into floating point beside a NULL
    decided.select("row", F.col("page_id").cast("string").alias("page_id"), "url", "payload", "digest",
                   F.col("refers_row").cast("string").alias("refers_row")).mapInPandas(
        to_records(segment_bytes), "value string").write.option("lineSep", RECORD_END).option(
        "compression", "gzip").option("maxRecordsPerFile", archive_records).text(path)


FIELDS = ("WARC-Record-ID", "WARC-Type", "X-Page-Id", "WARC-Target-URI", "WARC-Payload-Digest", "WARC-Refers-To",
          "WARC-Segment-Origin-ID", "WARC-Segment-Number", "WARC-Segment-Total-Length")
PARSED = ("record_id string, type string, page_id string, url string, digest string, refers_to string, origin string, "
          "segment int, total long, block binary")


def records_of(data: bytes) -> Iterator[tuple]:
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        n = int(head["Content-Length"])
        block = data[end + 4:end + 4 + n]
        if len(block) != n or data[end + 4 + n:end + 8 + n] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        at = end + 8 + n
        v = [head.get(f) for f in FIELDS]
        number = lambda x: None if x is None else int(x)
        yield (v[0], v[1], v[2], v[3], v[4], v[5], v[6], number(v[7]), number(v[8]), block)


def parse_files(segmented: bool):
    """A function for ``mapInPandas``: contents of archives become their records, either the segmented or the others."""
    names = [c.split()[0] for c in PARSED.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                out = []
                for r in records_of(data):
                    if (r[7] is not None) == segmented:
                        out.append(r)
                    if len(out) >= 500:
                        yield pd.DataFrame(out, columns=names, dtype=object)
                        out = []
                yield pd.DataFrame(out, columns=names, dtype=object)

    return run


def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Join the blocks of each record, check them and take off the HTTP head and the chunked framing."""
    for batch in batches:
        sizes, digests, payloads = [], [], []
        for r in batch.itertuples(index=False):
            numbers, blocks = [p["segment"] for p in r.parts], [p["block"] for p in r.parts]
            block = b"".join(bytes(b) for b in blocks)
            if numbers != list(range(1, len(numbers) + 1)):
                raise ValueError(f"{r.record_id}: segments {numbers}")
            if (len(numbers) > 1) != (not pd.isna(r.total)) or len(numbers) > 1 and len(block) != int(r.total):
                raise ValueError(f"{r.record_id}: {len(block)} bytes in {len(numbers)} segments, not {r.total}")
            if r.type == "revisit":
                sizes.append(None)
                digests.append(r.digest.removeprefix("sha1:"))
                payloads.append(None)
                continue
            head, body = block.split(b"\r\n\r\n", 1)
            payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
            digest = hashlib.sha1(payload).hexdigest()
            if f"sha1:{digest}" != r.digest:
                raise ValueError(f"{r.record_id}: the payload does not have its digest")
            sizes.append(len(payload))
            digests.append(digest)
            payloads.append(payload)
        yield pd.DataFrame({
            "record_id": batch["record_id"], "type": batch["type"], "page_id": batch["page_id"], "url": batch["url"],
            "refers_to": batch["refers_to"], "digest": digests, "bytes": pd.Series(sizes, dtype="Int64"),
            "payload": pd.Series(payloads, dtype=object)})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record: ``record_id``, ``type``, ``page_id``, ``url``, ``refers_to`` (record
    id), ``digest``, ``bytes`` and ``payload`` (NULL for revisits)."""
    files = spark.read.format("binaryFile").load(path).select("content")
    part = F.struct(F.coalesce("segment", F.lit(1)).alias("segment"), "block")
    head = F.struct("type", "page_id", "url", "digest", "refers_to")
    whole = files.mapInPandas(parse_files(False), PARSED).select(
        "record_id", head.alias("head"), "total", F.array(part).alias("parts"))
    cut_up = files.mapInPandas(parse_files(True), PARSED).groupBy(F.coalesce("origin", "record_id").alias("record_id")).agg(
        F.first(F.when(F.col("origin").isNull(), head), ignorenulls=True).alias("head"), F.max("total").alias("total"),
        F.sort_array(F.collect_list(part)).alias("parts"))
    return whole.unionByName(cut_up).select(
        "record_id", "head.type", "head.page_id", "head.url", "head.digest", "head.refers_to", "total", "parts"
    ).mapInPandas(decode, "record_id string, type string, page_id string, url string, refers_to string, digest string, "
                          "bytes long, payload binary").withColumn("page_id", F.col("page_id").cast("long"))


def payload_report(records: DataFrame) -> DataFrame:
    """Per record: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to`` (the page of
    the response); revisits take the size from the response they refer to."""
    rows = stored(records.drop("payload", "url"), "warc-records")
    responses = rows.filter("type = 'response'").select(
        F.col("record_id").alias("of"), F.col("page_id").alias("of_page"), F.col("bytes").alias("of_bytes"))
    plain = rows.filter("type = 'response'").select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    again = rows.filter("type = 'revisit'").join(responses, F.col("refers_to") == F.col("of"), "left").select(
        "page_id", F.col("of_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("of_page").alias("refers_to"))
    return plain.unionByName(again)
