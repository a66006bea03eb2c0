"""Ids that a double cannot hold, beside a missing one, and ids that are text."""

import pytest

from cadenza.llm.packing import pack_documents
from cadenza.llm.queries import tokenizer_path
from cadenza.llm.token_counts import count_tokens
from cadenza.llm.warc import payload_report, read_archives, write_archives
from cadenza.session import materialise, scratch_dir

BIG = 9007199254740993
ROWS = [(BIG, "one two three"), (None, "no id"), (BIG + 2, "four\nfive"), (-BIG, None)]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_ids_stay_as_they_are(spark, kind):
    rows = ROWS if kind == "long" else [(None if i is None else f"d{i}", t) for i, t in ROWS]
    docs = materialise(spark.createDataFrame(rows, f"doc_id {kind}, text string").coalesce(1), "wide")
    ids = {i for i, _ in rows}
    packed = pack_documents(docs, tokenizer_path())
    assert {r["doc_id"] for r in packed.collect()} == ids and packed.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    counted = count_tokens(docs, tokenizer_path())
    assert {r["doc_id"] for r in counted.collect()} >= ids - {rows[3][0]}
    assert counted.schema["doc_id"].dataType == docs.schema["doc_id"].dataType


def test_page_ids_stay_as_they_are(spark):
    long = "x" * 1500
    pages = materialise(spark.createDataFrame([(i, "u", t) for i, t in ROWS] + [(BIG + 4, "u", long), (BIG + 6, "u", long)],
                                              "page_id long, url string, html string").coalesce(1), "pages")
    path = scratch_dir(spark, "wide-warc")
    write_archives(pages, path)
    found = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in payload_report(read_archives(spark, path)).collect()}
    assert found == {BIG: ("response", None), None: ("response", None), BIG + 2: ("response", None), -BIG: ("response", None),
                     BIG + 4: ("revisit", BIG + 6), BIG + 6: ("response", None)}
