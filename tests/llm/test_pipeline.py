"""The pipeline, stage by stage, against what its operators do alone."""

import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from cadenza.session import materialise, scratch_dir


@pytest.fixture(scope="module")
def folder(spark, documents):
    path = scratch_dir(spark, "pipeline-test")
    documents.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0), (6, 1, 0), (9, 1, 0), (11, 0, 0), (None, 1, 0)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_hand_on_documents_and_the_last_packs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, folder), "pipeline-test")
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns, name
    good = {r.doc_id for r in seen["quality_rules"]}
    assert {1, 2, 6} <= good and not good & {3, 4, 5, 7, 8, 11}
    assert Counter(r.doc_id for r in seen["line_dedup"]) == Counter(r.doc_id for r in seen["quality_rules"])
    lines = Counter(x for r in seen["line_dedup"] for x in (r.text or "").split("\n") if re.search(r"\S", x))
    assert all(n == 1 for n in lines.values())
    assert all(r.n_chars == len(r.text) for r in seen["line_dedup"])
    kept = Counter(r.doc_id for r in seen["near_dedup"])
    assert set(kept) <= good and max(kept.values()) == 1 and 1 in kept
    assert set(r.doc_id for r in seen["mixing"]) <= set(kept)
    sequences = defaultdict(int)
    for r in seen["packing"]:
        sequences[r.sequence_id] += r.length
    assert sequences and max(sequences.values()) <= 2048


def test_run_on_an_empty_corpus_gives_no_rows(spark, no_documents):
    path = scratch_dir(spark, "pipeline-test")
    no_documents.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    out = corpus_pipeline.run(spark, path)
    assert out.count() == 0 and out.columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_stage_order_is_the_dealt_one():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
