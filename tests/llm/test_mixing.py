import re

import pytest

from cadenza.llm.mixing import cycled_weights, mix, mix_counts, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_targets_share_the_excess():
    assert targets({"a": 100, "b": 100}, {"a": 1, "b": 1}) == {"a": 100.0, "b": 100.0}
    got = targets({"a": 10, "b": 100, "c": 100}, {"a": 5, "b": 2, "c": 1})
    assert got["a"] == 30.0 and got["b"] == pytest.approx(120) and got["c"] == pytest.approx(60)
    assert targets({"a": 0, "b": 8}, {"a": 5, "b": 2}) == {"a": 0.0, "b": 8.0}


def test_weights_go_round_by_code_point_with_null_last():
    assert cycled_weights(["b", None, "a", "ä"]) == {"a": 5, "b": 2, "ä": 1, None: 5}


def test_rows_sizes_and_bounds(documents):
    rows = mix_counts(documents).collect()
    source = {r.doc_id: (r.text, r.source) for r in documents.collect()}
    sizes, total = {}, 0
    for r in documents.collect():
        n = len(WORD.findall(r.text or ""))
        sizes[r.source] = sizes.get(r.source, 0) + n
        total += n
    aims = targets(sizes, cycled_weights(list(sizes)))
    assert len(rows) == documents.count() and sum(aims.values()) == pytest.approx(min(total, sum(aims.values())))
    for r in rows:
        text, of = source[r.doc_id]
        assert r["size"] == len(WORD.findall(text or "")) and r.source_size == sizes[of]
        assert r.target == pytest.approx(aims[of]) and r.taken == r["copies"] * r["size"] and r["copies"] <= 3


def test_taken_words_come_near_the_targets_and_runs_agree(spark):
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "repeat('word ', cast(1 + id % 97 AS int)) AS text", "concat('s', if(id % 3 = 0, 0, id % 7)) AS source")
    first = mix_counts(docs).toPandas().sort_values("doc_id").reset_index(drop=True)
    second = mix_counts(docs.repartition(7)).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert first.equals(second)
    by = first.assign(source=docs.toPandas().sort_values("doc_id").source.values).groupby("source")
    assert (abs(by.taken.sum() / by.target.first() - 1) < 0.01).all()


def test_mix_emits_the_counted_copies_with_the_input_columns(documents):
    counts = {r.doc_id: r["copies"] for r in mix_counts(documents).collect()}
    out = mix(documents)
    assert out.columns == documents.columns
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    rows = {r.doc_id: 0 for r in documents.collect()}
    for r in documents.collect():
        rows[r.doc_id] += counts[r.doc_id]
    assert got == {k: n for k, n in rows.items() if n}


def test_no_rows(no_documents):
    assert mix_counts(no_documents).count() == 0 and mix(no_documents).count() == 0
