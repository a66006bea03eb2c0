import zlib
from collections import defaultdict

from cadenza.llm.sharding import least_loaded, shard_documents


def test_least_loaded_is_the_textbook_schedule():
    placed = least_loaded([(7, "a"), (6, "b"), (5, "c"), (4, "d"), (3, "e")], 2)
    loads = defaultdict(int)
    for size, key in [(7, "a"), (6, "b"), (5, "c"), (4, "d"), (3, "e")]:
        loads[placed[key]] += size
    assert sorted(loads.values()) == [11, 14] and placed["a"] != placed["b"]


def test_every_row_has_a_slot_and_equal_texts_stay_together(documents):
    rows = shard_documents(documents, 3).collect()
    assert len(rows) == documents.count()
    texts = {(r.doc_id, r.text) for r in documents.collect()}
    by_text, by_shard = defaultdict(set), defaultdict(list)
    for r in rows:
        text = next(t for i, t in texts if i == r.doc_id)
        assert r["size"] == len((text or "").encode()) + 1
        assert r.text_crc32 == (None if text is None else zlib.crc32(text.encode()))
        by_text[text].add(r.shard)
        by_shard[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_sizes_are_nearly_equal_and_runs_agree(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat(md5(cast(id AS string)), cast(1 + id % 40 AS int)) AS text")
    first, second = (shard_documents(docs, 8).orderBy("doc_id").toPandas() for _ in range(2))
    loads = first.groupby("shard")["size"].sum()
    assert len(loads) == 8 and loads.max() - loads.min() <= 2000
    assert first.equals(second)


def test_one_group_above_a_shard_stays_whole(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, repeat('copy ', 50), concat('t', id)) AS text")
    p = shard_documents(docs, 4).toPandas().merge(docs.toPandas(), on="doc_id")
    assert p[p.doc_id % 3 == 0].shard.nunique() == 1


def test_no_rows(no_documents):
    assert shard_documents(no_documents, 8).count() == 0
