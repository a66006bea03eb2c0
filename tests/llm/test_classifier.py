import random
import zlib

from cadenza.llm.classifier import classify


def test_scores_held_out_rows_well(spark):
    random.seed(11)
    vocabulary = [f"wort{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(900):
        good = i % 4 != 0
        words = [random.choice(vocabulary) for _ in range(random.randint(30, 200))]
        text = " ".join(words) + "." if good else " ".join(w + random.choice(["$$$", "%%"]) for w in words)
        rows.append((i, text))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = spark.createDataFrame(labels + [(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in classify(docs, told).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out == (i in set(held)) for i in range(900))
    assert sum(got[i].predicted == dict(labels)[i] for i in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_odd_rows_are_scored_and_one_class_is_constant(documents, spark):
    labels = spark.createDataFrame([(1, 1), (9, 1)], "doc_id long, quality int")
    rows = classify(documents, labels).collect()
    assert len(rows) == documents.count() and {r.score for r in rows} <= {0.5, 1.0}
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)], "doc_id long, quality int")
    rows = classify(documents, labels).collect()
    assert all(r.score is not None and 0 <= r.score <= 1 for r in rows)
    assert next(r for r in rows if r.doc_id is None).held_out is False


def test_no_rows(no_documents, spark):
    assert classify(no_documents, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
