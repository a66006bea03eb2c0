import random
import re
from collections import Counter

from pyspark.sql import functions as F

from cadenza import session
from cadenza.llm.quality_rules import base_counts, judge, keep_good, paired, word_list

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered))


def test_base_counts_equal_brute_force(spark, documents):
    random.seed(5)
    texts = [r.text for r in documents.collect()]
    for _ in range(60):
        vocabulary = ["a", "b", "c#", "dd", "e\n", "é𝄞", "\x0b", "  "]
        texts.append(" ".join(random.choice(vocabulary) for _ in range(random.randint(0, 120))))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string").repartition(3)
    for r in base_counts(df, "text").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text), r.text


def test_odd_rows_fail_the_base_rules(documents):
    judged = {r.doc_id: r for r in judge(documents, documents.select("doc_id").limit(0)).collect()}
    assert judged[3].base_failed and judged[4].base_failed and judged[7].base_failed and not judged[1].base_failed
    assert judged[3].n_words == 0 and judged[3].score == 0.0 and not judged[3].kept
    assert judged[1].score == 0.0 and judged[1].kept  # nothing is trusted, so nothing can be compared


def test_junk_unlike_the_trusted_goes_and_columns_stay(spark):
    random.seed(7)
    vocabulary = [f"w{i}" for i in range(300)]
    clean = [(i, " ".join(random.choice(vocabulary) for _ in range(80))) for i in range(120)]
    junk = [(1000 + i, " ".join(random.choice(vocabulary) + random.choice(["$$$", "%%%", "***"]) for _ in range(80)))
            for i in range(40)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS kept")
    trusted = spark.createDataFrame([(i,) for i in range(60)] + [(0,), (None,)], "doc_id long")
    kept = keep_good(docs, trusted)
    assert kept.columns == ["doc_id", "text", "score", "kept"]
    assert {r.doc_id for r in kept.collect()} == set(range(120))


def test_no_rows(no_documents):
    assert judge(no_documents, no_documents.select("doc_id")).count() == 0


def test_windows_are_hashed_in_steps_of_two(spark):
    """A window of eight takes three hashes of two, not one of eight looked up by place; no text is read character by
    character to count its symbols."""
    random.seed(9)
    words = [str(random.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame([(" ".join(words[:n]),) for n in (0, 1, 2, 4, 7, 8, 9, 400)], "text string")
    df = df.withColumn("h", F.transform(word_list(F.col("text")), lambda w: F.xxhash64(w)))
    hashed = df.withColumn("two", paired("h", 1)).withColumn("four", paired("two", 2)).withColumn("win", paired("four", 4))
    for r in hashed.collect():
        kept = r.text.split()
        windows = [tuple(kept[i:i + 8]) for i in range(len(kept) - 7)]
        assert len(r.win) == len(windows) and len(set(r.win)) == len(set(windows))
        assert len(set(zip(r.win, windows))) == len(set(windows))
    plan = base_counts(df, "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan and plan.count("xxhash64(") <= 12


def test_good_documents_are_not_stored_and_the_filter_holds_no_counts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_dir", lambda spark, label: f"{tmp_path}/{label}")
    docs = spark.createDataFrame([(i, " ".join(f"w{i + j}" for j in range(40))) for i in range(20)], "doc_id long, text string")
    kept = keep_good(docs, docs.select("doc_id"))
    assert kept.count() == 20 and not list(tmp_path.iterdir())
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.split("\n") if "Filter" in line]
    assert filters and not any("regexp" in line or "xxhash64" in line for line in filters)
