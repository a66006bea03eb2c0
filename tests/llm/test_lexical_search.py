import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cadenza.llm.lexical_search import SKIP, Lists, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k):
    """{place of the item: [(score, doc_id), ...]} by the definition."""
    words = {i: TERM.findall(t.translate(LOWER)) for i, (_, t) in enumerate(docs) if t}
    words = {i: w for i, w in words.items() if w}
    n, length = len(words), sum(map(len, words.values()))
    counts = {i: Counter(w) for i, w in words.items()}
    df = Counter(w for c in counts.values() for w in c)
    out = defaultdict(list)
    for q, (_, text) in enumerate(items):
        for i, c in counts.items():
            m = 100 - 90 + (90 * len(words[i]) * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(TERM.findall((text or "").translate(LOWER))) if c[t])
            if score > 0:
                out[q].append((-score, docs[i][0] is None, docs[i][0] or 0))
        out[q] = [(-s, None if none else d) for s, none, d in sorted(out[q])[:k]]
    return {q: v for q, v in out.items() if v}


def answer(spark, docs, items, k, **options):
    found = search(spark.createDataFrame(docs, "doc_id long, text string"),
                   spark.createDataFrame(items, "item_id long, text string"), k, **options).collect()
    out = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["item_id"], r["rank"])):
        out[r["item_id"]].append((r["score"], r["doc_id"]))
        assert r["rank"] == len(out[r["item_id"]])
    return dict(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_against_sums(seed):
    rng = np.random.default_rng(seed)
    documents, size = 7 * SKIP + 13, 40
    term, document = np.nonzero(rng.random((size, documents)) < (rng.random(size) ** 3)[:, None])
    value = rng.integers(1, 30, len(term))
    lists = Lists(documents, term, document, value, size)
    table = np.zeros((size, documents), dtype=np.int64)
    table[term, document] = value
    for _ in range(30):
        query = rng.choice(size, 9, replace=False)
        total = table[query].sum(axis=0)
        order = [int(i) for i in np.lexsort((np.arange(documents), -total)) if total[i] > 0][:10]
        for floor in (1, int(total[order[-1]])):
            places, scores = lists.best(query, 10, floor)
            assert list(places) == [i for i in order if total[i] >= floor] and list(scores) == [total[i] for i in places]


def test_against_definition_with_odd_rows(spark, documents):
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    items = [(0, "alpha0 Beta BETA epsilon4 füße"), (1, None), (2, ""), (3, "x line one is"), (4, "𝄞 naïve FÜSSE Füße"), (5, "absent")]
    assert answer(spark, docs, items, 3) == brute(docs, items, 3)
    assert answer(spark, docs, items, 3, query_bytes=1) == brute(docs, items, 3)  # one item a block


def test_many_copies_keep_the_smallest_ids(spark):
    docs = [(i, "alpha beta gamma") for i in range(500, 0, -1)] + [(None, "alpha beta gamma"), (0, "alpha")]
    items = [(7, "beta alpha")]
    assert answer(spark, docs, items, 10) == {7: brute(docs, items, 10)[0]}


def test_text_ids_repeated_items_and_empty_tables(spark, no_documents):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one two")], "doc_id string, text string")
    items = spark.createDataFrame([(1, "one"), (1, "one")], "item_id long, text string")
    rows = search(docs, items, 2).orderBy("rank").collect()
    assert [(r["rank"], r["doc_id"]) for r in rows] == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    assert search(no_documents, items, 2).count() == 0
    assert search(docs, items.limit(0), 2).count() == 0
    big = 9007199254740993
    docs = spark.createDataFrame([(big, "one"), (None, "one")], "doc_id long, text string")
    assert [r["doc_id"] for r in search(docs, items.limit(1), 5).orderBy("rank").collect()] == [big, None]
