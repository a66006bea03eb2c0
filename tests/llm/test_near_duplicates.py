import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from cadenza.llm import shingles as S
from cadenza.llm.components import components
from cadenza.llm.near_duplicates import classes, keep_one, report, weighted_jaccard
from cadenza.session import materialise


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(500, 501), (501, 502), (502, 500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{k: 1 for k in range(1, 40)}, 500: 500, 501: 500, 502: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles_equal_brute_force():
    texts = ["a b c d e f", "a b c d e f a b c d e", "", None, "one two", "é ü  x\ny z\tq", "a b c d e"] * 3 + ["w " * 5000]
    column = pa.array(texts, pa.string())
    sets = [Counter() for _ in texts]
    for at, data, offsets in S.groups(column):
        keys, counts = S.counted(S.shingle_keys(data, offsets))
        for place, h, n in zip(S.place_of(keys), S.hash_of(keys), counts):
            sets[at + place][int(h)] += int(n)
    for i, text in enumerate(texts):
        words = (text or "").split()
        want = Counter(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()
        assert sorted(sets[i].values()) == sorted(want.values())
    assert sets[0] == sets[7] and set(sets[6]) < set(sets[0])


def test_samples_agree_as_often_as_weighted_sets_overlap():
    rng = np.random.default_rng(3)
    hashes = np.sort(rng.integers(0, 1 << 52, 400).astype(np.uint64))
    weight = rng.choice([0.5, 1.0, 2.0, 4.0], 400)
    other = weight.copy()
    other[:100] *= 0.25
    keep = np.arange(400) >= 40
    sampler = S.WeightedSampler(600)
    a = sampler.samples(hashes, np.log(weight), np.array([0]), np.array([400]))[0]
    b = sampler.samples(hashes[keep], np.log(other[keep]), np.array([0]), np.array([360]))[0]
    true = weighted_jaccard((hashes, weight.astype(np.float32)), (hashes[keep], other[keep].astype(np.float32)))
    assert abs((a == b).mean() - true) < 0.07


def family(spark):
    random.seed(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, truth = [], {}
    for f in range(30):
        base = [random.choice(vocabulary) for _ in range(200)]
        for v in range(1 if f % 3 else 4):
            words = list(base)
            if v:
                words[random.randrange(200)] = "changed"
            rows.append((len(rows), " ".join(words)))
            truth[len(rows) - 1] = f
    base = [random.choice(vocabulary) for _ in range(250)]
    for v in range(80):  # variants of one text, each alike to it and less so to one another
        words = list(base)
        for _ in range(4 * bool(v)):
            words[random.randrange(250)] = f"n{random.random()}"
        rows.append((len(rows), " ".join(words)))
        truth[len(rows) - 1] = 99
    return spark.createDataFrame(rows, "doc_id long, text string"), truth


def test_families_are_found_also_in_large_buckets(spark):
    docs, truth = family(spark)
    docs = materialise(docs, "test")
    for small in (16, 2):
        got = {r.doc_id: r.class_id for r in report(classes(docs, small=small)).collect()}
        first = defaultdict(lambda: 10**9)
        for d, f in truth.items():
            first[f] = min(first[f], d)
        assert got == {d: first[f] for d, f in truth.items()}


def test_odd_rows_have_classes_and_one_of_each_stays(documents):
    kept = keep_one(documents)
    assert kept.columns == documents.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter([1, 3, 4, 5, 7, 8, None, 9, 10, 11])  # 2 copies 1, 6 differs from it by three words


def test_no_rows(no_documents):
    assert classes(no_documents).count() == 0 and keep_one(no_documents).count() == 0


def test_families_without_their_original_are_found_in_buckets_that_stay_large(spark):
    """One band only, so a bucket cannot be dealt again: its leader is alike to its own family alone."""
    random.seed(5)
    rows, truth = [], {}
    for f in range(12):
        own = [f"f{f}w{random.random()}" for _ in range(80)]
        for _ in range(4):
            truth[len(rows)] = f
            rows.append((len(rows), " ".join(["same"] * 204 + own + [f"n{random.random()}"])))
    docs = materialise(spark.createDataFrame(rows, "doc_id long, text string"), "test")
    got = {r.doc_id: r.class_id for r in report(classes(docs, bands=1, rows=1, small=2)).collect()}
    first = {}
    for d, f in truth.items():
        first.setdefault(f, d)
    assert got == {d: first[f] for d, f in truth.items()}


def test_texts_that_share_a_passage_do_not_meet_in_pairs(spark, monkeypatch):
    """160 of 200 words in common: below 0.8, all in one bucket; compared pairs stay few while the family doubles."""
    import cadenza.llm.near_duplicates as module

    random.seed(11)
    passage, counted, verified = [f"p{i}" for i in range(160)], [], module.verified
    monkeypatch.setattr(module, "verified", lambda pairs, *rest: counted.append(pairs.count()) or verified(pairs, *rest))
    for members in (100, 200):
        counted.clear()
        rows = [(d, " ".join(passage + [f"o{random.random()}" for _ in range(41)])) for d in range(members)]
        rows += [(members + d, " ".join(passage[:150] + ["twin"] * 20 + [f"o{random.random()}"])) for d in range(2)]
        docs = materialise(spark.createDataFrame(rows, "doc_id long, text string"), "test")
        got = {r.doc_id: r.class_id for r in report(classes(docs, bands=4, rows=1, small=2)).collect()}
        assert got == {d: min(d, members) for d in range(members + 2)}
        assert sum(counted) < 12 * members and counted[-1] < members
