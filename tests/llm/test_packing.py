import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cadenza.llm.encoding import Encoder
from cadenza.llm.packing import (
    best_configuration, configurations, large_places, linear_groups, pack, pack_documents, small_places,
)
from cadenza.llm.token_counts import count_tokens
from cadenza.session import materialise

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "\n", "a  b", " a b ", "a\n b", "a.\n\n b", "a\n\n\nb", "\n\na", "word.\n", "word.\n\n", "'tis it's\nwe've",
       "a <|endoftext|> b<|endoftext|>c", "é 　 z'll 12 3", "tab\tand\x0bmore \x85 x", "a\r\nb c\r\n", "x" * 5000,
       "1a2 b3.5,6", "𝄞 𝄞𝄞 ñ", "…wait… \"quoted\" (and) [more] - done — yes", "a.\n\nB c..., d_e f$$$\ng"]


def test_cut_encoding_equals_whole_encoding():
    random.seed(2)
    texts = list(ODD)
    for _ in range(400):
        texts.append("".join(random.choice(["a", "Bc", " ", " ", "\n", ".", "'s", "9", "é", "$", "\t", "…"])
                             for _ in range(random.randint(0, 40))))
    whole = Tokenizer.from_file(PATH)
    encoder = Encoder(PATH)
    for _ in range(2):  # the second time from the store
        for text, ids in zip(texts, encoder.encode_all(texts)):
            assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_known_parts_are_looked_up_once():
    class Counted(dict):
        asked = again = 0

        def get(self, key):
            self.asked += 1
            return super().get(key)

        def __getitem__(self, key):
            self.again += 1
            return super().__getitem__(key)

    encoder, texts = Encoder(PATH), ["one two, three\nfour " * 20 + "end", "two three one."]
    first = [ids.tolist() for ids in encoder.encode_all(texts)]
    encoder.new = store = Counted(encoder.new)
    assert [ids.tolist() for ids in encoder.encode_all(texts)] == first
    assert (store.asked, store.again) == (sum(len(encoder.parts(t)) for t in texts), 0)


def test_groups_and_configurations_cover_every_item():
    random.seed(4)
    histogram = Counter(random.randint(257, 2048) for _ in range(3000))
    groups = linear_groups(histogram, 20)
    assert sum(g[2] for g in groups) == 3000 and len(groups) <= 20
    sizes, counts = [g[1] for g in groups], [g[2] for g in groups]
    total = np.zeros(len(sizes), dtype=int)
    for times, column in configurations(sizes, counts, 2048):
        assert column @ np.array(sizes) <= 2048
        total += times * column
    assert total.tolist() == counts
    assert best_configuration([3, 5], np.array([0.4, 0.7]), 11).tolist() in ([2, 1],)
    places, sequences = large_places(groups, 2048)
    assert sequences >= sum(k * n for k, n in histogram.items()) / 2048


def test_small_items_fill_rooms_exactly_once():
    random.seed(6)
    rooms = Counter(random.randint(0, 300) for _ in range(200))
    lengths = Counter(random.randint(1, 256) for _ in range(900))
    used = defaultdict(int)
    per_length = defaultdict(list)
    for length, low, high, cls, first, per in small_places(rooms, lengths, 2048):
        per_length[length].append((low, high))
        for r in range(low, high):
            used[cls, first + (r - low) // per] += length
    for length, spans in per_length.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == lengths[length]
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert all(n <= (2048 if cls == -1 else cls) for (cls, _), n in used.items())
    assert all(rank < rooms[cls] for cls, rank in used if cls >= 0)


def check_packing(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for items in by.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pack_is_close_to_the_lower_bound(spark):
    random.seed(8)
    lengths = [min(2048, int(random.lognormvariate(6, 1.2)) + 1) for _ in range(4000)]
    pieces = materialise(spark.createDataFrame(list(enumerate(lengths)), "at long, length long").repartition(4), "test")
    rows = pack(pieces).collect()
    assert sorted(r.at for r in rows) == list(range(4000))
    assert check_packing(rows, 2048) <= sum(lengths) / 2048 * 1.05 + 2


def test_documents_are_cut_and_packed_whole(documents):
    whole = Tokenizer.from_file(PATH)
    rows = pack_documents(documents, PATH).collect()
    check_packing(rows, 2048)
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    texts = defaultdict(list)
    for r in documents.collect():
        texts[r.doc_id].append(r.text or "")
    for doc, mine in by.items():
        ids = np.array(whole.encode(texts[doc][0], add_special_tokens=False).ids + [0], dtype="<u4")
        copies = len(texts[doc])
        assert sum(r.length for r in mine) == copies * len(ids)
        for r in mine:
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
            assert r.length == 2048 or r.piece == 0


def test_token_counts_equal_offsets(documents):
    whole = Tokenizer.from_file(PATH)
    rows = defaultdict(list)
    for r in count_tokens(documents.dropDuplicates(["doc_id"]), PATH).collect():
        rows[r.doc_id].append(r)
    for d in documents.dropDuplicates(["doc_id"]).collect():
        text = d.text or ""
        starts = [0] + [i + 1 for i, c in enumerate(text) if c == "\n"]
        want = [0] * len(starts)
        for a, _ in whole.encode(text, add_special_tokens=False).offsets:
            want[max(i for i, s in enumerate(starts) if s <= a)] += 1
        mine = sorted(rows[d.doc_id], key=lambda r: r.section)
        assert [r.start for r in mine] == starts and [r.n_tokens for r in mine] == want


def test_token_counts_of_given_spans_and_rules(spark):
    text = "abcdefgh internationalisation"
    docs = spark.createDataFrame([(1, text, [0, 12], [12, 20]), (2, text, None, None), (3, None, [0], [0])],
                                 "doc_id long, text string, s array<int>, e array<int>")
    total = len(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids)
    for rule in ("first", "most"):
        got = defaultdict(dict)
        for r in count_tokens(docs, PATH, starts="s", ends="e", rule=rule).collect():
            got[r.doc_id][r.section] = r.n_tokens
        assert sum(got[1].values()) == total and got[2] == {-1: total} and got[3] == {0: 0}


def test_no_rows(no_documents):
    assert pack_documents(no_documents, PATH).count() == 0 and count_tokens(no_documents, PATH).count() == 0
