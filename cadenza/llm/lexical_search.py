"""Ranked lexical search: a hybrid of term-at-a-time and document-at-a-time evaluation over blocks of documents.

Terms are runs of letters, digits and characters beyond ASCII, A to Z in lower case. One scan keeps, for each document,
its number of terms and the counts of those terms that some query holds; document frequencies come from what was kept.
Every task then reads its documents in blocks of bounded size, inverts a block into lists in the order of document ids,
and answers each query on it:

1. Term at a time: the shortest lists, together at most ``ACCUMULATED`` of the block's documents, are summed into
   accumulators, sorted by document. They are one list from here on.
2. Document at a time: the accumulators and each long list carry their largest value per ``SKIP`` documents. Going up the
   documents, a run in which these bounds add up to less than the query's worst kept score is skipped; the others are
   scored in full. The kept scores go on from block to block, so later blocks skip more.

A task emits its ``k`` best per query; these are ranked once more per query, cut per task before the shuffle. Queries are
answered in blocks of bounded bytes, so neither the driver nor a task holds more than a block of them.

Score: with N documents that hold a term, L terms in all of them and n in one, its m is 100-90+((90*n*N) div L); a term of
weight w = floor(1000*ln((2*N+2)/(2*df+1))) occurring tf times adds w*((1000000000*tf) div (1000*tf+8*m)).

Defined results: NULL and empty texts have no terms; such items have no rows, such documents are never found and do not
count. A term that a query repeats counts once. Equal scores go by ascending id, NULL ids last. Repeated rows are ranked
each by itself, repeated items answered each by itself. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import narrow, stored

BLOCK_DOCUMENTS = 1 << 14
BLOCK_POSTINGS = 1 << 21
QUERY_BYTES = 1 << 22
ACCUMULATED = 0.25
SKIP = 256
RUN = 16 * SKIP
#: Every byte that is part of no term becomes a space; A to Z become a to z; bytes from 0x80 on stay.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_TERM_BYTES).split() if text else []


def postings(vocabulary):
    """A function for ``mapInArrow``: (row, doc_id, text as binary) becomes (row, doc_id, n, terms, counts) of documents
    with a term; ``terms`` are places in the broadcast vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = vocabulary.value
        for batch in batches:
            size, ids, counts = [], [], []
            for text in batch.column(2):
                words = terms(text.as_py())
                found = Counter(w for w in words if w in place)
                size.append(len(words))
                ids.append(np.array([place[w] for w in found], dtype=np.int32).tobytes())
                counts.append(np.array(list(found.values()), dtype=np.int32).tobytes())
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(counts, pa.binary())], ["row", "doc_id", "n", "terms", "counts"])
            yield out.filter(pc.greater(out.column(2), 0))

    return run


def term_frequencies(size: int):
    """A function for ``mapInArrow``: per task, in how many documents each term occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total[np.frombuffer(ids.as_buffer(), dtype=np.int32)] += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], ["term", "df"])

    return run


class Lists:
    """The inverted lists of one block of documents, which are in the order of their ids."""

    def __init__(self, documents: int, term: np.ndarray, document: np.ndarray, value: np.ndarray, size: int):
        order = np.argsort(term, kind="stable")
        self.documents, self.document, self.value = documents, document[order], value[order]
        self.edges = np.searchsorted(term[order], np.arange(size + 1))
        self.cuts = np.arange(0, documents + SKIP, SKIP)
        self._bounds: dict[int, tuple] = {}

    def bounded(self, document: np.ndarray, value: np.ndarray):
        """A list with where each ``SKIP`` documents begin in it and the largest value there."""
        starts = np.searchsorted(document, self.cuts)
        best = np.zeros(len(starts) - 1, dtype=np.int64)
        full = np.flatnonzero(np.diff(starts))
        if len(full):
            best[full] = np.maximum.reduceat(value, starts[full])
        return document, value, starts, best

    def of(self, t: int):
        if t not in self._bounds:
            a, b = self.edges[t], self.edges[t + 1]
            self._bounds[t] = self.bounded(self.document[a:b], self.value[a:b])
        return self._bounds[t]

    def split(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The query's terms with short lists, and the others."""
        length = self.edges[query + 1] - self.edges[query]
        query, length = query[length > 0], length[length > 0]
        order = np.argsort(length, kind="stable")
        query, length = query[order], length[order]
        short = np.cumsum(length) <= ACCUMULATED * self.documents
        return query[short], query[~short]

    def accumulators(self, short: np.ndarray):
        """The sums of the short lists as one list."""
        spans = [slice(self.edges[t], self.edges[t + 1]) for t in short]
        document = np.concatenate([self.document[s] for s in spans])
        value = np.concatenate([self.value[s] for s in spans])
        order = np.argsort(document, kind="stable")
        document, value = document[order], value[order]
        first = np.flatnonzero(np.concatenate([[True], document[1:] != document[:-1]]))
        return self.bounded(document[first], np.add.reduceat(value, first))

    def best(self, query: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the best ``k`` documents of at least ``floor``; equal scores by place."""
        short, long = self.split(query)
        every = ([self.accumulators(short)] if len(short) else []) + [self.of(t) for t in long]
        places, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        if not every:
            return places, scores
        bound = reduce(np.add, [x[3] for x in every])
        blocks, step = len(bound), RUN // SKIP
        at = 0
        while at < blocks:
            if bound[at] < floor:
                at += 1
                continue
            end = at + 1
            while end < min(blocks, at + step) and bound[end] >= floor:
                end += 1
            low, high = at * SKIP, min(end * SKIP, self.documents)
            total = np.zeros(high - low, dtype=np.int64)
            for document, value, starts, _ in every:
                a, b = starts[at], starts[end]
                total[document[a:b] - low] += value[a:b]
            hit = np.flatnonzero(total >= floor)
            if len(hit):
                places, scores = np.concatenate([places, hit + low]), np.concatenate([scores, total[hit]])
                order = np.lexsort((places, -scores))[:k]
                places, scores = places[order], scores[order]
                if len(scores) == k:
                    floor = max(floor, int(scores[-1]))
            at = end
        return places, scores


def answers(shared, documents: int, length: int, k: int):
    """A function for ``mapInArrow``: (row, doc_id, n, terms, counts) becomes the task's best (query, doc_id, row, score).
    ``shared`` holds the weights of the terms and the term places of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, queries = shared.value
        kept: list[list] = [[] for _ in queries]
        id_type = None

        def search(block: pa.Table) -> None:
            # NULL ids come last
            block = block.take(pc.sort_indices(block, sort_keys=[("doc_id", "ascending")], null_placement="at_end"))
            block = block.combine_chunks()
            n = block["n"].to_numpy()
            m = 100 - 90 + (90 * n * documents) // length
            term = np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.int32) for x in block["terms"]])
            tf = np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.int32) for x in block["counts"]]).astype(np.int64)
            sizes = [len(x.as_buffer()) // 4 for x in block["terms"]]
            document = np.repeat(np.arange(len(n)), sizes)
            value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[document]))
            lists = Lists(len(n), term, document, value, len(weight))
            for q, query in enumerate(queries):
                floor = -kept[q][-1][0] if len(kept[q]) == k else 1
                for place, score in zip(*lists.best(query, k, max(1, floor))):
                    id = block["doc_id"][int(place)].as_py()
                    kept[q].append((-int(score), id is None, id, block["row"][int(place)].as_py()))
                kept[q] = sorted(kept[q])[:k]

        waiting, rows, held = [], 0, 0
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                waiting.append(part)
                rows += part.num_rows
                held += sum(len(x.as_buffer()) for x in part.column(3)) // 4
                if rows >= BLOCK_DOCUMENTS or held >= BLOCK_POSTINGS:
                    search(pa.Table.from_batches(waiting))
                    waiting, rows, held = [], 0, 0
        if waiting and rows:
            search(pa.Table.from_batches(waiting))
        flat = [(q, *x) for q, best in enumerate(kept) for x in best]
        if flat:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in flat], pa.int32()), pa.array([x[3] for x in flat], id_type),
                 pa.array([x[4] for x in flat], pa.int64()), pa.array([-x[1] for x in flat], pa.int64())],
                ["query", "doc_id", "row", "score"])

    return run


def query_blocks(items: DataFrame, max_bytes: int) -> Iterator[list[tuple]]:
    """The items (item, text as binary) in blocks of about ``max_bytes``; one block at a time is on the driver."""
    block, size = [], 0
    for r in items.toLocalIterator():
        block.append((r["item"], sorted(set(terms(bytes(r["text"]))))))
        size += len(r["text"])
        if size >= max_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    read = narrow(docs, doc_id=id, text=text).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    asked = stored(narrow(items, item_id=item_id, text=item_text).select(
        F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").cast("string").cast("binary").alias("text")),
        "search-items")
    id_type = docs.schema[id].dataType.simpleString()
    found = None
    for block in query_blocks(asked.filter("text is not null").select("item", "text"), query_bytes):
        vocabulary = {w: i for i, w in enumerate(sorted({w for _, words in block for w in words}))}
        if not vocabulary:
            continue
        lists = stored(read.mapInArrow(postings(spark.sparkContext.broadcast(vocabulary)),
                                       f"row long, doc_id {id_type}, n long, terms binary, counts binary"), "search-lists")
        documents, length = lists.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            continue
        weight = np.zeros(len(vocabulary), dtype=np.int64)
        for r in lists.select("terms").mapInArrow(term_frequencies(len(vocabulary)), "term int, df long").groupBy(
                "term").agg(F.sum("df").alias("df")).collect():
            weight[r["term"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * r["df"] + 1)))
        queries = [np.array([vocabulary[w] for w in words], dtype=np.int64) for _, words in block]
        shared = spark.sparkContext.broadcast((weight, queries))
        best = lists.mapInArrow(answers(shared, documents, length, k),
                                f"query int, doc_id {id_type}, row long, score long")
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], "query int, item long")
        part = stored(best.join(F.broadcast(names), "query").select("item", "doc_id", "row", "score"), "search-best")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return asked.select("item_id", F.lit(1).alias("rank"), F.lit(None).cast(id_type).alias("doc_id"),
                            F.lit(0).cast("long").alias("score")).limit(0)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
