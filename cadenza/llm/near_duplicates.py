"""Near-duplicate documents: consistent weighted samples of TF-IDF shingles, banded, verified by weighted Jaccard.

1. Every text becomes its five-word shingles. Document frequencies are counted over all documents in ``2**18`` hash
   buckets (the usual bounded form of TF-IDF); a shingle's weight is its count times ln(1 + N / (N + df)). The smoothing
   is strong on purpose: shingles of a family of thousands of variants are frequent just because of the family, and a
   steeper weight would push its members, alike at 0.8 or more, apart.
2. ``BANDS`` bands of ``ROWS`` improved consistent weighted samples: texts of similarity 0.8 share a band with a chance
   of 99.8 %. Equal texts are one node from here on.
3. Candidates grow with the number of members of a band bucket, not with its square. First, in each bucket everyone
   meets the leader (the member with the most company over all its bands, so the original among its variants). Where a
   bucket then holds members of several classes, members of different classes meet: everyone with everyone in buckets up
   to ``SMALL``; in larger ones everyone meets a leader of the next class. Members of large buckets that hold several
   classes even then get the prefix filter, whole: with shingles in one order for all, the rarest among these members
   first, two texts of similarity s have a first common shingle, and from there on each holds s / (1 + s) of both total
   weights. So only members of different classes that share such a shingle are compared. Texts that share a long passage
   and nothing else never meet, and no pair that shares a band is left out.
4. Candidates are verified on their whole shingle sets; links of similarity ``MIN_SIMILARITY`` or more are closed to
   classes.

Texts and sets never gather by bucket: sets are fetched for nodes that have a candidate, one row each.

Defined results: texts without words are alike only if equal; NULL texts are one class, apart from the empty text. A text
of one to four words is a single shingle. Documents without company are their own class. Repeated rows and ids are
members of their class each. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import shingles as S
from cadenza.llm.common import checked_broadcast, stored
from cadenza.llm.components import components

BANDS = 12
ROWS = 4
SMALL = 16
BLOCK = 1024
#: Bits of the buckets in which the order of shingles is counted.
ORDER_BITS = 20
MIN_SIMILARITY = 0.8


def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: in how many texts each hash bucket occurs."""
    total = np.zeros(1 << S.BUCKET_BITS, dtype=np.int64)
    for batch in batches:
        for _, data, offsets in S.groups(batch.column(0)):
            keys, _ = S.counted(S.shingle_keys(data, offsets))
            bucket = S.bucket_of(S.hash_of(keys))
            seen, _ = S.counted(np.sort((S.place_of(keys) << S.BUCKET_BITS) | bucket))
            total += np.bincount(seen & ((1 << S.BUCKET_BITS) - 1), minlength=len(total))
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], ["bucket", "n"])


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of each bucket, over all rows of the single column of ``texts``."""
    rows = texts.mapInArrow(frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(1 << S.BUCKET_BITS)
    df[rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.float64)
    documents = texts.count()
    return np.log(1 + max(documents, 1) / (max(documents, 1) + np.minimum(df, documents))).astype(np.float32)


def weighted(data: np.ndarray, offsets: np.ndarray, idf: np.ndarray):
    """Distinct shingle keys of a group of texts and their weights."""
    keys, count = S.counted(S.shingle_keys(data, offsets))
    return keys, (count * idf[S.bucket_of(S.hash_of(keys))]).astype(np.float32)


def sketches(idf, bands: int, rows: int):
    """A function for ``mapInArrow``: (text, row, k1, k2) becomes (row, k1, k2, total, b0, b1, ...)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, table = S.WeightedSampler(bands * rows), idf.value
        names = ["row", "k1", "k2", "total", *[f"b{i}" for i in range(bands)]]
        for batch in batches:
            n = batch.num_rows
            total, values, has = np.zeros(n), np.zeros((bands, n), dtype=np.int64), np.zeros(n, dtype=bool)
            for at, data, offsets in S.groups(batch.column(0)):
                keys, weight = weighted(data, offsets, table)
                if not len(keys):
                    continue
                place = S.place_of(keys)
                starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
                owners = at + place[starts]
                got = sampler.samples(S.hash_of(keys), np.log(weight), starts, np.diff(np.append(starts, len(keys))))
                total[owners] = np.add.reduceat(weight.astype(np.float64), starts)
                has[owners] = True
                for b in range(bands):
                    band = got[:, b * rows].copy()
                    for r in range(1, rows):
                        band = S.mixed(band * np.uint64(3) + got[:, b * rows + r])
                    values[b, owners] = band.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), batch.column(3), pa.array(total),
                 *[pa.array(values[b], mask=~has) for b in range(bands)]], names)

    return run


def sets(idf):
    """A function for ``mapInArrow``: (text, node) becomes (node, hashes, weights), sorted, as binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for batch in batches:
            for at, data, offsets in S.groups(batch.column(0)):
                keys, weight = weighted(data, offsets, table)
                hashes, n = S.hash_of(keys), len(offsets) - 1
                cuts = np.searchsorted(S.place_of(keys), np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(at, n),
                     pa.array([hashes[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                     pa.array([weight[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())],
                    ["node", "hashes", "weights"])

    return run


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    (ha, wa), (hb, wb) = a, b
    if len(ha) > len(hb):
        (ha, wa), (hb, wb) = b, a
    if not len(ha):
        return 0.0
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    same = hb[at] == ha
    both = float(np.minimum(wa[same], wb[at[same]]).sum(dtype=np.float64))
    return both / (float(wa.sum(dtype=np.float64)) + float(wb.sum(dtype=np.float64)) - both)


def similarities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, hashes and weights of both) becomes (a, b, similarity)."""
    for batch in batches:
        out = []
        for ha, wa, hb, wb in zip(*[batch.column(i) for i in range(2, 6)]):
            out.append(weighted_jaccard(
                (np.frombuffer(ha.as_buffer(), np.uint64), np.frombuffer(wa.as_buffer(), np.float32)),
                (np.frombuffer(hb.as_buffer(), np.uint64), np.frombuffer(wb.as_buffer(), np.float32))))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())],
                                         ["a", "b", "similarity"])


def order_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: in how many sets each bucket of shingles occurs."""
    total = np.zeros(1 << ORDER_BITS, dtype=np.int64)
    for batch in batches:
        for hashes in batch.column(0):
            places = np.frombuffer(hashes.as_buffer(), np.uint64) >> np.uint64(S.BITS - ORDER_BITS)
            total[np.unique(places).astype(np.int64)] += 1
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], ["bucket", "n"])


def prefixes(counts, min_similarity: float):
    """A function for ``mapInArrow``: (node, hashes, weights) becomes (node, shingle, rest, total) for the shingles that can
    be the first one in common with a text alike enough. ``rest`` is the weight from this shingle on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for batch in batches:
            for node, hashes, weights in zip(*[batch.column(i) for i in range(3)]):
                h = np.frombuffer(hashes.as_buffer(), np.uint64)
                w = np.frombuffer(weights.as_buffer(), np.float32).astype(np.float64)
                order = np.lexsort((h, table[(h >> np.uint64(S.BITS - ORDER_BITS)).astype(np.int64)]))
                rest = np.cumsum(w[order][::-1])[::-1]
                keep = int(np.count_nonzero(rest >= (min_similarity - 1e-6) * w.sum()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(keep, node.as_py(), np.int64)), pa.array(h[order[:keep]].view(np.int64)),
                     pa.array(rest[:keep]), pa.array(np.full(keep, w.sum()))], ["node", "shingle", "rest", "total"])

    return run


def alike_in_size(x: str, y: str):
    """Whether two total weights allow the similarity at all."""
    return F.least(x, y) >= (MIN_SIMILARITY - 1e-6) * F.greatest(x, y)


def leaders_of(members: DataFrame) -> DataFrame:
    """Of each bucket the leader: of the largest class there, the one with the most company."""
    return members.groupBy("bucket").agg(F.max(F.struct(
        "class_size", "company", (-F.col("node")).alias("minus"), "total", "class")).alias("top")).select(
        "bucket", (-F.col("top.minus")).alias("leader"), F.col("top.total").alias("leader_total"),
        F.col("top.class").alias("leader_class"))


def with_leader(members: DataFrame, next_class: bool = False) -> DataFrame:
    """Pairs ``a`` < ``b``: every member of a bucket with its leader, if they are of different classes; with
    ``next_class`` the leader is one of those that are not of the first leader's class. ``members`` has ``bucket``,
    ``node``, ``total``, ``company``, ``class`` and ``class_size``."""
    leaders = leaders_of(members)
    if next_class:
        leaders = leaders_of(members.join(leaders, "bucket").filter("class <> leader_class").select(*members.columns))
    return members.join(leaders, "bucket").filter(
        (F.col("class") != F.col("leader_class")) & alike_in_size("total", "leader_total")).select(
        F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))


def with_each_other(members: DataFrame, small: int) -> DataFrame:
    """Pairs ``a`` < ``b`` of members of different classes in buckets up to ``small``."""
    few = members.filter(F.col("n") <= small).select("bucket", "node", "total", "class")
    other = few.toDF("of", "b", "b_total", "b_class")
    return few.join(other, (F.col("bucket") == F.col("of")) & (F.col("node") < F.col("b")) & (
        F.col("class") != F.col("b_class")) & alike_in_size("total", "b_total")).select(F.col("node").alias("a"), "b")


def rest_of_pairs(members: DataFrame, texts: DataFrame, keyed: DataFrame, idf, min_similarity: float) -> DataFrame:
    """Pairs ``a`` < ``b`` of ``members`` (``node``, ``class``) of different classes that the prefix filter leaves.

    A shingle's members are dealt to blocks of about ``BLOCK`` on one side and go to every block on the other.
    """
    nodes = stored(members.groupBy("node").agg(F.first("class").alias("class")), "near-rest")
    shingled = sets_of(nodes, texts, keyed, idf)
    counts = np.zeros(1 << ORDER_BITS, dtype=np.int64)
    rows = shingled.select("hashes").mapInArrow(order_counts, "bucket int, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toPandas()
    counts[rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    order = members.sparkSession.sparkContext.broadcast(counts)
    heads = stored(shingled.select("node", "hashes", "weights").mapInArrow(
        prefixes(order, min_similarity), "node long, shingle long, rest double, total double").join(nodes, "node"), "near-heads")
    shared = heads.groupBy("shingle").agg(F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias(
        "high")).filter("low <> high").select("shingle", "n")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = stored(heads.join(shared, "shingle"), "near-heads")
    one = placed.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).drop("n")
    other = placed.select(F.col("shingle").alias("of"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("of_block"),
                          F.col("node").alias("b"), F.col("rest").alias("b_rest"), F.col("total").alias("b_total"),
                          F.col("class").alias("b_class"))
    enough = (min_similarity - 1e-6) / (1 + min_similarity)
    return one.join(other, (F.col("shingle") == F.col("of")) & (F.col("block") == F.col("of_block")) & (
        F.col("node") < F.col("b")) & (F.col("class") != F.col("b_class")) & (
        F.least("rest", "b_rest") >= enough * (F.col("total") + F.col("b_total")))).select(F.col("node").alias("a"), "b")


def in_classes(members: DataFrame, parts: DataFrame) -> DataFrame:
    """``members`` of buckets that hold several classes, with ``class`` and ``class_size``."""
    sizes = parts.groupBy("component").agg(F.count("*").alias("class_size"))
    known = parts.join(sizes, "component")
    placed = stored(members.join(known, "node", "left").withColumn("class", F.coalesce("component", "node")).withColumn(
        "class_size", F.coalesce("class_size", F.lit(1))).drop("component"), "near-placed")
    mixed = placed.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter(
        "low <> high").select("bucket")
    return stored(placed.join(mixed, "bucket", "left_semi"), "near-mixed")


def with_company(rows: DataFrame) -> DataFrame:
    """Rows ``bucket``, ``node``, ``total`` in buckets of two or more, with the bucket's size ``n`` and the node's
    ``company``: the sum of the sizes of its buckets."""
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    shared = stored(rows.join(sizes, "bucket"), "near-shared")
    company = shared.groupBy("node").agg(F.sum("n").alias("company"))
    return stored(shared.join(company, "node"), "near-members")


def sets_of(nodes: DataFrame, texts: DataFrame, keyed: DataFrame, idf) -> DataFrame:
    """``node``, ``hashes``, ``weights`` of the distinct ``nodes``, from whole texts.

    ``texts`` has ``node``, ``k1``, ``k2``, ``row``; ``keyed`` the documents with ``text``, ``row``, ``k1``, ``k2``.
    """
    wanted = stored(texts.select("node", "row", "k1", "k2").join(nodes.select("node"), "node"), "near-wanted")
    fetched = keyed.join(checked_broadcast(wanted), ["row", "k1", "k2"]).select("text", "node")
    return stored(fetched.mapInArrow(sets(idf), "node long, hashes binary, weights binary"), "near-sets")


def verified(pairs: DataFrame, texts: DataFrame, keyed: DataFrame, idf, min_similarity: float) -> DataFrame:
    """``a``, ``b``, ``similarity`` of the pairs at or above the bound."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    shingled = sets_of(nodes, texts, keyed, idf)
    left = shingled.select(F.col("node").alias("a"), F.col("hashes").alias("ha"), F.col("weights").alias("wa"))
    right = shingled.select(F.col("node").alias("b"), F.col("hashes").alias("hb"), F.col("weights").alias("wb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ha", "wa", "hb", "wb")
    return stored(joined.mapInArrow(similarities, "a long, b long, similarity double").filter(
        F.col("similarity") >= min_similarity), "near-links")


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS,
            min_similarity: float = MIN_SIMILARITY, small: int = SMALL) -> DataFrame:
    """One row per document: ``row`` (its place in the scan of ``docs``, which must be stored), ``doc_id``, ``node``
    (its text) and ``class`` (a node of its class)."""
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    keyed = read.withColumn("row", F.monotonically_increasing_id()).withColumns(
        {"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(7), "text")})
    idf = spark.sparkContext.broadcast(inverse_frequencies(read.select("text")))
    names = [f"b{i}" for i in range(bands)]
    schema = "row long, k1 long, k2 long, total double, " + ", ".join(f"{b} long" for b in names)
    sketch = stored(keyed.select("text", "row", "k1", "k2").mapInArrow(sketches(idf, bands, rows), schema), "near-sketch")
    texts = stored(sketch.groupBy("k1", "k2").agg(
        F.min("row").alias("row"), F.max("total").alias("total"), *[F.max(b).alias(b) for b in names]).withColumn(
        "node", F.monotonically_increasing_id()), "near-texts")
    banded = texts.select("node", "total", F.explode(F.array(*[F.xxhash64(F.lit(i), b) for i, b in enumerate(names)]))
                          .alias("bucket")).filter("total > 0")
    members = with_company(banded)
    alone = members.withColumn("class", F.col("node")).withColumn("class_size", F.lit(1).cast("long"))

    def more(links: DataFrame | None, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = verified(stored(pairs.distinct(), "near-pairs"), texts, keyed, idf, min_similarity)
        found = found if links is None else links.unionByName(found)
        return found, components(found)

    links, parts = more(None, with_leader(alone))
    mixed = in_classes(members, parts)
    if mixed.limit(1).count():
        few, many = with_each_other(mixed, small), with_leader(mixed.filter(F.col("n") > small), next_class=True)
        links, parts = more(links, few.unionByName(many))
        # smaller buckets have had all of their pairs
        rest = in_classes(mixed.filter(F.col("n") > small).drop("class", "class_size"), parts)
        if rest.limit(1).count():
            links, parts = more(links, rest_of_pairs(rest, texts, keyed, idf, min_similarity))
    named = texts.select("node", "k1", "k2").join(parts, "node", "left").select(
        "node", "k1", "k2", F.coalesce("component", "node").alias("class"))
    ids = keyed.select("row", "doc_id")
    return sketch.select("row", "k1", "k2").join(named, ["k1", "k2"]).drop("k1", "k2").join(ids, "row")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each class: the one with the smallest id, NULL ids last, then the first row. Input columns stay."""
    inner = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    data = stored(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()]), "near-docs")
    found = stored(classes(data, inner[id], inner[text], **options), "near-classes")
    best = found.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best")).select(
        F.col("best.row").alias("row"))
    return data.withColumn("row", F.monotonically_increasing_id()).join(checked_broadcast(
        stored(best, "near-kept")), "row", "left_semi").select(*[F.col(n).alias(c) for c, n in inner.items()])


def report(found: DataFrame) -> DataFrame:
    """``doc_id``, ``class_id`` (smallest id of the class) and ``class_size`` (documents)."""
    sizes = found.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return found.join(sizes, "class").select("doc_id", "class_id", "class_size")
