"""A stored search index: character trigrams with delta-coded posting lists.

Every row of a table gets a place. For each trigram of a searched column, in one case, the index holds the places of the
rows that have it, in segments of ``SEGMENT`` places: a list is bounded however frequent its trigram is. Lists are sorted
and hold differences. Posting files lie in a folder per hash bucket of the trigram, so a search reads only the buckets
of its own trigrams, intersects their lists, rarest first, and runs the exact test on the rows that are left.

A regular expression is searched by the runs of characters that every match must contain. A query without a usable
trigram is answered by the exact test on all rows. The rows are the same as those of a scan in every case.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.scalar import text_matches

SEGMENT = 1 << 16
BUCKETS = 64
GRAM = 3
#: So many characters are cut into trigrams at once: a task's memory does not depend on its texts.
CHARACTERS = 1 << 20
#: So many candidate places are pushed to the scan as literals; more are joined.
LITERALS = 1_000
_ABOUT = "key string, columns array<string>, buckets int"


def folded(text: Column) -> Column:
    """One case for letters that a case-insensitive match may take for another."""
    return F.lower(F.translate(text, "ſİıK", "siik"))


def _postings(batches):
    """(place, folded texts …) becomes (gram, segment, places): the rows of a bounded number of characters that have a
    trigram, which is marked with the number of its column. Texts beyond that number come in pieces that overlap."""
    import pyarrow as pa

    for batch in batches:
        row_places = batch.column(0).to_numpy()
        for c in range(1, batch.num_columns):
            texts, rows, held = [], [], 0
            for row, value in enumerate(batch.column(c)):
                text = value.as_py() or ""
                for start in range(0, max(0, len(text) - GRAM + 1), CHARACTERS):
                    piece = text[start:start + CHARACTERS + GRAM - 1]
                    texts.append(piece)
                    rows.append(row)
                    held += len(piece)
                    if held >= CHARACTERS:
                        yield _listed(texts, row_places[rows], c - 1, pa)
                        texts, rows, held = [], [], 0
            if texts:
                yield _listed(texts, row_places[rows], c - 1, pa)


def _listed(texts, places, column, pa):
    """One batch (gram, segment, places) of some texts, whose places ascend. Every text has a trigram."""
    import numpy as np

    sizes = np.array([len(t) for t in texts])
    letters = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    codes = letters[:-2] << 42 | letters[1:-1] << 21 | letters[2:]
    ends = np.cumsum(sizes)
    inside = np.ones(len(codes) + 2, dtype=bool)  # trigrams that cross from one text into the next are none
    inside[ends - 1] = inside[ends - 2] = False
    inside = inside[:len(codes)]
    owner = np.repeat(np.arange(len(texts)), sizes)[:len(codes)][inside]
    grams, number = np.unique(codes[inside], return_inverse=True)
    pairs = np.unique(number * len(texts) + owner)
    gram, place = pairs // len(texts), places[pairs % len(texts)]
    fresh = np.ones(len(pairs), dtype=bool)  # two pieces of one text may have the same trigram
    fresh[1:] = (gram[1:] != gram[:-1]) | (place[1:] != place[:-1])
    gram, place = gram[fresh], place[fresh]
    segment = place // SEGMENT
    first = np.concatenate([[True], (gram[1:] != gram[:-1]) | (segment[1:] != segment[:-1])]).nonzero()[0]
    spelled = np.stack([grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF], axis=1).astype("<u4").tobytes().decode("utf-32-le")
    named = [f"{column}:{spelled[GRAM * g:GRAM * g + GRAM]}" for g in gram[first]]
    offsets = np.append(first, len(place)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array((place % SEGMENT).astype(np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(named, pa.string()), pa.array(segment[first]), lists], ["gram", "segment", "part"])


def bucket_of(gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def write_index(rows: DataFrame, path: str, key: str, columns: Sequence[str], buckets: int = BUCKETS) -> None:
    """Write the table and the index of its ``columns`` to the new folder ``path``."""
    spark = rows.sparkSession
    rows.withColumn("_place", F.monotonically_increasing_id()).write.parquet(f"{path}/rows")
    placed = spark.read.parquet(f"{path}/rows")
    texts = placed.select("_place", *[folded(F.col(f"`{c}`").cast("string")).alias(f"t{i}") for i, c in enumerate(columns)])
    parts = texts.mapInArrow(_postings, "gram string, segment long, part array<int>")
    lists = parts.groupBy("gram", "segment").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("part")))).alias("places"))
    coded = lists.select("gram", "segment", F.size("places").alias("n"), F.transform(
        "places", lambda x, i: x - F.when(i > 0, F.get("places", i - 1)).otherwise(0)).alias("deltas"),
        bucket_of(F.col("gram"), buckets).alias("bucket"))
    coded.repartition("bucket", F.pmod("segment", F.lit(16))).sortWithinPartitions("bucket", "gram", "segment").write.partitionBy(
        "bucket").parquet(f"{path}/postings")
    spark.createDataFrame([(key, list(columns), buckets)], _ABOUT).coalesce(1).write.json(f"{path}/about")


def required_runs(pattern: str) -> list[str]:
    """Runs of characters that occur in every match of a regular expression; fewer are found than there may be.

    Classes, groups, anchors and escapes part runs; a character that may be absent is in none. Alternatives and
    constructs that change the meaning of what follows give no runs at all.
    """
    if "|" in pattern or "(?" in pattern or "\\Q" in pattern:
        return []
    runs, now, depth, i = [], "", 0, 0
    while i < len(pattern):
        c = pattern[i]
        one = None
        if c == "\\":
            i += 1
            if i == len(pattern) or (pattern[i].isalnum() and pattern[i] not in "sSwWdDbB"):
                return []
            one = None if pattern[i].isalnum() else pattern[i]
        elif c == "[":
            if "&&" in pattern or "[" in pattern[i + 1:]:
                return []
            end = pattern.find("]", i + 2 if pattern[i + 1:i + 2] != "^" else i + 3)
            if end < 0 or "\\" in pattern[i:end]:
                return []
            i = end
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c not in ".^$*+?{":
            one = c
        following = pattern[i + 1:i + 2]
        if c == "{":
            end = pattern.find("}", i)
            if end < 0:
                return []
            i, following = end, pattern[end + 1:end + 2]
        if one is not None and depth == 0 and following not in ("?", "*", "{"):
            now += one
            if following == "+":
                runs, now = [*runs, now], ""
        else:
            runs, now = [*runs, now], ""
        i += 1
    return [r for r in [*runs, now] if r]


def needed_grams(query: str, regex: bool) -> list[str]:
    """Trigrams that every matching text has in one case. Letters beyond ASCII that have a case are left out, and so are
    the relatives of i, s and k: their cases need not fold alike everywhere."""
    out = set()
    for run in required_runs(query) if regex else [query]:
        for text in re.split("[ſİıK\u0307]", run):
            for i in range(len(text) - GRAM + 1):
                gram = text[i:i + GRAM]
                if all(ord(c) < 128 or c.lower() == c.upper() for c in gram):
                    out.add(gram.lower())
    return sorted(out)


def _intersected(batches):
    """(column, segment, lists) becomes (place) of rows that are in all lists of the column."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        segments = batch.column(0).to_pylist()
        for i, lists in enumerate(batch.column(1)):
            found = None
            for one in sorted(lists.values, key=len):
                places = np.cumsum(one.values.to_numpy(zero_copy_only=False).astype(np.int64))
                found = places if found is None else found[np.isin(found, places, assume_unique=True)]
                if not len(found):
                    break
            yield pa.RecordBatch.from_arrays([pa.array(found + segments[i] * SEGMENT)], ["_place"])


def candidates(spark: SparkSession, path: str, grams: Sequence[str], columns: int, buckets: int) -> DataFrame:
    """Places of the rows that have all ``grams`` in one of the columns."""
    wanted = [f"{i}:{g}" for i in range(columns) for g in grams]
    named = spark.createDataFrame([(w,) for w in wanted], "gram string")
    read = sorted({r[0] for r in named.select(bucket_of(F.col("gram"), buckets)).collect()})
    lists = spark.read.parquet(f"{path}/postings").filter(F.col("bucket").isin(read) & F.col("gram").isin(wanted))
    # at most one list per trigram and segment comes together
    grouped = lists.groupBy(F.substring_index("gram", ":", 1).alias("column"), "segment").agg(
        F.collect_list("deltas").alias("lists")).filter(F.size("lists") == len(grams))
    return grouped.select("segment", "lists").mapInArrow(_intersected, "_place long").distinct()


def search(spark: SparkSession, path: str, query: str, limit: int = 20, regex: bool = True) -> DataFrame:
    """The first ``limit`` rows, by key, whose text matches; as a scan with the same test finds them. A query below two
    characters finds nothing."""
    about = spark.read.schema(_ABOUT).json(f"{path}/about").first()
    rows = spark.read.parquet(f"{path}/rows")
    if len(query.strip()) < 2:
        return rows.drop("_place").limit(0)
    grams = needed_grams(query, regex)
    if grams:
        places = candidates(spark, path, grams, len(about["columns"]), about["buckets"])
        few = [r[0] for r in places.limit(LITERALS + 1).collect()]
        if len(few) <= LITERALS:
            rows = rows.filter(F.col("_place").isin(few)) if few else rows.limit(0)
        else:
            rows = rows.join(places, "_place", "left_semi")
    return rows.filter(text_matches(about["columns"], query, regex)).orderBy(about["key"]).limit(limit).drop("_place")
