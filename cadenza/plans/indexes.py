"""Registered queries on stored indexes: approximate neighbours, text search, point lookups.

Each writes its index to a new scratch folder and searches that.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import search_index
from cadenza.operators.lsh import lsh_nearest, probes_for, write_index
from cadenza.operators.similar import nearest
from cadenza.plans.registry import query, rounded, table
from cadenza.session import scratch_dir
from cadenza.sources import lookup_table


def _approximate(spark, folder, k=10):
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("track_id"), F.col("embedding").alias("vector"))
    index = write_index(vectors, scratch_dir(spark, "lsh"))
    probes, _ = probes_for(index, vectors, vectors, k)
    return vectors, lsh_nearest(index, vectors, k, probes, vectors)


@query()
def lsh_neighbours(spark, folder):
    """Ten approximate neighbours of every vector; ``lsh_recall`` holds them against the exact ones."""
    return rounded(_approximate(spark, folder)[1], similarity=6)


@query("""
    SELECT count(*) AS queries, sum(least(10, n - 1))::BIGINT AS wanted, sum(least(10, n - 1))::BIGINT AS returned, TRUE AS enough
    FROM (SELECT count(*) OVER () AS n FROM embeddings)
""")
def lsh_recall(spark, folder):
    """Whether at least nine tenths of the exact neighbours are among the approximate ones, over all queries."""
    vectors, found = _approximate(spark, folder)
    exact = nearest(vectors, vectors, 10).select("query_id", "id", F.lit(1).alias("exact"))
    mine = found.select("query_id", "id", F.lit(1).alias("mine"))
    counts = exact.join(mine, ["query_id", "id"], "full_outer").agg(
        F.countDistinct("query_id").alias("queries"), F.count("exact").alias("wanted"), F.count("mine").alias("returned"),
        (F.count(F.col("exact") + F.col("mine")) >= 0.9 * F.count("exact")).alias("enough"))
    return counts


@query("""
    SELECT doc_id, lang, n_chars FROM documents
    WHERE regexp_matches(lower(text), 'stupid\\W+the|ed on the\\b') ORDER BY doc_id LIMIT 200
""")
def search_index_scan(spark, folder):
    """A pattern of alternatives: no trigram is sure, so the exact test reads every row."""
    return _searched(spark, folder, "stupid\\W+the|ed on the\\b", True)


@query("""
    SELECT doc_id, lang, n_chars FROM documents
    WHERE regexp_matches(lower(text), 'apache\\s+licen[cs]e,.*2\\.0') OR regexp_matches(lower(source), 'apache\\s+licen[cs]e,.*2\\.0')
    ORDER BY doc_id LIMIT 200
""")
def search_index_regex(spark, folder):
    return _searched(spark, folder, "Apache\\s+licen[cs]e,.*2\\.0", True)


@query("""
    SELECT doc_id, lang, n_chars FROM documents
    WHERE contains(lower(text), 'the worth') OR contains(lower(source), 'the worth') ORDER BY doc_id LIMIT 200
""")
def search_index_literal(spark, folder):
    return _searched(spark, folder, "The Worth", False)


def _searched(spark, folder, text, regex):
    path = scratch_dir(spark, "search")
    search_index.write_index(table(spark, folder, "documents"), path, "doc_id", ["text", "source"])
    return search_index.search(spark, path, text, 200, regex).select("doc_id", "lang", "n_chars")


def _stored_lines(spark, folder):
    path = scratch_dir(spark, "lookup")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    lookup_table.write_lookup(lines, path, "l_orderkey")
    return path


@query("""
    SELECT l_orderkey, l_partkey, l_quantity, TRUE AS found FROM lineitem WHERE l_orderkey IN (1, 7, 33, 99999999) UNION ALL
    SELECT id, NULL, NULL, FALSE FROM (SELECT unnest([1, 7, 33, 99999999]) AS id) WHERE id NOT IN (SELECT l_orderkey FROM lineitem)
""")
def lookup_stored_few(spark, folder):
    """A few ids as literals, those not found marked."""
    path = _stored_lines(spark, folder)
    ids = spark.createDataFrame([(1,), (7,), (33,), (99999999,)], "l_orderkey long")
    absent = lookup_table.missing(spark, path, ids).withColumn("found", F.lit(False))
    return lookup_table.find(spark, path, ids).withColumn("found", F.lit(True)).unionByName(absent, allowMissingColumns=True)


@query("""
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def lookup_stored_many(spark, folder):
    """More ids than literals: joined bucket by bucket."""
    path = _stored_lines(spark, folder)
    ids = table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return lookup_table.find(spark, path, ids)
