"""Registered queries: samples, splits, neighbours, recommendations, popularity, browse clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators.recommend import (
    browse_clusters, last_interactions, named_output, popular, popularity_order, recommend,
)
from cadenza.operators.sampling import seeded_sample, sequential_ids, shuffle, split_random, split_stratified
from cadenza.operators.similar import (
    fallback_neighbours, nearest, similar_available, similar_tracks, with_fallback,
)
from cadenza.plans.registry import query, rounded, table
from cadenza.sources.tables import project


@query("""
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey::VARCHAR || '42'), o_orderkey LIMIT 500
""")
def sample_rows(spark, folder):
    return seeded_sample(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 500)


@query("""
    SELECT p_partkey, row_number() OVER (ORDER BY md5(p_partkey::VARCHAR || '42'), p_partkey) AS position FROM part
""")
def shuffle_rows(spark, folder):
    return shuffle(table(spark, folder, "part").select("p_partkey"), "p_partkey")


@query("""
    SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR || '42'), o_orderkey)
               <= ceil(0.2 * (SELECT count(*) FROM orders)) AS is_test
    FROM orders
""")
def random_split(spark, folder):
    return split_random(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query("""
    SELECT o_orderkey, o_orderpriority,
           row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey::VARCHAR || '42'))
               <= round(0.2 * count(*) OVER (PARTITION BY o_orderpriority)) AS is_test
    FROM orders
""")
def stratified_split(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return split_stratified(orders, "o_orderkey", "o_orderpriority")


@query("""
    WITH hashed AS (
        SELECT c_mktsegment, c_nationkey,
               md5(sha256(length(c_mktsegment) || ':' || c_mktsegment || length(c_nationkey::VARCHAR) || ':' || c_nationkey) || '42') AS h
        FROM customer)
    SELECT c_mktsegment, c_nationkey, 'custom_' || (row_number() OVER (ORDER BY h) - 1) AS track_id FROM hashed
""")
def number_rows_without_key(spark, folder):
    return sequential_ids(table(spark, folder, "customer").select("c_mktsegment", "c_nationkey"), "track_id", "custom_")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000
""")
def bounded_scan(spark, folder):
    return project(table(spark, folder, "orders"), ["o_orderkey", "o_totalprice"], 1000, ["o_orderkey"])


def _vectors(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("track_id"), F.col("embedding").alias("vector"), F.col("label"))


def _played(spark, folder, actions=("click", "purchase")):
    """Interactions of the events table: the JSON property names the track."""
    return table(spark, folder, "events").select(
        "user_id", F.get_json_object("props", "$.k").cast("long").alias("track_id"),
        F.col("event_type").alias("action"), "ts", "event_id",
    )


_PAIRS_SQL = """
    e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings),
    played AS (SELECT user_id, (props->>'$.k')::BIGINT AS id, event_type, ts, event_id FROM events),
    pairs AS (
        SELECT a.id AS query_id, b.id AS id, b.label, round(list_cosine_similarity(a.v, b.v), 9) AS s
        FROM e a, e b WHERE a.id <> b.id)
"""


@query(f"""
    WITH {_PAIRS_SQL}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM pairs
        WHERE query_id IN (SELECT id FROM played))
    SELECT query_id, id AS track_id, label, round(s, 6) AS similarity_score, rank FROM ranked WHERE rank <= 10
""")
def similar_by_id(spark, folder):
    vectors = _vectors(spark, folder)
    hits = similar_tracks(_played(spark, folder).select("track_id"), vectors, vectors.select("track_id", "label"), 10)
    return rounded(hits, similarity_score=6)


_ALL_PAIRS = f"""
    WITH {_PAIRS_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM pairs)
    SELECT query_id, id, round(s, 6) AS similarity, rank FROM ranked WHERE rank <= 5
"""


@query(_ALL_PAIRS)
def neighbours_of_all(spark, folder):
    vectors = _vectors(spark, folder)
    return rounded(nearest(vectors, vectors, 5), similarity=6)


@query(_ALL_PAIRS)
def neighbours_of_all_by_cells(spark, folder):
    """The same through the path taken when neither side is small."""
    vectors = _vectors(spark, folder)
    return rounded(nearest(vectors, vectors, 5, strategy="cells"), similarity=6)


@query(f"""
    WITH {_PAIRS_SQL}, available AS (SELECT doc_id FROM labels), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM pairs
        WHERE query_id IN (SELECT id FROM played) AND id IN (SELECT doc_id FROM available))
    SELECT query_id, id, round(s, 6) AS similarity, rank FROM ranked WHERE rank <= 10
""")
def similar_among_available(spark, folder):
    vectors = _vectors(spark, folder)
    queries = vectors.join(_played(spark, folder).select("track_id").distinct(), "track_id", "left_semi")
    available = table(spark, folder, "labels").select(F.col("doc_id").alias("track_id"))
    return rounded(similar_available(queries, vectors, available, 10), similarity=6)


@query(f"""
    WITH {_PAIRS_SQL}, first AS (
        SELECT query_id, id, s, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank, 0 AS source FROM pairs
        WHERE id IN (SELECT r_regionkey FROM region) QUALIFY rank <= 10),
    second AS (
        SELECT query_id, id, s, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank, 1 AS source FROM pairs
        QUALIFY rank <= 10),
    merged AS (
        SELECT * FROM (SELECT * FROM first UNION ALL SELECT * FROM second)
        QUALIFY row_number() OVER (PARTITION BY query_id, id ORDER BY source, rank) = 1)
    SELECT query_id, id AS track_id, p_name AS track_name, coalesce(p_brand, 'Unknown') AS artist_name, round(s, 6) AS similarity, source, position
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY source, rank) AS position FROM merged)
    JOIN part ON id = p_partkey WHERE position <= 10
""")
def similar_with_fallback(spark, folder):
    vectors = _vectors(spark, folder)
    available = table(spark, folder, "region").select(F.col("r_regionkey").cast("long").alias("track_id"))
    first = similar_available(vectors, vectors, available, 10)
    second = fallback_neighbours(vectors, vectors, 10)
    tracks = table(spark, folder, "part").select(
        F.col("p_partkey").alias("track_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("artist_name"))
    return rounded(named_output(with_fallback(first, second, 10), tracks), similarity=6)


@query("""
    SELECT user_id, event_id, (props->>'$.k')::BIGINT AS track_id,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS age
    FROM events WHERE event_type IN ('click', 'purchase') QUALIFY age <= 10
""")
def last_ten_per_user(spark, folder):
    recent = last_interactions(_played(spark, folder), 10, actions=("click", "purchase"))
    return recent.select("user_id", "event_id", "track_id", "age")


def _recommend_sql(limit: int, backfill: bool) -> str:
    """Oracle of the recommendations: seeds, five neighbours each, first seen wins, popularity list."""
    base = f"""
    WITH {_PAIRS_SQL}, seeds AS (
        SELECT user_id AS "user", id AS seed, -row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS pos
        FROM played WHERE event_type IN ('click', 'purchase') QUALIFY pos >= -10),
    lists AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM pairs
        WHERE query_id IN (SELECT seed FROM seeds) QUALIFY rank <= 5),
    offered AS (
        SELECT "user", pos, rank, l.id, s FROM seeds JOIN lists l ON seed = query_id
        WHERE NOT EXISTS (SELECT 1 FROM seeds x WHERE x."user" = seeds."user" AND x.seed = l.id)
        QUALIFY row_number() OVER (PARTITION BY "user", l.id ORDER BY pos, rank) = 1),
    placed AS (
        SELECT "user", id, s, row_number() OVER (PARTITION BY "user" ORDER BY s DESC, pos, rank) AS position,
               count(*) OVER (PARTITION BY "user") AS hits
        FROM offered),
    popular AS (SELECT id, row_number() OVER (ORDER BY md5(id::VARCHAR || '42'), id) AS position FROM e),
    users AS (SELECT DISTINCT "user" FROM seeds),
    """
    if backfill:
        return base + f"""
    personal AS (SELECT * FROM placed WHERE position <= {limit}),
    fresh AS (
        SELECT "user", id, popular.position FROM users, popular
        WHERE NOT EXISTS (SELECT 1 FROM personal p WHERE p."user" = users."user" AND p.id = popular.id)),
    merged AS (
        SELECT "user", id, s, 'similar' AS source, 0 AS part, position FROM personal UNION ALL
        SELECT "user", id, NULL, 'popular', 1, position FROM fresh)
    SELECT "user", row_number() OVER (PARTITION BY "user" ORDER BY part, position) AS position, id, round(s, 6) AS similarity, source
    FROM merged QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY part, position) <= {limit}
    """
    return base + f"""
    personal AS (SELECT * FROM placed WHERE position <= {limit} AND hits >= {limit})
    SELECT "user", position, id, round(s, 6) AS similarity, 'similar' AS source FROM personal UNION ALL
    SELECT "user", position, id, NULL, 'popular' FROM users, popular
    WHERE position <= {limit} AND "user" NOT IN (SELECT "user" FROM personal)
    """


def _recommended(spark, folder, limit, backfill=False):
    vectors = _vectors(spark, folder)
    rows = recommend(_played(spark, folder), vectors, limit, backfill=backfill, actions=("click", "purchase"))
    return rounded(rows, similarity=6)


@query(_recommend_sql(20, False))
def recommend_for_users(spark, folder):
    return _recommended(spark, folder, 20)


@query(_recommend_sql(42, False))
def recommend_or_popular(spark, folder):
    """A limit that many users miss: they get the popularity list."""
    return _recommended(spark, folder, 42)


@query(_recommend_sql(50, True))
def recommend_with_backfill(spark, folder):
    return _recommended(spark, folder, 50, backfill=True)


@query("""
    SELECT 'rank' AS kind, * FROM (SELECT p_partkey, p_name FROM part ORDER BY nullif(p_size, 1) ASC NULLS LAST, p_partkey LIMIT 20) UNION ALL
    SELECT 'points', * FROM (SELECT p_partkey, p_name FROM part ORDER BY nullif(p_size, 50) DESC NULLS LAST, p_partkey LIMIT 20) UNION ALL
    SELECT 'shuffle', * FROM (SELECT p_partkey, p_name FROM part ORDER BY md5(p_partkey::VARCHAR || '42'), p_partkey LIMIT 20)
""")
def popularity_fallback(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    ranked = part.withColumn("rank", F.when(F.col("p_size") != 1, F.col("p_size")))
    pointed = part.withColumn("points (total)", F.when(F.col("p_size") != 50, F.col("p_size")))
    lists = None
    for kind, tracks in (("rank", ranked), ("points", pointed), ("shuffle", part)):
        top = popular(tracks, 20, "p_partkey", popularity_order(tracks.columns, "p_partkey"))
        named = top.select(F.lit(kind).alias("kind"), "p_partkey", "p_name")
        lists = named if lists is None else lists.unionByName(named)
    return lists


@query("""
    WITH sample AS (
        SELECT c_custkey, c_acctbal / 10000 AS energy, c_nationkey / 25 AS danceability, md5(c_custkey::VARCHAR || '42') AS h
        FROM customer),
    clustered AS (SELECT *, CASE WHEN energy > 0.6 AND danceability > 0.6 THEN 0 ELSE 1 END AS cluster FROM sample)
    SELECT c_custkey, cluster, ['AI cluster: High Energy', 'AI cluster: Chill Vibes'][cluster + 1] AS cluster_name,
           row_number() OVER (PARTITION BY cluster ORDER BY h, c_custkey) AS position
    FROM clustered QUALIFY position <= 15
""")
def browse_rule_clusters(spark, folder):
    tracks = table(spark, folder, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 10000).alias("energy"), (F.col("c_nationkey") / 25).alias("danceability"))
    return browse_clusters(tracks, 15, key="c_custkey").select("c_custkey", "cluster", "cluster_name", "position")
