"""Registered queries: selection, filters, filling, derived features, scalar rules, whole cleaning jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions.names import columns_except, feature_columns, keep_columns, numeric_columns
from cadenza.functions.scalar import (
    clamp, hash_bucket, last_path_segment, normalize_loudness, rescale_loudness, rounded_percent, score_map,
    top_classes,
)
from cadenza.operators.clean import (
    coerce_and_fill, drop_missing, fill_missing, first_per_key, genre_counts, lookup, map_genres, not_found,
)
from cadenza.operators.features import (
    assemble_features, catalogue_features, model_features, standard_scale,
)
from cadenza.plans.jobs import build_catalogue, list_tracks, search
from cadenza.plans.registry import null_if, query, rounded, table
from cadenza.sources.delimited import clean_serving


@query("""
    SELECT CASE p_type WHEN 'ECONOMY' THEN 'BUDGET' WHEN 'STANDARD' THEN 'CORE' WHEN 'MEDIUM' THEN 'CORE'
                       WHEN 'PROMO' THEN 'UNKNOWN_GENRE' ELSE p_type END AS "Category", count(*) AS "Count"
    FROM part WHERE p_type <> 'SMALL' GROUP BY 1
""")
def genre_map_and_count(spark, folder):
    part = table(spark, folder, "part").withColumn("p_type", null_if("p_type", "PROMO"))
    mapping = {"ECONOMY": "BUDGET", "STANDARD": "CORE", "MEDIUM": "CORE"}
    return genre_counts(map_genres(part, "p_type", ["SMALL"], mapping), "p_type")


@query("""
    SELECT l_returnflag, l_linestatus, l_tax, l_quantity FROM lineitem
""")
def keep_listed_columns(spark, folder):
    return keep_columns(
        table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus", "absent"], ["l_tax", "missing", "l_quantity"]
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount <> 0.0 AND l_tax <> 0.0
""")
def drop_null_rows(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", null_if("l_discount", 0.0).alias("l_discount"), null_if("l_tax", 0.0).alias("l_tax")
    )
    return drop_missing(lines, ["l_discount", "l_tax"])


@query("""
    WITH raw AS (
        SELECT l_orderkey, l_partkey, nullif(l_discount, 0.0) AS discount, nullif(l_linenumber, 1) AS line,
               nullif(l_returnflag, 'A') AS flag
        FROM lineitem)
    SELECT l_orderkey, l_partkey,
           round(coalesce(discount, (SELECT avg(discount) FROM raw)), 6) AS discount,
           coalesce(line, (SELECT line FROM raw WHERE line IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, line LIMIT 1)) AS line,
           coalesce(flag, (SELECT flag FROM raw WHERE flag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, flag LIMIT 1)) AS flag
    FROM raw
""")
def impute_mean_mode(spark, folder):
    raw = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", null_if("l_discount", 0.0).alias("discount"),
        null_if("l_linenumber", 1).alias("line"), null_if("l_returnflag", "A").alias("flag"),
    )
    return rounded(fill_missing(raw, mean=["discount"], mode=["line", "flag"]), discount=6)


_CATALOGUE_RAW = """
    SELECT l_orderkey, l_partkey, l_discount AS danceability, l_tax AS energy, -l_quantity AS loudness,
           (l_linenumber - 1) * 1000 AS duration_ms, l_extendedprice / 1000 AS tempo, l_quantity AS valence
    FROM lineitem
"""


@query(f"""
    WITH raw AS ({_CATALOGUE_RAW}), derived AS (
        SELECT *, danceability * energy AS a, loudness / nullif(duration_ms / 1000.0::DOUBLE, 0) AS b,
               abs(tempo - 120) AS c, valence / (energy + 0.000001::DOUBLE) AS d
        FROM raw)
    SELECT l_orderkey, l_partkey,
           round(a, 6) AS "Dance_Energy_Interaction",
           round(coalesce(b, (SELECT median(b) FROM derived)), 6) AS "Loudness_Duration_Ratio",
           round(c, 6) AS "Tempo_vs_120", round(d, 6) AS "Valence_Energy_Ratio"
    FROM derived
""")
def engineer_catalogue_features(spark, folder):
    raw = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_discount").alias("danceability"), F.col("l_tax").alias("energy"),
        (-F.col("l_quantity")).alias("loudness"), ((F.col("l_linenumber") - 1) * 1000).alias("duration_ms"),
        (F.col("l_extendedprice") / 1000).alias("tempo"), F.col("l_quantity").alias("valence"),
    )
    names = ["Dance_Energy_Interaction", "Loudness_Duration_Ratio", "Tempo_vs_120", "Valence_Energy_Ratio"]
    derived = catalogue_features(raw).select("l_orderkey", "l_partkey", *names)
    return rounded(derived, **{n: 6 for n in names})


@query("""
    WITH raw AS (
        SELECT l_orderkey, l_partkey, l_discount AS danceability, nullif(l_tax, 0.02) AS energy, l_quantity AS valence,
               l_extendedprice AS speechiness, nullif(l_discount, 0.0) AS acousticness, l_tax AS instrumentalness
        FROM lineitem), derived AS (
        SELECT *, danceability * energy AS a, valence / (energy + 0.000001::DOUBLE) AS b,
               acousticness * instrumentalness AS c, speechiness / (energy + 0.000001::DOUBLE) AS d
        FROM raw), m AS (SELECT median(a) AS a, median(b) AS b, median(c) AS c, median(d) AS d FROM derived)
    SELECT l_orderkey, l_partkey, round(coalesce(t.a, m.a), 6) AS "Dance_Energy_Interaction",
           round(coalesce(t.b, m.b), 4) AS "Valence_Energy_Ratio",
           round(coalesce(t.c, m.c), 6) AS "Acoustic_Instrumental_Interaction",
           round(coalesce(t.d, m.d), 2) AS "Speechiness_Energy_Ratio"
    FROM derived t, m
""")
def engineer_model_features(spark, folder):
    raw = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_discount").alias("danceability"), null_if("l_tax", 0.02).alias("energy"),
        F.col("l_quantity").alias("valence"), F.col("l_extendedprice").alias("speechiness"),
        null_if("l_discount", 0.0).alias("acousticness"), F.col("l_tax").alias("instrumentalness"),
    )
    names = ["Dance_Energy_Interaction", "Valence_Energy_Ratio", "Acoustic_Instrumental_Interaction",
             "Speechiness_Energy_Ratio"]
    derived = model_features(raw).select("l_orderkey", "l_partkey", *names)
    return rounded(derived, **dict(zip(names, (6, 4, 6, 2))))


@query("""
    WITH raw AS (
        SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN NULL
                              ELSE try_cast(props->>'$.k' AS DOUBLE) END AS k
        FROM events)
    SELECT event_id, coalesce(k, (SELECT median(k) FROM raw)) AS k, 0.0::DOUBLE AS nothing FROM raw
""")
def median_fill_coerced_text(spark, folder):
    k = F.when(F.col("event_type") == "error", "bad").when(
        F.col("event_type") != "signup", F.get_json_object("props", "$.k"))
    raw = table(spark, folder, "events").select("event_id", k.alias("k"), F.lit("none").alias("nothing"))
    return coerce_and_fill(raw, ["k", "nothing"])


@query("""
    WITH raw AS (SELECT c_custkey, c_nationkey, -c_acctbal AS x FROM customer)
    SELECT c_custkey, CASE WHEN c_nationkey = 1 THEN 0.0 WHEN c_nationkey = 0 THEN -12.0
           ELSE greatest(-60.0, least(0.0, CASE WHEN abs(x) > 60 THEN x / 100 ELSE x END)) END::DOUBLE AS loudness
    FROM raw
""")
def loudness_normalise(spark, folder):
    text = F.when(F.col("c_nationkey") == 0, "abc").when(
        F.col("c_nationkey") != 1, (-F.col("c_acctbal")).cast("string"))
    return table(spark, folder, "customer").select("c_custkey", normalize_loudness(text).alias("loudness"))


@query("SELECT page_id, string_split(url, '/')[-1] AS track_id FROM pages")
def url_last_segment(spark, folder):
    return table(spark, folder, "pages").select("page_id", last_path_segment(F.col("url")).alias("track_id"))


@query("""
    SELECT doc_id, lang, n_chars FROM documents
    WHERE regexp_matches(lower(text), 'ion\\s+the') OR regexp_matches(lower(source), 'ion\\s+the')
    ORDER BY doc_id LIMIT 20
""")
def search_text_regex(spark, folder):
    found = search(table(spark, folder, "documents"), r"ion\s+the", 20, "doc_id", ["text", "source"])
    return found.select("doc_id", "lang", "n_chars")


@query("""
    SELECT p_partkey, p_name, p_brand FROM part
    WHERE contains(lower(p_name), 'ring') OR contains(lower(p_brand), 'ring') ORDER BY p_partkey LIMIT 20
""")
def search_text_literal(spark, folder):
    found = search(table(spark, folder, "part"), "RING", 20, "p_partkey", ["p_name", "p_brand"], regex=False)
    return found.select("p_partkey", "p_name", "p_brand")


@query("""
    SELECT p_partkey AS track_id, p_name AS track_name, p_type AS genre, p_retailprice AS popularity
    FROM part WHERE p_type = 'LARGE' ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 20
""")
def top_by_category(spark, folder):
    tracks = table(spark, folder, "part").select(
        F.col("p_partkey").alias("track_id"), F.col("p_name").alias("track_name"), F.col("p_type").alias("genre"),
        F.col("p_retailprice").alias("popularity"),
    )
    return list_tracks(tracks, 20, "LARGE")


@query("""
    WITH ids AS (SELECT DISTINCT l_suppkey * 30 AS p_partkey FROM lineitem)
    SELECT p_partkey, p_name, true AS found FROM part WHERE p_partkey IN (SELECT p_partkey FROM ids)
    UNION ALL
    SELECT p_partkey, NULL, false FROM ids WHERE p_partkey NOT IN (SELECT p_partkey FROM part)
""")
def lookup_by_ids(spark, folder):
    ids = table(spark, folder, "lineitem").select((F.col("l_suppkey") * 30).alias("p_partkey"))
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    hits = lookup(part, "p_partkey", ids).withColumn("found", F.lit(True))
    misses = not_found(part, "p_partkey", ids).select(
        "p_partkey", F.lit(None).cast("string").alias("p_name"), F.lit(False).alias("found"))
    return hits.unionByName(misses)


@query("""
    SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
""")
def dedupe_keep_first(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return first_per_key(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("""
    SELECT l_orderkey, l_partkey,
           round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) + 0.0 AS l_quantity,
           round((l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER (), 6) + 0.0 AS l_extendedprice,
           0.0::DOUBLE AS fixed
    FROM lineitem
""")
def standard_scaling(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", F.lit(7.0).alias("fixed"))
    scaled = standard_scale(lines, ["l_quantity", "l_extendedprice", "fixed"])
    return rounded(scaled, l_quantity=6, l_extendedprice=6)


@query("""
    SELECT l_orderkey, l_partkey, coalesce(nullif(l_discount, 0.0), 0.0) AS danceability, l_tax AS energy,
           l_quantity AS valence,
           round(coalesce(nullif(l_discount, 0.0) * l_tax, 0.0), 8) AS "Dance_Energy_Interaction",
           round(coalesce(l_quantity / nullif(l_tax + 0.000001::DOUBLE, 0), 0.0), 4) AS "Valence_Energy_Ratio",
           0.0::DOUBLE AS speechiness
    FROM lineitem
""")
def serving_fill_policy(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", null_if("l_discount", 0.0).alias("danceability"),
        F.col("l_tax").cast("string").alias("energy"), F.col("l_quantity").alias("valence"),
    )
    wanted = ["danceability", "energy", "valence", "Dance_Energy_Interaction", "Valence_Energy_Ratio", "speechiness"]
    filled = assemble_features(lines, wanted, "lenient")
    return rounded(filled, Dance_Energy_Interaction=8, Valence_Energy_Ratio=4)


@query("""
    SELECT c_custkey, least(greatest(c_acctbal / 50, 0.0), 100.0) AS clamped,
           (-(c_acctbal / 200) + 60) / 60 AS rescaled, round(c_acctbal * 100.0 / 9999.99, 1) + 0.0 AS percent
    FROM customer
""")
def clamp_and_rescale(spark, folder):
    balance = F.col("c_acctbal")
    return table(spark, folder, "customer").select(
        "c_custkey", clamp(balance / 50, 0, 100).alias("clamped"),
        rescale_loudness(-(balance / 200)).alias("rescaled"),
        rounded_percent(balance, F.lit(9999.99)).alias("percent"),
    )


@query("""
    SELECT p_partkey, ('0x' || md5(p_partkey::VARCHAR)[1:8])::BIGINT % 2 AS cluster FROM part
""")
def hash_bucket_fallback(spark, folder):
    return table(spark, folder, "part").select("p_partkey", hash_bucket("p_partkey").alias("cluster"))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("""
    WITH shares AS (
        SELECT c_nationkey, c_mktsegment AS name,
               count(*) / sum(count(*)) OVER (PARTITION BY c_nationkey) AS score
        FROM customer GROUP BY 1, 2)
    SELECT c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY score DESC, name) AS place, name,
           round(score, 6) AS score
    FROM shares QUALIFY place <= 3
""")
def probability_top3(spark, folder):
    rows = F.count(F.lit(1))
    shares = table(spark, folder, "customer").groupBy("c_nationkey").agg(
        F.array(*[F.count_if(F.col("c_mktsegment") == s) / rows for s in _SEGMENTS]).alias("scores"))
    best = shares.select("c_nationkey", F.posexplode(top_classes(_SEGMENTS, F.col("scores"))).alias("at", "top"))
    return best.select("c_nationkey", (F.col("at") + 1).cast("long").alias("place"), "top.name",
                       F.round("top.score", 6).alias("score")).filter("score > 0")


@query("""
    SELECT c_nationkey, c_mktsegment AS segment, round(count(*) / sum(count(*)) OVER (PARTITION BY c_nationkey), 6) AS probability
    FROM customer GROUP BY 1, 2
""")
def probability_map(spark, folder):
    rows = F.count(F.lit(1))
    shares = table(spark, folder, "customer").groupBy("c_nationkey").agg(
        F.array(*[F.count_if(F.col("c_mktsegment") == s) / rows for s in _SEGMENTS]).alias("scores"))
    cells = shares.select("c_nationkey", F.explode(score_map(_SEGMENTS, F.col("scores"))).alias("segment", "probability"))
    return rounded(cells.filter("probability > 0"), probability=6)


@query("""
    SELECT * FROM (
        SELECT 'l_quantity' AS feature, count(l_quantity) AS rows, round(avg(l_quantity), 4) AS mean FROM lineitem UNION ALL
        SELECT 'l_extendedprice', count(l_extendedprice), round(avg(l_extendedprice), 4) FROM lineitem UNION ALL
        SELECT 'l_discount', count(l_discount), round(avg(l_discount), 4) FROM lineitem UNION ALL
        SELECT 'l_tax', count(l_tax), round(avg(l_tax), 4) FROM lineitem)
""")
def feature_columns_summary(spark, folder):
    """Column choice by type, by list and by exclusion, then one scan over the chosen columns."""
    lines = table(spark, folder, "lineitem")
    numeric = set(numeric_columns(lines))
    listed = feature_columns(lines, ["l_quantity", "l_extendedprice", "absent"], ["l_discount", "l_tax"])
    other = columns_except(lines, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], id_prefix=None)
    chosen = [c for c in listed if c in numeric and c in other]
    row = lines.agg(*[f(c).alias(f"{n}_{c}") for c in chosen for n, f in (("n", F.count), ("m", F.avg))])
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"n_{c}").alias("rows"), F.round(f"m_{c}", 4).alias("mean"))
        for c in chosen
    ])
    return row.select(F.explode(cells).alias("cell")).select("cell.*")


@query("""
    WITH raw AS (
        SELECT string_split(url, '/')[-1] AS track_id, page_id, c_name AS track_name,
               CASE WHEN c_nationkey = 3 THEN NULL ELSE -c_acctbal END AS loudness,
               CASE WHEN c_nationkey = 4 THEN NULL ELSE c_acctbal / 9999.99 END AS energy
        FROM pages JOIN customer ON page_id = c_custkey), first_rows AS (
        SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY page_id) = 1), loud AS (
        SELECT * REPLACE (coalesce(greatest(-60.0, least(0.0, CASE WHEN abs(loudness) > 60 THEN loudness / 100 ELSE loudness END)), 0.0) AS loudness)
        FROM first_rows)
    SELECT track_id, page_id, track_name, loudness::FLOAT::DOUBLE AS loudness,
           coalesce(energy, (SELECT median(energy) FROM loud))::FLOAT::DOUBLE AS energy
    FROM loud
""")
def clean_serving_table(spark, folder):
    raw = table(spark, folder, "pages").join(
        table(spark, folder, "customer"), F.col("page_id") == F.col("c_custkey")
    ).select(
        "page_id", F.col("c_name").alias(" Title "), F.col("url").alias("Song URL"),
        F.when(F.col("c_nationkey") != 3, (-F.col("c_acctbal")).cast("string")).alias("Loudness"),
        F.when(F.col("c_nationkey") == 4, "n/a").otherwise((F.col("c_acctbal") / 9999.99).cast("string")).alias("Energy "),
    )
    cleaned = clean_serving(raw, order=["page_id"])
    return cleaned.select(
        "track_id", "page_id", "track_name",
        F.col("loudness").cast("double").alias("loudness"), F.col("energy").cast("double").alias("energy"),
    )


@query("""
    WITH raw AS (
        SELECT l_orderkey AS popularity, nullif(p_brand, 'Brand#1') AS artist_name, p_name AS track_name,
               l_partkey AS track_id,
               CASE p_type WHEN 'ECONOMY' THEN 'POP' WHEN 'STANDARD' THEN 'ELECTRONIC' WHEN 'MEDIUM' THEN 'JAZZ'
                    WHEN 'LARGE' THEN 'zydeco' WHEN 'SMALL' THEN 'UNKNOWN_GENRE' END AS genre,
               nullif(l_discount, 0.0) AS danceability, l_tax AS energy, -l_quantity AS loudness,
               (l_linenumber - 1) * 1000 AS duration_ms, l_extendedprice / 1000 AS tempo, l_quantity AS valence,
               nullif(l_linenumber, 2) AS key
        FROM lineitem JOIN part ON l_partkey = p_partkey), named AS (
        SELECT * FROM raw WHERE artist_name IS NOT NULL), filled AS (
        SELECT * REPLACE (coalesce(danceability, (SELECT avg(danceability) FROM named)) AS danceability,
                          coalesce(key, (SELECT key FROM named WHERE key IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, key LIMIT 1)) AS key)
        FROM named), kept AS (SELECT * FROM filled WHERE genre IS NOT NULL)
    SELECT artist_name, track_name, track_id, genre, popularity, duration_ms, loudness, round(danceability, 6) AS danceability,
           energy, valence, round(valence / (energy + 0.000001::DOUBLE), 4) AS "Valence_Energy_Ratio",
           round(danceability * energy, 6) AS "Dance_Energy_Interaction", tempo, round(abs(tempo - 120), 6) AS "Tempo_vs_120", key
    FROM kept
""")
def clean_catalogue(spark, folder):
    """The offline chain: drop, fill, map genres, derive, reduce."""
    genre = (
        F.when(F.col("p_type") == "ECONOMY", "k-pop").when(F.col("p_type") == "STANDARD", "techno")
        .when(F.col("p_type") == "MEDIUM", "blues").when(F.col("p_type") == "LARGE", "zydeco")
        .when(F.col("p_type") == "PROMO", "gospel")
    )
    raw = table(spark, folder, "lineitem").join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    ).select(
        F.lit(0).alias("Unnamed: 0"), F.col("l_orderkey").alias("popularity"),
        null_if("p_brand", "Brand#1").alias("artist_name"), F.col("p_name").alias("track_name"),
        F.col("l_partkey").alias("track_id"), genre.alias("genre"), null_if("l_discount", 0.0).alias("danceability"),
        F.col("l_tax").alias("energy"), (-F.col("l_quantity")).alias("loudness"),
        ((F.col("l_linenumber") - 1) * 1000).alias("duration_ms"), (F.col("l_extendedprice") / 1000).alias("tempo"),
        F.col("l_quantity").alias("valence"), null_if("l_linenumber", 2).alias("key"),
    )
    return rounded(build_catalogue(raw), danceability=6, Valence_Energy_Ratio=4, Dance_Energy_Interaction=6, Tempo_vs_120=6)
