"""Registered queries: files, tables, upserts, stored metrics and streams.

Each writes what it needs to a new scratch folder and reads it back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cadenza.operators.clean import first_per_key, handle_missing
from cadenza.operators.metrics import regression_metrics
from cadenza.operators.recommend import KEPT_INTERACTIONS
from cadenza.plans.quality import _priced
from cadenza.plans.registry import null_if, query, rounded, table
from cadenza.session import scratch_dir
from cadenza.sources.delimited import check_upload, load_upload, peek, read_csv, write_csv
from cadenza.sources.file_order import ids_in_order, keep_first_in_file, load_upload_in_order, read_csv_in_order
from cadenza.sources.metrics_store import read_metrics, write_metrics
from cadenza.sources.mixed_files import read_mixed
from cadenza.sources.tables import (
    append, create_table, current_version, load_summary, replace_by_upsert, replace_rows, run_sql, to_schema, upsert)
from cadenza.streaming.interactions import interactions, latest_tracks, once, read_latest, rejected, write_latest, write_log
from cadenza.streaming.latest import ListTable, kept_tracks, write_lists


@query("""
    SELECT sep, p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part, (SELECT unnest([',', ';']) AS sep)
""")
def csv_round_trip(spark, folder):
    part = table(spark, folder, "part")
    both = None
    for sep in (",", ";"):
        path = scratch_dir(spark, "parts")
        write_csv(part, path, sep)
        back = read_csv(spark, path, sep, schema=part.schema).withColumn("sep", F.lit(sep))
        both = back if both is None else both.unionByName(back)
    return both


@query("""
    WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN p_name END AS p_name,
                      CASE WHEN p_partkey % 5 > 0 THEN p_retailprice END AS p_retailprice FROM part)
    SELECT p_partkey, p_name, round(coalesce(p_retailprice, (SELECT avg(p_retailprice) FROM p WHERE p_name IS NOT NULL)), 6) AS p_retailprice
    FROM p WHERE p_name IS NOT NULL
""")
def csv_missing_tokens(spark, folder):
    """A file that writes its gaps as NA, null and NaN: rows without a name go, prices are filled by their mean."""
    key = F.col("p_partkey")
    part = table(spark, folder, "part").select(
        key, F.when(key % 3 > 0, F.col("p_name")).when(key % 2 == 0, "NA").otherwise("null").alias("p_name"),
        F.when(key % 5 > 0, F.col("p_retailprice").cast("string")).otherwise("NaN").alias("p_retailprice"))
    path = scratch_dir(spark, "gaps")
    write_csv(part, path)
    back = read_csv(spark, path, infer=True).withColumn("p_partkey", F.col("p_partkey").cast("long"))
    return rounded(handle_missing(back, text=["p_name"], mean=["p_retailprice"], mode=[]), p_retailprice=6)


@query("""
    SELECT p_partkey, p_partkey + 9007199254740993 AS wide, p_partkey::HUGEINT + 99999999999999999999::HUGEINT AS widest,
           p_size < 25 AS small, p_retailprice AS price, lpad(p_partkey::VARCHAR, 45, '7') AS digits
    FROM part
""")
def csv_inferred_types(spark, folder):
    """A file of whole numbers of all widths and of booleans: no digit is lost, and types follow the cells."""
    part = table(spark, folder, "part").select(
        "p_partkey", (F.col("p_partkey") + F.lit(9007199254740993)).alias("wide"),
        (F.col("p_partkey").cast("decimal(38,0)") + F.lit("99999999999999999999").cast("decimal(38,0)")).alias("widest"),
        F.when(F.col("p_size") < 25, "True").otherwise("FALSE").alias("small"), F.col("p_retailprice").alias("price"),
        F.lpad(F.col("p_partkey").cast("string"), 45, "7").alias("digits"))
    path = scratch_dir(spark, "types")
    write_csv(part, path)
    back = read_csv(spark, path, infer=True)
    kinds = {f.name: f.dataType.simpleString() for f in back.schema.fields}
    wanted = {"p_partkey": "int", "wide": "bigint", "widest": "decimal(38,0)", "small": "boolean", "price": "double",
              "digits": "string"}
    if kinds != wanted:
        raise ValueError(f"inferred {kinds}")
    return back.withColumn("p_partkey", F.col("p_partkey").cast("long"))


@query("""
    SELECT 'p' || p_partkey AS track_id, p_name AS track_name, p_brand AS artist_name,
           coalesce(CASE WHEN p_size = 7 THEN NULL ELSE p_size END, (SELECT median(p_size) FROM part WHERE p_size <> 7))::DOUBLE AS energy,
           p_retailprice AS num_of_plays_ind
    FROM part
""")
def ingest_unknown_file(spark, folder):
    """A file with odd headers, an unknown delimiter and bad numbers."""
    part = table(spark, folder, "part").select(
        F.concat(F.lit("p"), "p_partkey").alias("ID"), F.col("p_name").alias("Title"), F.col("p_brand").alias("Artists"),
        F.when(F.col("p_size") == 7, "seven").otherwise(F.col("p_size").cast("string")).alias("Energy"),
        F.col("p_retailprice").alias("# of Plays (Ind)"),
    )
    path = scratch_dir(spark, "upload")
    write_csv(part, path, "\t")
    cleaned = load_upload(spark, path)
    return cleaned.withColumn("num_of_plays_ind", F.col("num_of_plays_ind").cast("double"))


@query("""
    SELECT p_type, 2 * count(*) AS "count", 2 * (SELECT count(*) FROM part) AS total_rows FROM part GROUP BY 1
""")
def load_and_verify(spark, folder):
    """Create, truncate and load, append, then count per category."""
    part = table(spark, folder, "part")
    name = f"parts_{uuid.uuid4().hex}"
    create_table(spark, name, part.schema, scratch_dir(spark, "table"))
    text = part.withColumn("p_size", F.col("p_size").cast("string"))
    replace_rows(to_schema(text, part.schema), name)
    append(part, name)
    return load_summary(spark.table(name), "p_type")


@query("""
    WITH stored AS (
        SELECT user_id, event_id, value, event_type FROM events WHERE event_type = 'view'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1),
    incoming AS (
        SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, event_type FROM events
        WHERE event_type <> 'view' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT user_id, CASE WHEN s.user_id IS NULL THEN -1 ELSE s.event_id END AS event_id,
           CASE WHEN i.user_id IS NULL THEN s.value ELSE i.value END AS value,
           CASE WHEN i.user_id IS NULL THEN s.event_type ELSE i.event_type END AS event_type
    FROM stored s FULL JOIN incoming i USING (user_id)
""")
def upsert_last_wins(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", "value", "event_type", "ts")
    viewed = F.col("event_type") == "view"
    stored = first_per_key(events.filter(viewed), ["user_id"], ["ts", "event_id"]).drop("ts")
    incoming = events.filter(~viewed).withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    return upsert(stored, incoming, "user_id", ["value", "event_type"], [F.desc("ts"), F.desc("event_id")],
                  new_row={"event_id": F.lit(-1)})


@query("""
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice >= 400000.0
""")
def sql_with_bound_args(spark, folder):
    name = f"orders_{uuid.uuid4().hex}"
    table(spark, folder, "orders").createOrReplaceTempView(name)
    return run_sql(
        spark, f"SELECT o_orderkey, o_totalprice FROM {name} WHERE o_orderpriority = :priority AND o_totalprice >= :least",
        {"priority": "1-URGENT", "least": 400000.0},
    )


@query("SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 5")
def first_rows_of_file(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    path = scratch_dir(spark, "peek")
    write_csv(part, path)
    return peek(spark, path, 5, order=["p_partkey"], schema=part.schema)


@query("""
    WITH p AS (SELECT *, avg(o_totalprice) OVER (PARTITION BY o_orderpriority) AS prediction FROM orders),
    m AS (SELECT avg((o_totalprice - prediction) ** 2) AS mse, avg(abs(o_totalprice - prediction)) AS mae, var_pop(o_totalprice) AS v FROM p)
    SELECT 'popularity_regression' AS model, 'r2_score' AS metric, round(1 - mse / v, 8) AS value, NULL AS note FROM m UNION ALL
    SELECT 'popularity_regression', 'rmse', round(sqrt(mse), 4), NULL FROM m UNION ALL
    SELECT 'popularity_regression', 'mae', round(mae, 4), NULL FROM m UNION ALL
    SELECT 'genre_classification', NULL, NULL, 'no accuracy stored; train the model first' UNION ALL
    SELECT 'energy_regression', NULL, NULL, 'no errors stored; train the model first' UNION ALL
    SELECT 'clustering', NULL, NULL, 'no silhouette stored; train the model first' UNION ALL
    SELECT 'similar_songs', NULL, NULL, 'a neighbour index has no metrics'
""")
def stored_metrics(spark, folder):
    scores = rounded(regression_metrics(_priced(spark, folder), "o_totalprice", "prediction"), r2_score=8, rmse=4, mae=4)
    rows = scores.select(F.explode(F.create_map(
        F.lit("r2_score"), "r2_score", F.lit("rmse"), "rmse", F.lit("mae"), "mae")).alias("metric", "value"))
    path = scratch_dir(spark, "metrics")
    write_metrics(rows.withColumn("model", F.lit("popularity_regression")), path)
    return read_metrics(spark, path)


_COUNTED = ("click", "purchase")


def _event_stream(spark, folder):
    """The events table as a file stream with the columns of the interaction feed."""
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/events.parquet*")
    return stream.select(
        F.col("user_id").cast("string").alias("user_id"), F.get_json_object("props", "$.k").alias("track_id"),
        F.col("event_type").alias("action"), F.col("ts").cast("timestamp").alias("ts"), "event_id",
    )


@query("""
    SELECT user_id::VARCHAR AS user_id, props->>'$.k' AS track_id, event_type AS action, event_id
    FROM events WHERE event_type IN ('click', 'purchase')
""")
def stream_interaction_log(spark, folder):
    base = scratch_dir(spark, "log")
    counted = interactions(_event_stream(spark, folder), _COUNTED)
    write_log(counted, f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(counted.schema).parquet(f"{base}/rows").drop("ts")


@query("""
    WITH latest AS (
        SELECT user_id, props->>'$.k' AS track_id, ts, event_id FROM events WHERE event_type IN ('click', 'purchase')
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 50)
    SELECT user_id::VARCHAR AS user_id, string_agg(track_id, ',' ORDER BY ts, event_id) AS tracks, arg_max(event_id, (ts, event_id)) AS last_event_id
    FROM latest GROUP BY user_id
""")
def stream_last_interactions(spark, folder):
    base = scratch_dir(spark, "latest")
    lists = latest_tracks(interactions(_event_stream(spark, folder), _COUNTED), KEPT_INTERACTIONS)
    write_latest(lists, f"{base}/lists", f"{base}/checkpoint").awaitTermination()
    return read_latest(spark, f"{base}/lists").withColumn("tracks", F.array_join("tracks", ","))


def _delivered_twice(spark, folder):
    return _event_stream(spark, folder).unionByName(_event_stream(spark, folder))


@query("""
    SELECT user_id::VARCHAR AS user_id, props->>'$.k' AS track_id, event_type AS action, event_id
    FROM events WHERE event_type IN ('click', 'purchase')
""")
def stream_log_of_repeats(spark, folder):
    """Every event is delivered twice; the log has it once."""
    base = scratch_dir(spark, "log")
    counted = once(interactions(_delivered_twice(spark, folder), _COUNTED))
    write_log(counted, f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(counted.schema).parquet(f"{base}/rows").drop("ts")


@query("""
    WITH latest AS (
        SELECT user_id, props->>'$.k' AS track_id, ts, event_id FROM events WHERE event_type IN ('click', 'purchase')
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 10)
    SELECT user_id::VARCHAR AS user_id, string_agg(track_id, ',' ORDER BY ts, event_id) AS tracks, arg_max(event_id, (ts, event_id)) AS last_event_id
    FROM latest GROUP BY user_id
    HAVING max(ts) > (SELECT max(ts) FROM events WHERE event_type IN ('click', 'purchase')) - INTERVAL 2 DAY
""")
def stream_kept_tracks(spark, folder):
    """Lists of users with an event in the last two days, kept as state; every event is delivered twice."""
    base = scratch_dir(spark, "kept")
    lists = kept_tracks(interactions(_delivered_twice(spark, folder), _COUNTED), 10, ttl_seconds=2 * 86_400)
    target = ListTable(f"{base}/lists", every=1)
    write_lists(lists, target, f"{base}/checkpoint").awaitTermination()
    return target.read(spark).select("user_id", F.array_join("tracks", ",").alias("tracks"), "last_event_id")


@query("""
    WITH e AS (SELECT *, row_number() OVER (ORDER BY event_id DESC) AS position FROM events)
    SELECT position, event_id, user_id, event_type, 'row_' || (position - 1) AS row_id
    FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY position) = 1
""")
def first_in_file_order(spark, folder):
    """Several files whose order contradicts the keys: positions, ids in file order, and the first row of each user."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    path = scratch_dir(spark, "ordered")
    write_csv(events.repartitionByRange(5, F.desc("event_id")).sortWithinPartitions(F.desc("event_id")), path)
    numbered = ids_in_order(read_csv_in_order(spark, path), "row_id", "row_")
    return keep_first_in_file(numbered, ["user_id"]).select(
        "position", F.col("event_id").cast("long"), F.col("user_id").cast("long"), "event_type", "row_id")


@query("""
    SELECT p_partkey, p_name || ' é' AS p_name, p_retailprice, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS p_brand FROM part
""")
def mixed_folder(spark, folder):
    """One folder of files that differ in delimiter, encoding, and number and order of columns."""
    part = table(spark, folder, "part").withColumn("p_name", F.concat("p_name", F.lit(" é")))
    path = scratch_dir(spark, "mixed")
    even = part.filter("p_partkey % 2 = 0").select("p_partkey", "p_name", "p_retailprice", "p_brand")
    write_csv(even, path, ";", mode="append")
    odd = part.filter("p_partkey % 2 = 1").select("p_retailprice", "p_name", "p_partkey")
    odd.write.mode("append").option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').csv(path)
    return read_mixed(spark, path).select(
        F.col("p_partkey").cast("long"), "p_name", F.col("p_retailprice").cast("double"), "p_brand")


@query("""
    SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN round(c_acctbal + 2, 2) WHEN c_custkey % 2 = 0 THEN round(c_acctbal + 1, 2)
           ELSE c_acctbal END AS c_acctbal, 3 AS version
    FROM customer WHERE c_custkey % 3 > 0 OR c_custkey % 2 = 0
""")
def upsert_versions(spark, folder):
    """Two upserts of a table kept in versions, with new and known keys: the second works on the first one's result."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    path = scratch_dir(spark, "versions")
    customer.filter("c_custkey % 3 > 0").withColumn("id", F.col("c_custkey")).write.parquet(f"{path}/version=1")
    for step, part in ((1, 2), (2, 4)):
        changed = customer.filter(F.col("c_custkey") % part == 0).withColumn("c_acctbal", F.col("c_acctbal") + step)
        replace_by_upsert(spark, path, changed, "c_custkey", ["c_acctbal"], ["c_acctbal"])
    newest = current_version(spark, path)
    kept = spark.read.parquet(newest).drop("id").withColumn("version", F.lit(int(newest.rsplit("=", 1)[1])))
    return rounded(kept, c_acctbal=2)


@query("""
    SELECT event_id, user_id::VARCHAR AS user_id, event_type AS action FROM events
    WHERE event_id % 5 = 0 OR event_id % 7 = 0 OR props->>'$.k' IS NULL
""")
def rejected_events(spark, folder):
    """Events without a track or a time, as a side folder of the log holds them."""
    events = table(spark, folder, "events").select(
        "event_id", F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("action"),
        F.when(F.col("event_id") % 5 != 0, F.get_json_object("props", "$.k")).alias("track_id"),
        F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ts"))
    return rejected(events).select("event_id", "user_id", "action")


@query("""
    SELECT 'b' || (p_partkey % 50) AS track_id, arg_max(p_size, p_partkey)::DOUBLE AS energy FROM part GROUP BY 1
""")
def upload_in_file_order(spark, folder):
    """An upload, its name checked, of which the first row of each id in the file stays."""
    part = table(spark, folder, "part").orderBy(F.desc("p_partkey")).select(
        F.concat(F.lit("b"), F.col("p_partkey") % 50).alias("track_id"), F.col("p_size").alias("energy"))
    path = scratch_dir(spark, "upload") + ".csv"
    write_csv(part, path, ";")
    check_upload(path)
    return load_upload_in_order(spark, path, ["energy"])
