"""Registered queries: counts, statistics, validation, drift, metrics of given predictions."""

from __future__ import annotations


from pyspark.sql import functions as F

from cadenza.operators.metrics import (
    class_report, classification_metrics, confusion, confusion_wide, error_samples, regression_metrics, silhouette,
    silhouette_points,
)
from cadenza.operators.profile import (
    constant_columns, dataset_info, distinct_counts, duplicate_report, group_centroids, group_shares, group_sizes,
    iqr_bounds, missing_profile, modes, most_frequent_first, outlier_report, repeated_keys, small_classes,
    target_stats, value_counts,
)
from cadenza.operators.shift import auc, domain_report, shared_rows, weak_pairs
from cadenza.operators.silhouette import silhouette_estimate
from cadenza.operators.validate import (
    accuracy_gate, drift, evaluation_report, integrity_report, key_report, split_report, validation_report,
    verdict, weak_segments,
)
from cadenza.plans.registry import null_if, query, rounded, table
from cadenza.sources.tables import load_summary


@query("""
    SELECT coalesce(nullif(p_type, 'PROMO'), 'UNKNOWN_GENRE') AS p_type, count(*) AS "count" FROM part GROUP BY 1
""")
def value_counts_with_unknown(spark, folder):
    part = table(spark, folder, "part").withColumn("p_type", null_if("p_type", "PROMO"))
    return most_frequent_first(value_counts(part, "p_type", "UNKNOWN_GENRE"), "p_type")


@query("""
    SELECT nullif(p_type, 'PROMO') AS p_type, count(*) AS "count" FROM part WHERE nullif(p_type, 'PROMO') IS NOT NULL GROUP BY 1
""")
def category_counts_non_null(spark, folder):
    part = table(spark, folder, "part").withColumn("p_type", null_if("p_type", "PROMO"))
    return most_frequent_first(value_counts(part, "p_type"), "p_type")


@query("""
    SELECT nullif(p_type, 'PROMO') AS p_type, count(*) AS "count", (SELECT count(*) FROM part) AS total_rows FROM part GROUP BY 1
""")
def category_counts_with_total(spark, folder):
    return load_summary(table(spark, folder, "part").withColumn("p_type", null_if("p_type", "PROMO")), "p_type")


_GAPS = """
    SELECT nullif(l_discount, 0.0) AS l_discount, nullif(l_tax, 0.04) AS l_tax, nullif(l_returnflag, 'A') AS l_returnflag,
           l_quantity
    FROM lineitem
"""


def _with_gaps(spark, folder):
    return table(spark, folder, "lineitem").select(
        null_if("l_discount", 0.0).alias("l_discount"), null_if("l_tax", 0.04).alias("l_tax"),
        null_if("l_returnflag", "A").alias("l_returnflag"), "l_quantity",
    )


@query(f"""
    WITH raw AS ({_GAPS}), n AS (SELECT count(*) AS rows, count(l_discount) AS a, count(l_tax) AS b, count(l_returnflag) AS c FROM raw)
    SELECT 'l_discount' AS "column", rows, rows - a AS missing, round((rows - a) * 100.0 / rows, 6) AS missing_percent FROM n UNION ALL
    SELECT 'l_tax', rows, rows - b, round((rows - b) * 100.0 / rows, 6) FROM n UNION ALL
    SELECT 'l_returnflag', rows, rows - c, round((rows - c) * 100.0 / rows, 6) FROM n
""")
def missing_counts(spark, folder):
    profile = missing_profile(_with_gaps(spark, folder)).filter(F.col("missing") > 0)
    return rounded(profile, missing_percent=6)


@query("""
    SELECT 'l_partkey' AS "column", count(DISTINCT l_partkey) AS distinct_values FROM lineitem UNION ALL
    SELECT 'l_discount', count(DISTINCT nullif(l_discount, 0.0)) FROM lineitem UNION ALL
    SELECT 'l_returnflag', count(DISTINCT l_returnflag) FROM lineitem
""")
def distinct_values(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("l_discount", null_if("l_discount", 0.0))
    return distinct_counts(lines, ["l_partkey", "l_discount", "l_returnflag"])


@query("""
    SELECT count(*) AS rows, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std,
           min(o_totalprice) AS min, max(o_totalprice) AS max, round(median(o_totalprice), 4) AS median
    FROM orders
""")
def target_statistics(spark, folder):
    return rounded(target_stats(table(spark, folder, "orders"), "o_totalprice"), mean=4, std=4, median=4)


@query("""
    (SELECT 'l_linenumber' AS "column", l_linenumber::DOUBLE AS mode_number, NULL AS mode_text, count(*) AS "count"
     FROM lineitem GROUP BY l_linenumber ORDER BY count(*) DESC, l_linenumber LIMIT 1) UNION ALL
    (SELECT 'l_tax', l_tax, NULL, count(*) FROM lineitem GROUP BY l_tax ORDER BY count(*) DESC, l_tax LIMIT 1) UNION ALL
    (SELECT 'l_returnflag', NULL, l_returnflag, count(*) FROM lineitem GROUP BY l_returnflag ORDER BY count(*) DESC, l_returnflag LIMIT 1)
""")
def column_modes(spark, folder):
    return modes(table(spark, folder, "lineitem"), ["l_linenumber", "l_tax", "l_returnflag"])


_BOUNDS = """
    SELECT *, q1 - 3 * (q3 - q1) AS low, q3 + 3 * (q3 - q1) AS high FROM (
        SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
"""


@query(f"""
    SELECT 'value' AS "column", round(q1, 6) AS q1, round(q3, 6) AS q3, round(low, 6) AS low, round(high, 6) AS high,
           (SELECT count(*) FROM events WHERE value < low OR value > high) AS outliers, (SELECT count(*) FROM events) AS rows
    FROM ({_BOUNDS})
""")
def quantile_outliers(spark, folder):
    report = outlier_report(table(spark, folder, "events"), ["value"])
    return rounded(report, q1=6, q3=6, low=6, high=6)


@query("""
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem, (
        SELECT quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.75) AS q3 FROM lineitem)
    WHERE l_quantity < q1 OR l_quantity > q3
""")
def outside_quartiles(spark, folder):
    """Rows beyond the quartiles themselves (factor 0)."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    _, _, low, high = iqr_bounds(lines, ["l_quantity"], 0.0)["l_quantity"]
    return lines.filter((F.col("l_quantity") < low) | (F.col("l_quantity") > high))


@query("""
    WITH g AS (SELECT count(*) AS n FROM documents GROUP BY text, lang, source, n_chars)
    SELECT sum(n)::BIGINT AS rows, count(*) AS distinct_rows, (sum(n) - count(*))::BIGINT AS duplicates,
           round((sum(n) - count(*)) * 100.0 / sum(n), 6) AS duplicate_percent
    FROM g
""")
def duplicate_rows(spark, folder):
    documents = table(spark, folder, "documents").drop("doc_id")
    return rounded(duplicate_report(documents), duplicate_percent=6)


@query("""
    SELECT conv_id, count(*) AS "count" FROM conversations GROUP BY conv_id HAVING count(*) < 10
""")
def classes_below_minimum(spark, folder):
    return small_classes(table(spark, folder, "conversations"), "conv_id")


@query("""
    SELECT 'l_tax' AS "column", false AS constant UNION ALL SELECT 'fixed', true UNION ALL SELECT 'nothing', false
""")
def constant_column_flags(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_tax", F.lit(7.0).alias("fixed"), F.lit(None).cast("double").alias("nothing"))
    return constant_columns(lines)


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS "count" FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def repeated_key_values(spark, folder):
    return repeated_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    SELECT count(*) AS rows, 6 AS n_columns, 'p_partkey,p_name,p_brand,p_type,p_size,p_retailprice' AS columns, false AS custom FROM part
""")
def dataset_summary(spark, folder):
    return dataset_info(table(spark, folder, "part"))





def _validated(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_quantity", null_if("l_discount", 0.0).alias("l_discount"),
        F.when(F.col("l_tax") > 0.06, F.col("l_tax")).alias("l_tax"), "l_returnflag", F.lit(1.0).alias("fixed"),
    )


_QUALITY_SQL = """
    raw AS (
        SELECT l_orderkey, l_quantity, nullif(l_discount, 0.0) AS l_discount,
               CASE WHEN l_tax > 0.06 THEN l_tax END AS l_tax, l_returnflag, 1.0::DOUBLE AS fixed
        FROM lineitem),
    n AS (SELECT count(*) AS n, count(l_discount) AS d, count(l_tax) AS t FROM raw),
    classes AS (SELECT l_returnflag, count(*) AS c FROM raw WHERE l_returnflag IS NOT NULL GROUP BY 1),
    copies AS (SELECT sum(c - 1) AS dup, sum(c) AS n FROM (
        SELECT count(*) AS c FROM raw GROUP BY l_orderkey, l_quantity, l_discount, l_tax, l_returnflag, fixed)),
    missing AS (
        SELECT unnest(['l_orderkey', 'l_quantity', 'l_discount', 'l_tax', 'l_returnflag', 'fixed']) AS c,
               unnest([0, 0, (n - d) * 100.0 / n, (n - t) * 100.0 / n, 0, 0]::DOUBLE[]) AS v FROM n),
    q AS (
        SELECT 'l_orderkey' AS c, quantile_cont(l_orderkey, 0.25) AS q1, quantile_cont(l_orderkey, 0.75) AS q3 FROM raw UNION ALL
        SELECT 'l_quantity', quantile_cont(l_quantity, 0.25), quantile_cont(l_quantity, 0.75) FROM raw UNION ALL
        SELECT 'l_discount', quantile_cont(l_discount, 0.25), quantile_cont(l_discount, 0.75) FROM raw UNION ALL
        SELECT 'l_tax', quantile_cont(l_tax, 0.25), quantile_cont(l_tax, 0.75) FROM raw),
    long AS (
        SELECT 'l_orderkey' AS c, l_orderkey::DOUBLE AS v FROM raw UNION ALL SELECT 'l_quantity', l_quantity FROM raw UNION ALL
        SELECT 'l_discount', l_discount FROM raw UNION ALL SELECT 'l_tax', l_tax FROM raw),
    outliers AS (
        SELECT c, count(*) FILTER (v < q1 - 3 * (q3 - q1) OR v > q3 + 3 * (q3 - q1)) / (SELECT n FROM n) AS f
        FROM long JOIN q USING (c) WHERE q3 > q1 GROUP BY c),
    quality AS (
        SELECT 'class_size' AS "check", l_returnflag AS "column", c::DOUBLE AS value, 10.0::DOUBLE AS threshold, 'error' AS severity, false AS passed
        FROM classes WHERE c < 10 UNION ALL
        SELECT 'small_classes', 'l_returnflag', count(*) FILTER (c < 10), 0, 'error', count(*) FILTER (c < 10) = 0 FROM classes UNION ALL
        SELECT 'missing_percent', c, round(v, 6), 50, 'error', v <= 50 FROM missing UNION ALL
        SELECT 'duplicate_fraction', NULL, round(dup / n, 6), 0.1, 'error', dup <= n * 0.1 FROM copies),
    distribution AS (
        SELECT 'constant' AS "check", c AS "column", CASE WHEN c = 'fixed' THEN 1.0 ELSE 0.0 END::DOUBLE AS value, 0.0::DOUBLE AS threshold,
               'warning' AS severity, c <> 'fixed' AS passed
        FROM (SELECT unnest(['l_orderkey', 'l_quantity', 'l_discount', 'l_tax', 'fixed']) AS c) UNION ALL
        SELECT 'outlier_fraction', c, round(f, 6), 0.05, 'warning', f <= 0.05 FROM outliers)
"""


@query(f"""
    WITH {_QUALITY_SQL}
    SELECT 'schema' AS "check", 'l_orderkey' AS "column", 1.0::DOUBLE AS value, 1.0::DOUBLE AS threshold, 'error' AS severity, true AS passed UNION ALL
    SELECT 'schema', 'tempo', 0.0, 1.0, 'error', false UNION ALL
    SELECT * FROM quality UNION ALL SELECT * FROM distribution
""")
def full_validation(spark, folder):
    return rounded(validation_report(_validated(spark, folder), "l_returnflag", ["l_orderkey", "tempo"]), value=6)


@query(f"""
    WITH {_QUALITY_SQL}, report AS (SELECT * FROM quality UNION ALL SELECT * FROM distribution)
    SELECT count(*) FILTER (NOT passed AND severity = 'error') AS errors,
           count(*) FILTER (NOT passed AND severity = 'warning') AS warnings,
           count(*) FILTER (NOT passed AND severity = 'error') = 0 AS passed
    FROM report
""")
def integrity_verdict(spark, folder):
    return verdict(integrity_report(_validated(spark, folder), "l_returnflag"))


@query("""
    WITH a AS (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1),
         b AS (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
    SELECT 'unique_key' AS "check", 'o_orderkey' AS "column", (SELECT count(*) FROM a)::DOUBLE AS value, 0.0::DOUBLE AS threshold,
           'error' AS severity, (SELECT count(*) FROM a) = 0 AS passed UNION ALL
    SELECT 'unique_key', 'l_orderkey', (SELECT count(*) FROM b), 0.0, 'error', (SELECT count(*) FROM b) = 0
""")
def key_uniqueness(spark, folder):
    return key_report(table(spark, folder, "orders"), ["o_orderkey"]).unionByName(
        key_report(table(spark, folder, "lineitem"), ["l_orderkey"]))


def _drift_sql(a: str, b: str, columns) -> str:
    """Oracle of the drift figures of two relations over ten quantile buckets of the first."""
    def long(relation):
        return " UNION ALL ".join(f"SELECT '{c}' AS c, {c} AS v FROM {relation} WHERE {c} IS NOT NULL" for c in columns)

    return f"""
    la AS ({long(a)}), lb AS ({long(b)}),
    edges AS (SELECT DISTINCT c, e FROM (
        SELECT c, unnest(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM la GROUP BY c)),
    cells AS (SELECT c, unnest(range(count(*) + 1)) AS bucket FROM edges GROUP BY c),
    na AS (SELECT c, bucket, count(*) AS n FROM (
        SELECT la.c, (SELECT count(*) FROM edges e WHERE e.c = la.c AND la.v > e.e) AS bucket FROM la) GROUP BY ALL),
    nb AS (SELECT c, bucket, count(*) AS n FROM (
        SELECT lb.c, (SELECT count(*) FROM edges e WHERE e.c = lb.c AND lb.v > e.e) AS bucket FROM lb) GROUP BY ALL),
    shares AS (
        SELECT c, bucket, coalesce(na.n, 0) / sum(coalesce(na.n, 0)) OVER (PARTITION BY c) AS pa,
               coalesce(nb.n, 0) / sum(coalesce(nb.n, 0)) OVER (PARTITION BY c) AS pb
        FROM cells LEFT JOIN na USING (c, bucket) LEFT JOIN nb USING (c, bucket)),
    gaps AS (SELECT *, abs(sum(pa) OVER (PARTITION BY c ORDER BY bucket) - sum(pb) OVER (PARTITION BY c ORDER BY bucket)) AS gap FROM shares),
    measured AS (
        SELECT c, sum((greatest(pb, 0.0001) - greatest(pa, 0.0001)) * ln(greatest(pb, 0.0001) / greatest(pa, 0.0001))) AS psi,
               max(gap) AS ks
        FROM gaps GROUP BY c)
    """


_DRIFT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]
_HALVES = """
    a AS (SELECT * FROM lineitem WHERE l_linestatus = 'O'), b AS (SELECT * FROM lineitem WHERE l_linestatus <> 'O')
"""


@query(f"""
    WITH {_HALVES}, {_drift_sql('a', 'b', _DRIFT_COLUMNS)}
    SELECT c AS "column", round(psi, 8) AS psi, round(ks, 8) AS ks FROM measured
""")
def feature_drift(spark, folder):
    lines = table(spark, folder, "lineitem")
    is_open = F.col("l_linestatus") == "O"
    return rounded(drift(lines.filter(is_open), lines.filter(~is_open), _DRIFT_COLUMNS), psi=8, ks=8)


@query(f"""
    WITH {_HALVES}, {_drift_sql('a', 'b', ['l_quantity'])},
    unseen AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_returnflag FROM b WHERE l_returnflag NOT IN (SELECT l_returnflag FROM a)))
    SELECT 'unseen_labels' AS "check", 'l_returnflag' AS "column", n::DOUBLE AS value, 0.0::DOUBLE AS threshold, 'error' AS severity, n = 0 AS passed
    FROM unseen UNION ALL
    SELECT 'drift_psi', c, round(psi, 8), 0.2, 'warning', psi <= 0.2 FROM measured
""")
def train_test_checks(spark, folder):
    lines = table(spark, folder, "lineitem")
    is_open = F.col("l_linestatus") == "O"
    report = split_report(lines.filter(is_open), lines.filter(~is_open), "l_returnflag", ["l_quantity"])
    return rounded(report, value=8)


@query("""
    WITH j AS (SELECT quality, toxic, n_chars FROM labels JOIN documents USING (doc_id)),
    e AS (SELECT unnest(quantile_cont(n_chars, [0.25, 0.5, 0.75])) AS e FROM j)
    SELECT (SELECT count(*) FROM e WHERE n_chars > e.e) AS bucket, count(*) AS rows,
           round(avg(CASE WHEN quality <> toxic THEN 1.0 ELSE 0.0 END), 6) AS error_rate, min(n_chars) AS low, max(n_chars) AS high
    FROM j GROUP BY 1
""")
def weak_segment_errors(spark, folder):
    judged = table(spark, folder, "labels").join(table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id")
    return rounded(weak_segments(judged, "n_chars", "quality", "toxic"), error_rate=6)


_PREDICTED_SQL = """
    p AS (SELECT l_returnflag AS label, CASE WHEN l_linestatus = 'O' THEN 'N' WHEN l_tax > 0.04 THEN 'X' ELSE 'R' END AS prediction FROM lineitem)
"""


def _predicted(spark, folder):
    prediction = F.when(F.col("l_linestatus") == "O", "N").when(F.col("l_tax") > 0.04, "X").otherwise("R")
    return table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("label"), prediction.alias("prediction"))


@query(f"""WITH {_PREDICTED_SQL} SELECT label, prediction, count(*) AS "count" FROM p GROUP BY ALL""")
def confusion_counts(spark, folder):
    return confusion(_predicted(spark, folder), "label", "prediction")


@query(f"""
    WITH {_PREDICTED_SQL}
    SELECT label, count(*) FILTER (prediction = 'N') AS "predicted_N", count(*) FILTER (prediction = 'R') AS "predicted_R",
           count(*) FILTER (prediction = 'X') AS "predicted_X"
    FROM p GROUP BY ALL
""")
def confusion_matrix(spark, folder):
    return confusion_wide(_predicted(spark, folder), "label", "prediction", ["N", "R", "X"])


_REPORT_SQL = f"""
    {_PREDICTED_SQL}, names AS (SELECT label AS k FROM p UNION SELECT prediction FROM p),
    totals AS (
        SELECT k, (SELECT count(*) FROM p WHERE label = k) AS support, (SELECT count(*) FROM p WHERE prediction = k) AS predicted,
               (SELECT count(*) FROM p WHERE prediction = k AND label = k) AS correct FROM names),
    rates AS (
        SELECT *, CASE WHEN predicted > 0 THEN correct / predicted ELSE 0 END AS pr, CASE WHEN support > 0 THEN correct / support ELSE 0 END AS re FROM totals),
    report AS (SELECT *, CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END AS f FROM rates),
    total AS (
        SELECT sum(correct) / sum(support) AS accuracy, sum(pr * support) / sum(support) AS precision,
               sum(re * support) / sum(support) AS recall, sum(f * support) / sum(support) AS f1_score FROM report)
"""


@query(f"""
    WITH {_REPORT_SQL}
    SELECT k AS class, round(pr, 6)::DOUBLE AS precision, round(re, 6)::DOUBLE AS recall, round(f, 6)::DOUBLE AS f1_score, support, predicted, correct FROM report
""")
def classification_report(spark, folder):
    return rounded(class_report(_predicted(spark, folder), "label", "prediction"), precision=6, recall=6, f1_score=6)


@query(f"""
    WITH {_REPORT_SQL}
    SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score FROM total
""")
def classification_scores(spark, folder):
    scores = classification_metrics(_predicted(spark, folder), "label", "prediction")
    return rounded(scores, accuracy=6, precision=6, recall=6, f1_score=6)


@query(f"""
    WITH {_REPORT_SQL}
    SELECT 'accuracy' AS "check", 'prediction' AS "column", round(accuracy, 6) AS value, 0.5::DOUBLE AS threshold, 'error' AS severity,
           accuracy >= 0.5 AS passed FROM total
""")
def minimum_accuracy(spark, folder):
    return rounded(accuracy_gate(_predicted(spark, folder), "label", "prediction"), value=6)


@query(f"""
    WITH {_REPORT_SQL}
    SELECT 'all' AS split, 'accuracy' AS metric, round(accuracy, 6) AS value FROM total UNION ALL
    SELECT 'all', 'precision', round(precision, 6) FROM total UNION ALL SELECT 'all', 'recall', round(recall, 6) FROM total UNION ALL
    SELECT 'all', 'f1_score', round(f1_score, 6) FROM total UNION ALL
    SELECT 'all', 'baseline_accuracy', round(max(n) / sum(n), 6) FROM (SELECT count(*) AS n FROM p GROUP BY label)
""")
def model_evaluation(spark, folder):
    return rounded(evaluation_report(_predicted(spark, folder), "label", "prediction", "all"), value=6)


_PRICE_SQL = "p AS (SELECT *, avg(o_totalprice) OVER (PARTITION BY o_orderpriority) AS prediction FROM orders)"


def _priced(spark, folder):
    """Orders beside the mean price of their priority: five means, joined back."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    means = orders.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("prediction"))
    return orders.join(means, "o_orderpriority")


@query(f"""
    WITH {_PRICE_SQL}, m AS (
        SELECT avg((o_totalprice - prediction) ** 2) AS mse, avg(abs(o_totalprice - prediction)) AS mae, var_pop(o_totalprice) AS v FROM p)
    SELECT round(1 - mse / v, 8) AS r2_score, round(mse, 0) AS mse, round(sqrt(mse), 4) AS rmse, round(mae, 4) AS mae FROM m
""")
def regression_scores(spark, folder):
    scores = regression_metrics(_priced(spark, folder), "o_totalprice", "prediction")
    return rounded(scores, r2_score=8, mse=0, rmse=4, mae=4)


@query(f"""
    WITH {_PRICE_SQL}
    SELECT o_orderkey, o_totalprice, round(prediction, 4) AS prediction, round(abs(o_totalprice - prediction), 4) AS abs_error
    FROM p ORDER BY o_orderkey LIMIT 10
""")
def prediction_error_sample(spark, folder):
    sample = error_samples(_priced(spark, folder), "o_totalprice", "prediction", "o_orderkey")
    return rounded(sample.drop("o_orderpriority"), prediction=4, abs_error=4)


@query("""
    SELECT label, count(*) AS "count", round(count(*) * 100.0 / (SELECT count(*) FROM embeddings), 6) AS percent FROM embeddings GROUP BY 1
""")
def cluster_sizes(spark, folder):
    return rounded(group_sizes(table(spark, folder, "embeddings"), "label"), percent=6)


@query("""
    SELECT c_nationkey, c_mktsegment, count(*) AS "count", sum(count(*)) OVER (PARTITION BY c_nationkey)::BIGINT AS group_rows,
           round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY c_nationkey), 6) AS percent
    FROM customer GROUP BY 1, 2
""")
def cluster_category_shares(spark, folder):
    return rounded(group_shares(table(spark, folder, "customer"), "c_nationkey", "c_mktsegment"), percent=6)


@query("""
    SELECT l_returnflag, round(avg(l_quantity), 6) AS l_quantity, round(avg(l_discount), 6) AS l_discount, round(avg(l_tax), 6) AS l_tax
    FROM lineitem GROUP BY 1
""")
def cluster_centroids(spark, folder):
    centroids = group_centroids(table(spark, folder, "lineitem"), "l_returnflag", ["l_quantity", "l_discount", "l_tax"])
    return rounded(centroids, l_quantity=6, l_discount=6, l_tax=6)


_SILHOUETTE_SQL = """
    e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    d AS (
        SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.v, b.v)) AS total, count(*) AS n
        FROM e a, e b WHERE a.vec_id <> b.vec_id GROUP BY ALL),
    s AS (
        SELECT vec_id, label, max(CASE WHEN other = label THEN total / n END) AS a, min(CASE WHEN other <> label THEN total / n END) AS b
        FROM d GROUP BY ALL),
    points AS (SELECT vec_id, label, CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM s)
"""


@query(f"WITH {_SILHOUETTE_SQL} SELECT vec_id AS key, label::VARCHAR AS cluster, round(silhouette, 6) AS silhouette FROM points")
def silhouette_per_point(spark, folder):
    return rounded(silhouette_points(table(spark, folder, "embeddings"), "vec_id", "embedding", "label"), silhouette=6)


@query(f"WITH {_SILHOUETTE_SQL} SELECT round(avg(silhouette), 6) AS silhouette_score, count(*) AS points FROM points")
def silhouette_score(spark, folder):
    return rounded(silhouette(table(spark, folder, "embeddings"), "vec_id", "embedding", "label"), silhouette_score=6)


@query(f"""
    WITH {_SILHOUETTE_SQL}
    SELECT count(*) AS rows, round(avg(silhouette), 6) AS silhouette_score, TRUE AS within, TRUE AS narrow FROM points
""")
def silhouette_within_error(spark, folder):
    """The estimate over all points, and whether it lies within the bound of the estimate over sampled ones, which must be
    as narrow as asked for."""
    points = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    exact = silhouette_estimate(points, "vec_id", "embedding", "label", error=0.0).first()["silhouette_score"]
    return silhouette_estimate(points, "vec_id", "embedding", "label", error=0.005, first=256).select(
        "rows", F.round(F.lit(exact), 6).alias("silhouette_score"),
        (F.abs(F.col("silhouette_score") - F.lit(exact)) <= F.col("error") + 1e-9).alias("within"),
        (F.col("error") <= 0.005).alias("narrow"))


@query("""
    WITH a AS (SELECT c_nationkey, c_mktsegment FROM customer WHERE c_custkey % 7 > 0),
    b AS (SELECT c_nationkey, c_mktsegment FROM customer WHERE c_custkey % 7 = 0)
    SELECT c_nationkey, c_mktsegment, train_rows, test_rows
    FROM (SELECT c_nationkey, c_mktsegment, count(*) AS train_rows FROM a GROUP BY 1, 2)
    JOIN (SELECT c_nationkey, c_mktsegment, count(*) AS test_rows FROM b GROUP BY 1, 2) USING (c_nationkey, c_mktsegment)
""")
def rows_in_both_parts(spark, folder):
    rows = table(spark, folder, "customer")
    test = F.col("c_custkey") % 7 == 0
    columns = ["c_nationkey", "c_mktsegment"]
    return shared_rows(rows.filter(~test).select(*columns), rows.filter(test).select(*columns))


@query("""
    WITH s AS (SELECT round(l_extendedprice, -2) AS s, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS y FROM lineitem),
    g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY s),
    r AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS under FROM g)
    SELECT round((sum(pos * (under + neg / 2)) / (sum(pos)::DOUBLE * sum(neg)))::DOUBLE, 9) AS auc,
           sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives
    FROM r
""")
def auc_of_scores(spark, folder):
    """The rank statistic behind the domain classifier, on a score with many ties."""
    lines = table(spark, folder, "lineitem").select(
        F.round("l_extendedprice", -2).alias("score"), F.when(F.col("l_quantity") > 25, 1).otherwise(0).alias("label"))
    return rounded(auc(lines, "score", "label"), auc=9)


@query()
def multivariate_drift(spark, folder):
    """Whether open and closed order lines can be told apart by four columns together."""
    lines = table(spark, folder, "lineitem").withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    is_open = F.col("l_linestatus") == "O"
    return domain_report(lines.filter(is_open), lines.filter(~is_open),
                         ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "key")


_PAIR_FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]


@query(f"""
    WITH p AS (
        SELECT *, CASE WHEN l_quantity > 40 AND l_discount > 0.07 THEN 1 WHEN l_orderkey % 20 = 0 THEN 1 ELSE 0 END AS wrong FROM lineitem),
    e AS (SELECT {", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS e_{c}" for c in _PAIR_FEATURES)} FROM p),
    long AS ({" UNION ALL ".join(
        f"SELECT p.rowid AS r, wrong, '{c}' AS f, {i} AS i, len(list_filter(list_distinct(e_{c}), lambda x: {c} > x)) AS bucket FROM (SELECT row_number() OVER () AS rowid, * FROM p) p, e"
        for i, c in enumerate(_PAIR_FEATURES))}),
    single AS (SELECT f, bucket, count(*) AS rows, avg(wrong) AS rate FROM long GROUP BY ALL HAVING count(*) >= 100),
    pairs AS (
        SELECT a.f AS feature_a, a.bucket AS bucket_a, b.f AS feature_b, b.bucket AS bucket_b, count(*) AS rows, avg(a.wrong) AS error_rate
        FROM long a JOIN long b ON a.r = b.r AND a.i < b.i GROUP BY ALL HAVING count(*) >= 100)
    SELECT feature_a, bucket_a::INTEGER AS bucket_a, feature_b, bucket_b::INTEGER AS bucket_b, pairs.rows, round(error_rate, 8) AS error_rate,
           round(error_rate - greatest(x.rate, y.rate), 8) AS excess
    FROM pairs JOIN single x ON feature_a = x.f AND bucket_a = x.bucket JOIN single y ON feature_b = y.f AND bucket_b = y.bucket
    WHERE error_rate - greatest(x.rate, y.rate) >= 0.1
""")
def weak_feature_pairs(spark, folder):
    """Order lines judged wrong where quantity and discount are both high: no single feature shows it as clearly."""
    planted = (F.col("l_quantity") > 40) & (F.col("l_discount") > 0.07)
    lines = table(spark, folder, "lineitem").withColumns({
        "label": F.lit(0), "prediction": F.when(planted | (F.col("l_orderkey") % 20 == 0), 1).otherwise(0)})
    return rounded(weak_pairs(lines, _PAIR_FEATURES, "label", "prediction"), error_rate=8, excess=8)
