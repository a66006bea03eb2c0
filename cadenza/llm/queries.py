"""Registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import toxicity
from cadenza.llm.classifier import classify
from cadenza.llm.common import stored
from cadenza.llm.lexical_search import search
from cadenza.llm.line_dedup import line_classes
from cadenza.llm.mixing import mix_counts
from cadenza.llm.near_duplicates import classes, report
from cadenza.llm.neighbours import nearest
from cadenza.llm.packing import pack_documents
from cadenza.llm.quality_rules import judge
from cadenza.llm.sharding import shard_documents
from cadenza.llm.token_counts import count_tokens
from cadenza.llm.warc import payload_report, read_archives, write_archives
from cadenza.llm.whitening import whiten
from cadenza.session import scratch_dir

TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function=None, sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return add(function) if function else add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_sharding(spark, folder):
    """Every document in one of eight shards of near equal bytes; equal texts stay together."""
    return shard_documents(table(spark, folder, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op2_mixing(spark, folder):
    """Words that the mix takes of every document; weights 5, 2, 1 in turn, at most three times a source."""
    return mix_counts(table(spark, folder, "documents"), store=lambda df: stored(df, "mix-rows")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query
def op3_line_dedup(spark, folder):
    """Class of near-equal lines that every line belongs to, its links, and whether it is the first of its class."""
    return line_classes(table(spark, folder, "documents")).drop("row")


@query
def op4_quality_rules(spark, folder):
    """Base counts of every document and the verdict of the likelihood ratio against documents labelled good."""
    trusted = table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    return judge(table(spark, folder, "documents"), trusted)


@query
def op5_neighbours(spark, folder):
    """Twenty nearest vectors by inner product of every twentieth vector."""
    return nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, 20)


@query
def op6_token_counts(spark, folder):
    """Tokens of every line of every document; a token that crosses a line's end belongs to the line it begins in."""
    return count_tokens(table(spark, folder, "documents"), tokenizer_path())


@query
def op7_packing(spark, folder):
    """Every document's tokens in sequences of 2048."""
    return pack_documents(table(spark, folder, "documents"), tokenizer_path())


@query
def op8_near_duplicates(spark, folder):
    """Class of near-equal documents that every document belongs to, and its links."""
    return report(stored(classes(table(spark, folder, "documents")), "near-classes"))


@query
def op9_quality_classifier(spark, folder):
    """Quality score of every document; a third of the labels is held out."""
    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(sql="""
WITH payload AS (
    SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
sized AS (
    SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest, body FROM payload),
first AS (SELECT body, max(page_id) AS response FROM sized WHERE payload_bytes >= 1000 GROUP BY body)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN response IS NULL OR page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> response THEN response END AS refers_to
FROM sized LEFT JOIN first USING (body)
""")
def op10_warc(spark, folder):
    """Pages written as WARC archives and read back: size, digest and kind of every record."""
    path = scratch_dir(spark, "warc")
    write_archives(table(spark, folder, "pages"), path)
    return payload_report(read_archives(spark, path))


@query
def op11_whitening(spark, folder):
    """Every usable vector's coordinates along the sixteen largest components, with unit variance."""
    return whiten(table(spark, folder, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


@query
def op12_toxicity(spark, folder):
    """Toxicity score of every document; a quarter of the labels is held out."""
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels")).select(
        "doc_id", "held_out", "score", "predicted")


@query(sql=r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents WHERE text IS NOT NULL),
sized AS (SELECT doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM words WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sized),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM sized) GROUP BY ALL),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM asked) GROUP BY term), total),
scored AS (
    SELECT item_id, doc_id,
        CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // length))))) AS BIGINT) AS score
    FROM asked JOIN weight USING (term) JOIN tf USING (term), total GROUP BY item_id, doc_id),
ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""")
def op13_lexical_search(spark, folder):
    """The ten best documents of every benchmark item."""
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), 10)
