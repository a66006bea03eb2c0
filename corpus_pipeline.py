"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept and returns a DataFrame, which is written as Parquet and read again for the
next one; all but the last return the columns of ``documents``. NULL and empty texts fail the quality rules, so later stages
of a run do not see them; called by themselves, they treat them as their operators do. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm.line_dedup import drop_repeated_lines
from cadenza.llm.mixing import mix
from cadenza.llm.near_duplicates import keep_one
from cadenza.llm.packing import pack_documents
from cadenza.llm.quality_rules import keep_good
from cadenza.llm.queries import table, tokenizer_path
from cadenza.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or look unlike documents labelled good go."""
    return keep_good(docs, table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line, up to one edit or a few edits of words, go; documents stay, even if empty."""
    return drop_repeated_lines(docs, length="n_chars", is_stored=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target weights of its source ask for."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Hashed samples, coins and tokens have no SQL twin; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
