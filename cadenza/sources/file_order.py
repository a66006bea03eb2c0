"""The order of rows in files: positions, first rows, and ids that follow them.

A reader's split (file and first byte) is read by one task from front to back. So a row's position is the number of rows
in the files before, plus those in the splits before, plus its place in the split. Rows are written once with the split
and place they came from; counts per split, a table of as many rows as there are splits, give the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.functions.names import borrow_id_column, clean_upload_names, rename_aliases
from cadenza.constants import CORE_FEATURES
from cadenza.operators.clean import first_per_key
from cadenza.session import materialise
from cadenza.sources.delimited import (
    MISSING_TOKENS, clean_upload, detect_delimiter, detect_encoding, header_line, missing_tokens_to_null)

POSITION = "position"
#: Splits whose offsets are sent to every task; about 8 MB. With more of them the join is a shuffle join.
BROADCAST_SPLITS = 100_000


def in_file_order(read: DataFrame, position: str = POSITION) -> DataFrame:
    """``read`` with the place of each row, from 1, counted over all files in the order of their names.

    ``read`` must come straight from a file reader, without a filter. Rows are those that the reader gives: headers and
    blank lines do not count. Equal rows keep places of their own. No rows give no rows. A column of the name ``position``
    in the files is an error.
    """
    if position in read.columns:
        raise ValueError(f"the files have a column {position!r}")
    inner = [f"c{i}" for i in range(len(read.columns))]
    marked = read.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(read.columns, inner)], F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    rows = materialise(marked, "file-order")
    splits = materialise(rows.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low")), "splits")
    # One row per file; the driver has listed all of them before.
    files = splits.groupBy("file").agg(F.sum("n").alias("n")).select("file", F.coalesce(F.sum("n").over(
        Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("files_before"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("splits_before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(files, "file").select(
        "file", "start", (F.col("files_before") + F.col("splits_before") - F.col("low") + 1).alias("shift"))
    if splits.count() <= BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    return rows.join(offsets, ["file", "start"]).select(
        *[F.col(n).alias(c) for c, n in zip(read.columns, inner)], (F.col("at") + F.col("shift")).alias(position))


def read_csv_in_order(spark: SparkSession, path: str | Sequence[str], sep: str = ",", encoding: str = "UTF-8",
                      position: str = POSITION, missing: Sequence[str] = MISSING_TOKENS, multiline: bool = False) -> DataFrame:
    """Files with a header as text columns, and each row's ``position``."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option(
        "multiLine", multiline).option("escape", '"')
    return missing_tokens_to_null(in_file_order(reader.csv(path), position), missing)


def first_rows(df: DataFrame, rows: int = 5, position: str = POSITION) -> DataFrame:
    """The first rows of the files."""
    return df.filter(F.col(position) <= rows)


def keep_first_in_file(df: DataFrame, keys: Sequence[str], position: str = POSITION) -> DataFrame:
    """Of the rows of equal keys the one that comes first in the files."""
    return first_per_key(df, list(keys), [position])


def ids_in_order(df: DataFrame, name: str, prefix: str, position: str = POSITION) -> DataFrame:
    """Ids ``prefix0, prefix1, …`` in the order of the files."""
    return df.withColumn(name, F.concat(F.lit(prefix), (F.col(position) - 1).cast("string")))


def load_upload_in_order(spark: SparkSession, path: str, numeric: Sequence[str] = CORE_FEATURES,
                         position: str = POSITION) -> DataFrame:
    """An uploaded table as ``clean_upload`` gives it, but of the rows of one id the first in the file stays, and rows
    without an id are numbered in its order."""
    raw = read_csv_in_order(spark, path, detect_delimiter(header_line(spark, path)), detect_encoding(spark, path), position)
    named = rename_aliases(clean_upload_names(raw))
    if "track_id" not in named.columns and borrow_id_column(named) is None:
        raw = ids_in_order(raw, "track_id", "custom_", position)
    return clean_upload(raw, numeric, order=[position]).drop(position)
