"""Folders whose files differ in delimiter, encoding and columns, read in one pass over them.

Lines are staged as they are, bytes included. A file's header and whether all of its lines are valid UTF-8 are one
aggregate over the stage; files of the same header, delimiter and encoding are parsed together and joined by column name.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.session import materialise, small_side
from cadenza.sources.delimited import DELIMITERS, MISSING_TOKENS, detect_delimiter, missing_tokens_to_null


def _names(header: str, sep: str) -> list[str]:
    """Column names of a header; empty or repeated ones get their place as a name."""
    out = []
    for i, name in enumerate(next(csv.reader([header], delimiter=sep))):
        name = name.strip()
        out.append(f"_c{i}" if not name or name.lower() in [n.lower() for n in out] else name)
    return out


def file_formats(lines: DataFrame, candidates: Sequence[str] = DELIMITERS) -> DataFrame:
    """One row per file with a line that is not blank: ``file``, ``header``, ``sep``, ``latin`` and the header's place
    ``header_start``, ``header_at``. ``lines`` has ``file``, ``start``, ``at``, ``value``. One row per file reaches the
    driver, which has listed the files before."""
    found = lines.groupBy("file").agg(
        F.min(F.struct("start", "at", "value")).alias("first"), (F.count_if(~F.is_valid_utf8("value")) > 0).alias("latin"),
        (F.count_if(F.col("value").contains("\x00")) > 0).alias("zero"))
    header = F.when(F.col("latin"), F.decode(F.col("first.value").cast("binary"), "ISO-8859-1")).otherwise(F.col("first.value"))
    rows = found.select("file", "latin", "zero", "first.start", "first.at", F.ltrim(header, F.lit("\ufeff")).alias("header")).collect()
    wide = [r["file"] for r in rows if r["zero"]]
    if wide:
        raise ValueError(f"files with zero bytes, perhaps UTF-16: {wide[:5]}")
    return lines.sparkSession.createDataFrame(
        [(r["file"], r["header"], detect_delimiter(r["header"], candidates), r["latin"], r["start"], r["at"]) for r in rows],
        "file string, header string, sep string, latin boolean, header_start long, header_at long")


def read_mixed(spark: SparkSession, path: str | Sequence[str], file_column: str | None = None,
               candidates: Sequence[str] = DELIMITERS, missing: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """All files of a folder as text columns, whatever each one's delimiter, encoding and order of columns.

    A file is UTF-8 if all of its lines are, else Latin-1; its delimiter is the candidate that occurs most in its header.
    Columns of one name are one column, in any case, spelt as in the first header that has it (headers by code point); a file without a column has NULL there.
    ``file_column`` names a column for the file's path. Blank lines and files without any other lines give no rows, and
    a folder of such files no columns. Fields must not hold line breaks. Plans grow with the number of different formats.
    """
    # A row's place in its split; the header is the first line of the first split that has one.
    lines = materialise(spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at")).filter(F.trim("value") != ""), "mixed-lines")
    formats = materialise(file_formats(lines, candidates), "mixed-formats")
    kinds = formats.select("header", "sep", "latin").distinct().orderBy("header", "sep", "latin").collect()
    spelt: dict[str, str] = {}
    whole = None
    for kind in kinds:
        names = [spelt.setdefault(n.lower(), n) for n in _names(kind["header"], kind["sep"])]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        same = formats.filter((F.col("header") == kind["header"]) & (F.col("sep") == kind["sep"]) & (F.col("latin") == kind["latin"]))
        rows = lines.join(small_side(same.select("file", "header_start", "header_at")), "file").filter(
            (F.col("start") != F.col("header_start")) | (F.col("at") != F.col("header_at")))
        text = F.decode(F.col("value").cast("binary"), "ISO-8859-1") if kind["latin"] else F.col("value")
        cells = F.from_csv(text, schema.toDDL(), {"sep": kind["sep"], "escape": '"'})
        parsed = rows.select("file", cells.alias("cells"))
        parsed = parsed.select(*[F.col("cells").getField(n).alias(n) for n in names],
                               *([F.col("file").alias(file_column)] if file_column else []))
        whole = parsed if whole is None else whole.unionByName(parsed, allowMissingColumns=True)
    if whole is None:
        return spark.createDataFrame([], T.StructType([]))
    if file_column:
        if file_column.lower() in spelt:
            raise ValueError(f"the files have a column {file_column!r}")
        whole = whole.select(*[F.col(f"`{c}`") for c in spelt.values()], file_column)
    return missing_tokens_to_null(whole, missing)
