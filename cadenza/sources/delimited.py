"""Delimited files: read, sniff, clean, write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.constants import CORE_FEATURES
from cadenza.functions.names import borrow_id_column, clean_names, clean_upload_names, rename_aliases
from cadenza.functions.scalar import last_path_segment, normalize_loudness, to_number
from cadenza.operators.clean import coerce_and_fill, first_per_key, nan_to_null
from cadenza.operators.sampling import sequential_ids

# Delimiters tried for an uploaded file, first wins on a tie.
DELIMITERS = [";", ",", "\t"]
# Cells that mean "missing" (the empty cell is NULL anyway).
MISSING_TOKENS = ["#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
                  "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8",
             schema: T.StructType | str | None = None, infer: bool = False, multiline: bool = False,
             missing: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Read a file with a header. Without a schema all columns are text, unless ``infer`` pays a second scan.

    Cells that are one of the ``missing`` tokens, and NaN in number columns, are NULL.

    ``multiline`` allows line breaks in quoted fields, at the price of one task per file.
    """
    reader = (
        spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
        .option("multiLine", multiline).option("escape", '"')
    )
    if schema is not None:
        typed = reader.schema(schema).option("enforceSchema", False).csv(path)
        return nan_to_null(missing_tokens_to_null(typed, missing))
    text = missing_tokens_to_null(reader.csv(path), missing)
    return infer_numbers(text) if infer else text


def missing_tokens_to_null(df: DataFrame, tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Text that stands for a missing value becomes NULL, as the files' writers mean it."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not tokens or not text:
        return df
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(list(tokens)), F.col(f"`{c}`")) for c in text})


def infer_numbers(df: DataFrame) -> DataFrame:
    """Types of text columns, by all of their cells; one scan.

    Only whole numbers: int, bigint, or decimal(38,0) as the widest asks for. Only numbers: double. Only true and false, in
    any case: boolean. Anything else, whole numbers of more than 38 digits among it, stays text, so that no digit is lost.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return df
    tests = {}
    for i, c in enumerate(names):
        v = F.trim(F.col(f"`{c}`"))
        whole = v.rlike(r"^[+-]?[0-9]+$")
        fits = lambda kind: F.coalesce(v.try_cast(kind).isNotNull(), F.lit(False))  # noqa: B023, E731
        tests[f"n{i}"] = F.count(v)
        tests[f"w{i}"] = F.count_if(whole)
        for key, kind in (("i", "int"), ("l", "bigint"), ("m", "decimal(38,0)")):
            tests[f"{key}{i}"] = F.count_if(whole & fits(kind))
        tests[f"d{i}"] = F.count_if(F.coalesce(to_number(v).isNotNull(), F.lit(False)))
        # a double would change these: whole numbers among fractions that a double does not hold
        tests[f"x{i}"] = F.count_if(whole & (F.length(F.regexp_replace(v, "^[+-]?0*", "")) > 15)
                                    & (v.try_cast("double").try_cast("decimal(38,0)") != v.try_cast("decimal(38,0)")))
        tests[f"b{i}"] = F.count_if(F.lower(v).isin("true", "false"))
    row = df.agg(*[e.alias(k) for k, e in tests.items()]).first()
    kinds = {}
    for i, c in enumerate(names):
        n = row[f"n{i}"]
        if not n:
            continue
        value = F.trim(F.col(f"`{c}`"))
        for key, kind in (("i", "int"), ("l", "bigint"), ("m", "decimal(38,0)"), ("d", "double"), ("b", "boolean")):
            if row[f"{key}{i}"] == n and not (kind == "double" and (row[f"w{i}"] == n or row[f"x{i}"])):
                kinds[c] = value.try_cast(kind) if kind != "boolean" else F.lower(value) == "true"
                break
    return df.withColumns(kinds) if kinds else df


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).option("escape", '"').csv(path)


def peek(spark: SparkSession, path: str, rows: int = 5, order: Sequence[str] = (), **options) -> DataFrame:
    """A few rows: any, or the first in ``order``."""
    df = read_csv(spark, path, **options)
    return (df.orderBy(*order) if order else df).limit(rows)


def header_line(spark: SparkSession, path: str) -> str:
    first = spark.read.text(path).limit(1).collect()
    if not first or not first[0][0].strip():
        raise ValueError(f"empty file: {path}")
    return first[0][0].lstrip("\ufeff")


def detect_delimiter(line: str, candidates: Sequence[str] = DELIMITERS) -> str:
    """The candidate that occurs most often outside quotes."""
    plain = "".join(line.split('"')[::2])
    return max(candidates, key=lambda c: (plain.count(c), -candidates.index(c)))


def detect_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 unless some line is not valid UTF-8, then Latin-1; zero bytes mean UTF-16. One scan."""
    zero = F.col("value").contains("\x00")
    odd = spark.read.text(path).filter(zero | ~F.is_valid_utf8("value")).select(zero.alias("zero")).limit(1)
    found = odd.collect()
    if not found:
        return "UTF-8"
    return "UTF-16" if found[0]["zero"] else "ISO-8859-1"


def check_upload(path: str) -> None:
    if not path.rstrip("/").lower().endswith((".csv", ".txt", ".tsv")):
        raise ValueError("only delimited text files are accepted")


def read_upload(spark: SparkSession, path: str, check_suffix: bool = False, multiline: bool = False) -> DataFrame:
    """Read a file of unknown encoding and delimiter as text columns."""
    if check_suffix:
        check_upload(path)
    line = header_line(spark, path)
    return read_csv(spark, path, detect_delimiter(line), detect_encoding(spark, path), multiline=multiline)


def _fullest_first(df: DataFrame) -> list:
    """Total order of the rows of one id in which a missing value never wins over a present one."""
    return [F.asc_nulls_last(c) for c in df.columns if c != "track_id"] or ["track_id"]


def clean_upload(raw: DataFrame, numeric: Sequence[str] = CORE_FEATURES, order: Sequence[str] | None = None,
                 exact: bool = True) -> DataFrame:
    """Uploaded table: names, aliases, an id per row, first row per id, numbers with gaps filled.

    Without any id-like column rows are numbered ``custom_0 …`` by the hash of their content.
    """
    df = rename_aliases(clean_upload_names(raw))
    if "track_id" not in df.columns:
        borrowed = borrow_id_column(df)
        if borrowed is not None:
            df = df.withColumn("track_id", F.col(borrowed))
        else:
            df = sequential_ids(df, "track_id", "custom_")
    df = df.withColumn("track_id", F.col("track_id").cast("string"))
    df = first_per_key(df, ["track_id"], list(order or _fullest_first(df)))
    return coerce_and_fill(df, numeric, empty=0.0, exact=exact)


def clean_serving(raw: DataFrame, numeric: Sequence[str] = CORE_FEATURES, order: Sequence[str] | None = None,
                  exact: bool = True) -> DataFrame:
    """Served table: names, aliases, ids from urls, loudness, first row per id, numbers, medians, float32.

    The order matters: copies are removed before the medians are taken. ``order`` ranks the rows of
    one id; by default all columns do.
    """
    df = rename_aliases(clean_names(raw))
    if "track_id" not in df.columns and "song_url" in df.columns:
        df = df.withColumn("track_id", last_path_segment(F.col("song_url")))
    if "loudness" in df.columns:
        df = df.withColumn("loudness", normalize_loudness(F.col("loudness")))
    df = first_per_key(df, ["track_id"], list(order or _fullest_first(df)))
    df = coerce_and_fill(df, numeric, empty=None, exact=exact)
    return df.withColumns({c: F.col(c).cast("float") for c in numeric if c in df.columns})


def load_serving(spark: SparkSession, path: str, order: Sequence[str] | None = None) -> DataFrame:
    """The ``;``-separated served file."""
    return clean_serving(read_csv(spark, path, ";"), order=order)


def load_upload(spark: SparkSession, path: str, order: Sequence[str] | None = None) -> DataFrame:
    return clean_upload(read_upload(spark, path), order=order)
