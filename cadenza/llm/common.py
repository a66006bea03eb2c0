"""What several operators of this folder share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.session import materialise

#: Characters that part words: space and U+0009 to U+000D. Everything else belongs to a word.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_ROWS = 2_000_000


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: later steps neither recompute it nor
    depend on what an executor holds."""
    return materialise(df, label)


def fresh(name: str) -> str:
    """A column name that no input column can have."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names; others cannot clash with what it adds."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a narrow stored table for broadcast if it has at most ``max_rows`` rows. The count reads only
    Parquet footers; beyond the bound the same join is a shuffle join, with the same result."""
    return F.broadcast(df) if df.count() <= max_rows else df


def n_words(text: str) -> Column:
    """Number of words of a text; 0 for NULL."""
    parts = F.filter(F.split(F.col(text), SPACE_CLASS + "+"), lambda w: w != "")
    return F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).cast("long")


def unsigned_crc32(text: str) -> Column:
    return F.crc32(F.encode(F.col(text), "UTF-8"))


def copies_key(text: str) -> Column:
    """128 bits of the text: equal for equal texts. NULL has a key of its own, unlike that of the empty text."""
    return F.coalesce(F.md5(F.encode(F.col(text), "UTF-8")), F.lit("null"))
