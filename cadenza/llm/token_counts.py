"""Token counts of sections by offset mapping.

A whole document is encoded once, so tokens are those the model will see. Byte-level tokens cover the text without gaps:
their lengths in bytes give the span of characters of each token. Spans are joined to the sections of the document, and
a token that crosses a section's end goes by one rule: to the section that holds its first character (``first``), or to
the one that holds most of its characters, the earlier if two are level (``most``).

Sections are the lines of the text, each with the line end that closes it, or spans given as two array columns of
character positions (fields of a record written into one text, say), sorted and without overlap; tokens outside all of
them are counted under section -1.

Defined results: NULL text is the empty text; it has one empty line without tokens. NULL spans are no sections. A
character whose bytes are shared by tokens counts for each of them. Repeated rows are counted each by itself. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = ("first", "most")


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(x) for x in text.split("\n")], dtype=np.int64) + 1
    lengths[-1] -= 1
    ends = np.cumsum(lengths)
    return ends - lengths, ends


def token_spans(text: str, ids: np.ndarray, token_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last character of each token."""
    data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    ends = np.cumsum(token_bytes[ids])
    if len(ids) and ends[-1] != len(data):
        raise ValueError("the tokens do not cover the text: not a byte-level vocabulary")
    starts = np.concatenate([[0], ends[:-1]]) if len(ids) else ends
    if len(data) == len(text):
        return starts, ends
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    return character[starts], character[ends - 1] + 1


def allot(first: np.ndarray, end: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str):
    """Section of each token (-1: none) and whether the token crosses the end of the section it begins in."""
    if not len(starts):
        return np.full(len(first), -1), np.zeros(len(first), dtype=bool)
    section = np.searchsorted(starts, first, side="right") - 1
    inside = (section >= 0) & (first < ends[np.maximum(section, 0)])
    crosses = inside & (end > ends[np.maximum(section, 0)])
    section = np.where(inside, section, -1)
    if rule == "most":
        for i in np.flatnonzero(end - first > 1):
            near = np.arange(max(section[i], 0), np.searchsorted(starts, end[i], side="left"))
            held = np.minimum(ends[near], end[i]) - np.maximum(starts[near], first[i])
            if len(held) and held.max() > 0:
                section[i] = near[held.argmax()]
    return section, crosses


def count_sections(path: str, spans: bool, rule: str):
    """A function for ``mapInPandas``: documents become one row per section."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from cadenza.llm.encoding import encoder

        encode = encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            out, held = [], 0
            for i, ids in enumerate(encode.encode_all(texts)):
                if spans:
                    starts, ends = (np.asarray(batch[c].iat[i] if batch[c].iat[i] is not None else [], dtype=np.int64)
                                    for c in ("starts", "ends"))
                else:
                    starts, ends = line_spans(texts[i])
                section, crosses = allot(*token_spans(texts[i], ids, encode.token_bytes), starts, ends, rule)
                n = len(starts)
                counts = np.bincount(section + 1, minlength=n + 1)
                crossing = np.bincount(section + 1, weights=crosses, minlength=n + 1).astype(np.int64)
                if counts[0]:
                    starts, ends = np.concatenate([[-1], starts]), np.concatenate([[-1], ends])
                    named = np.arange(-1, n)
                else:
                    counts, crossing, named = counts[1:], crossing[1:], np.arange(n)
                out.append((np.full(len(named), i), named, starts, ends, counts, crossing))
                held += len(named)
                if held > 100_000:
                    yield rows_of(batch, out)
                    out, held = [], 0
            if out:
                yield rows_of(batch, out)

    return run


def rows_of(batch: pd.DataFrame, out: list[tuple]) -> pd.DataFrame:
    columns = [np.concatenate([x[k] for x in out]) for k in range(6)]
    return pd.DataFrame({
        "doc_id": batch["doc_id"].to_numpy()[columns[0]], "section": columns[1].astype(np.int32),
        "start": columns[2], "end": columns[3], "n_tokens": columns[4], "n_crossing": columns[5]})


def count_tokens(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", starts: str | None = None,
                 ends: str | None = None, rule: str = "first") -> DataFrame:
    """Per section: ``doc_id``, ``section`` (from 0), ``start`` and ``end`` (characters), ``n_tokens`` allotted to it and
    ``n_crossing``, those of them that cross the end of the section they begin in."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    columns = {"doc_id": id, "text": text} | ({"starts": starts, "ends": ends} if starts and ends else {})
    read = docs.select(*[F.col(f"`{c}`").alias(n) for n, c in columns.items()])
    kind = read.schema["doc_id"].dataType
    # pandas would turn whole numbers beside a NULL into floating point
    return read.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        count_sections(path, "starts" in columns, rule),
        "doc_id string, section int, start long, end long, n_tokens long, n_crossing long").withColumn(
        "doc_id", F.col("doc_id").cast(kind))
