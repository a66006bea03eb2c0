"""Scalar column expressions. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza.constants import RATIO_EPSILON, SEED

_INFINITY = float("inf")


def product(a: str, b: str) -> Column:
    return F.col(a) * F.col(b)


def safe_ratio(a: str, b: str, epsilon: float = RATIO_EPSILON) -> Column:
    """``a / (b + epsilon)``; NULL where the denominator is zero."""
    return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double") + F.lit(epsilon))


def per_second(amount: str, duration_ms: str) -> Column:
    """``amount`` per second of duration; NULL for a zero duration."""
    return F.try_divide(F.col(amount).cast("double"), F.col(duration_ms) / F.lit(1000.0))


def distance_from(value: str, centre: float) -> Column:
    return F.abs(F.col(value) - F.lit(centre))


def finite(c: Column) -> Column:
    """NULL for NaN and the infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(_INFINITY)), c)


def finite_or_zero(c: Column) -> Column:
    """0.0 for NULL, NaN and the infinities: the serving-time rule."""
    return F.coalesce(finite(c.cast("double")), F.lit(0.0))


def to_number(c: Column) -> Column:
    """Text to double; NULL if it is not a number. Java's ``1.5f`` / ``1.5d`` do not count."""
    text = c.cast("string")
    value = F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))
    return F.when(~F.isnan(value), value)


def normalize_loudness(c: Column) -> Column:
    """Decibels in [-60, 0]: values beyond 60 are hundredths, missing is 0, non-numbers are -12."""
    text = F.trim(F.lower(c.cast("string")))
    value = to_number(c)
    scaled = F.when(F.abs(value) > 60, value / 100).otherwise(value)
    return (
        F.when(text.isNull() | text.isin("nan", "+nan", "-nan"), F.lit(0.0))
        .when(value.isNull(), F.lit(-12.0))
        .otherwise(F.greatest(F.lit(-60.0), F.least(F.lit(0.0), scaled)))
    )


def last_path_segment(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def clamp(c: Column, low: float, high: float) -> Column:
    bounded = F.least(F.greatest(c, F.lit(float(low))), F.lit(float(high)))
    return F.when(c.isNotNull(), bounded)


def rescale_loudness(c: Column) -> Column:
    return (c + F.lit(60.0)) / F.lit(60.0)


def label_missing(c: Column, label: str) -> Column:
    return F.coalesce(c, F.lit(label))


def digest(key: str | Column, seed: int = SEED) -> Column:
    """Hash of key and seed. Its order stands in for a seeded shuffle and ignores partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(str(seed))).cast("binary"))


def hash_bucket(key: str, buckets: int = 2) -> Column:
    """Stable bucket number of a key, for rows a rule cannot place."""
    head = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10)
    return F.pmod(head.cast("long"), F.lit(buckets))


def rounded_percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(part * F.lit(100.0) / whole, digits)


def row_digest(columns: Sequence[str], nested: Collection[str] = ()) -> Column:
    """256-bit digest of a row. Lengths are written out, so different rows have different texts.

    ``nested`` columns (arrays, maps, structs) are written as JSON, which quotes what is inside them.
    """
    parts = []
    for name in columns:
        text = F.to_json(F.struct(F.col(name))) if name in nested else F.col(name).cast("string")
        if name in nested:
            text = F.when(F.col(name).isNotNull(), text)
        parts.append(
            F.when(text.isNull(), F.lit("n;"))
            .otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))
        )
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def top_classes(names: Sequence[str], scores: Column, n: int = 3) -> Column:
    """The ``n`` best classes as ``array<struct<name, score>>``, ties by name."""
    pairs = F.zip_with(
        F.array(*[F.lit(x) for x in names]), scores,
        lambda name, score: F.struct((-score).alias("key"), name.alias("name"), score.alias("score")),
    )
    best = F.slice(F.array_sort(pairs), 1, n)
    return F.transform(best, lambda p: F.struct(p["name"].alias("name"), p["score"].alias("score")))


def score_map(names: Sequence[str], scores: Column) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(x) for x in names]), scores)


def text_matches(columns: Sequence[str], query: str, regex: bool = True) -> Column:
    """Case-insensitive match of ``query`` in any of the columns; NULL text never matches."""
    found = F.lit(False)
    for name in columns:
        text = F.col(name)
        hit = text.rlike(f"(?iu){query}") if regex else F.lower(text).contains(query.lower())
        found = found | F.coalesce(hit, F.lit(False))
    return found
