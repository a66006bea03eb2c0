"""Quality rules: base counts of every whole text, and a hashed n-gram log-likelihood ratio.

Tokens (runs of letters, digits and underscores, or runs of other visible characters) and pairs of neighbouring tokens
are hashed into ``BUCKETS`` buckets. One scan counts the buckets over the raw corpus and over its trusted part; a
document's score is the mean over its n-grams of ln p(bucket | trusted) - ln p(bucket | raw), both with a prior of
``PRIOR`` counts: without it, a clean document would be blamed for each n-gram that no trusted one happens to share. The
mean is compared with one fixed threshold. All of it is DataFrame functions; the counts that reach the driver and come back as a literal are
``BUCKETS`` numbers whatever the input.

Defined results: NULL text has no words and no n-grams, as the empty text; both fail the base rules. A document without
n-grams scores 0. Without trusted rows nothing can be compared and every score is 0. Repeated rows count and are judged
each by itself; repeated or NULL trusted ids count once or never. Extra input columns pass through :func:`keep_good`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import SPACE_CLASS, checked_broadcast, fresh

BUCKETS = 1 << 14
TOKEN = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Counts added to the trusted and to the expected count of a bucket, so that rare n-grams say little.
PRIOR = 10.0
MIN_SCORE = -0.1


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def paired(hashes: str, apart: int) -> Column:
    """Hash of each element with the one ``apart`` places on; those without one have none."""
    rest = F.size(hashes) - apart
    return F.when(rest > 0, F.zip_with(F.slice(hashes, F.lit(1), F.greatest(rest, F.lit(0))), F.slice(
        hashes, F.lit(apart + 1), F.greatest(rest, F.lit(0))), lambda x, y: F.xxhash64(x, y))).otherwise(
        F.array().cast("array<long>"))


def base_counts(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``.

    Words in windows found twice: words are hashed in twos, these in twos and again, which makes windows of eight. The
    hash of each window carries its position in the low bits; sorted,
    neighbours of equal hash are compared word by word. Texts whose window hashes all differ, nearly all of them,
    stop before the sort.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    symbols = F.size(F.regexp_extract_all(t, F.lit(f"[{SYMBOLS}]"), F.lit(0)))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n = F.size("__words")
    df = df.withColumn("__words", word_list(t)).withColumn("__lines", lines)
    df = df.withColumn("__h", F.transform("__words", lambda x: F.xxhash64(x)))
    df = df.withColumn("__two", paired("__h", 1))
    df = df.withColumn("__four", paired("__two", 2))
    df = df.withColumn("__win", paired("__four", 4))
    low = F.expr("shiftleft(1L, cast(ceil(log2(size(__words) + 1)) as int)) - 1")
    packed = F.sort_array(F.transform("__win", lambda h, i: h.bitwiseAND(F.bitwise_not(low)).bitwiseOR(
        i.cast("long"))))
    df = df.withColumn("__sorted", F.when(
        F.size(F.array_distinct("__win")) < F.size("__win"), packed).otherwise(F.array().cast("array<long>")))

    def same(x, y):
        return F.coalesce(
            (x.bitwiseAND(F.bitwise_not(low)) == y.bitwiseAND(F.bitwise_not(low)))
            & (F.slice("__words", x.bitwiseAND(low).cast("int") + 1, WINDOW)
               == F.slice("__words", y.bitwiseAND(low).cast("int") + 1, WINDOW)), F.lit(False))

    twice = F.filter("__sorted", lambda x, i: same(x, F.get("__sorted", i + 1))
                     | same(x, F.get("__sorted", F.when(i > 0, i - 1).otherwise(-1))))
    df = df.withColumn("__starts", F.array_sort(F.transform(twice, lambda x: x.bitwiseAND(low))))
    covered = F.aggregate(
        F.transform("__starts", lambda x, i: F.least(
            F.lit(WINDOW).cast("long"), F.coalesce(F.get("__starts", i + 1) - x, F.lit(WINDOW).cast("long")))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.concat_ws("", "__words")).cast("long"),
        "n_symbols": symbols.cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": covered,
    }).drop("__words", "__lines", "__h", "__two", "__four", "__win", "__sorted", "__starts")


def failed_base() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def with_grams(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the buckets of the tokens and token pairs of a text (one NULL among them, before the first pair)."""
    t = fresh("tokens")
    df = df.withColumn(t, F.transform(
        F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKEN), F.lit(0)), lambda x: F.xxhash64(x)))
    bucket = lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")
    return df.withColumn(out, F.concat(
        F.transform(t, bucket),
        F.transform(t, lambda h, i: F.when(i > 0, bucket(F.xxhash64(F.get(t, F.greatest(i - 1, F.lit(0))), h)))))
    ).drop(t)


def ratio_table(docs: DataFrame, trusted: DataFrame, id: str, text: str) -> list[float]:
    """ln p(bucket | trusted) - ln p(bucket | raw) of every bucket, from counts over all documents."""
    ids = checked_broadcast(trusted.select(F.col(trusted.columns[0]).alias("trusted_id")).dropna().distinct())
    texts = docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    told = texts.join(ids, F.col("doc_id") == F.col("trusted_id"), "left")
    grams = with_grams(told, "text", "grams").select(
        F.col("trusted_id").isNotNull().cast("long").alias("t"), F.explode_outer("grams").alias("bucket"))
    # explode_outer: the plain one adds a filter under it that would compute the n-grams again, token by token
    rows = grams.filter("bucket is not null").groupBy("bucket").agg(
        F.count("*").alias("raw"), F.sum("t").alias("target")).collect()
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for r in rows:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    share = sum(target) / max(1, sum(raw))
    return [math.log((t + PRIOR) / (n * share + PRIOR)) if share else 0.0 for t, n in zip(target, raw)]


def likelihood_ratio(table: list[float], grams: str) -> Column:
    """Mean log-likelihood ratio of the n-grams of a document."""
    text = ",".join(f"{x:.5f}" for x in table)
    weights = F.split(F.lit(text), ",").cast("array<double>")  # folded into a literal once
    total = F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.coalesce(F.get(weights, g), F.lit(0.0)))
    n = F.size(grams) - 1  # one of them is NULL
    return F.when(n <= 0, 0.0).otherwise(total / n)


def judge(docs: DataFrame, trusted: DataFrame, id: str = "doc_id", text: str = "text",
          min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id`` with the base counts, ``base_failed``, ``score`` and ``kept``. ``trusted`` lists ids of trusted
    documents in its first column."""
    table = ratio_table(docs, trusted, id, text)
    read = docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return with_verdict(read, "text", table, min_score).drop("text", "row")


def with_verdict(docs: DataFrame, text: str, table: list[float], min_score: float) -> DataFrame:
    """``docs`` with counts, score and verdict. The column ``row`` is not deterministic: it keeps the optimiser from
    copying all these expressions into a filter on the verdict."""
    grams = fresh("grams")
    scored = with_grams(docs, text, grams).withColumn("score", likelihood_ratio(table, grams)).drop(grams)
    return base_counts(scored, text).withColumn("base_failed", failed_base()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= min_score)).withColumn(
        "row", F.monotonically_increasing_id())


def keep_good(docs: DataFrame, trusted: DataFrame, id: str = "doc_id", text: str = "text",
              min_score: float = MIN_SCORE) -> DataFrame:
    """The documents that pass, with the input's columns."""
    inner = {c: fresh("c") for c in docs.columns}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    judged = with_verdict(renamed, inner[text], ratio_table(docs, trusted, id, text), min_score)
    # the condition on the row number keeps the filter above the projection: else it would take in all these expressions
    return judged.filter("kept and row >= 0").select(*[F.col(n).alias(c) for c, n in inner.items()])
