"""Quality classifier: regularised quadratic discriminant analysis over statistics of the text.

Each text gives ``FEATURES`` numbers, transformed by logarithms so that they are nearer to normal. Every class has its
mean and covariance, the covariance shrunk towards its diagonal; the score is the logistic function of the difference
of the two log densities plus the log prior. Moments are sums over all learning rows (no sample), the Cholesky factors
of the few-by-few matrices are computed once and enter the scoring projection as literals.

Defined results: NULL text is scored as the empty text. NULL labels are not learned from; a document with several label
rows counts once for each. With one class only, every score is that class's (1.0 or 0.0); with none, 0.5. Repeated rows
are scored each by itself. Extra columns are ignored; nothing but the text enters a score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import narrow, stored
from cadenza.llm.quality_rules import SYMBOLS, word_list

SHRINKAGE = 0.05
RIDGE = 1e-3
FEATURES = ("words", "word_length", "symbols", "digits", "capitals", "stops", "distinct", "doubled", "repeated_lines",
            "lines", "longest")


def statistics(df: DataFrame, text: str) -> DataFrame:
    """``df`` with one double column per name in FEATURES, from the whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    count = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
    df = df.withColumn("__w", word_list(t)).withColumn(
        "__l", F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumns({
        "__n": F.size("__w"), "__chars": F.greatest(F.length(t), F.lit(1)),
        "__m": F.greatest(F.size("__w"), F.lit(1)), "__k": F.size("__l"),
    })
    share = lambda n, of: F.log((n + 0.5) / F.col(of))
    return df.withColumns({
        "words": F.log1p("__n"),
        "word_length": F.log1p(F.length(F.translate(t, " \t\n\x0b\f\r", "")) / F.col("__m")),
        "symbols": share(count(SYMBOLS), "__chars"),
        "digits": share(count("0123456789"), "__chars"),
        "capitals": share(F.regexp_count(t, F.lit(r"\p{Lu}")), "__chars"),
        "stops": share(count(".,;:!?"), "__chars"),
        "distinct": F.size(F.array_distinct("__w")) / F.col("__m"),
        "doubled": share(F.size(F.filter("__w", lambda x, i: (i > 0) & (
            x == F.get("__w", F.greatest(i - 1, F.lit(0)))))), "__m"),
        "repeated_lines": F.log((F.col("__k") - F.size(F.array_distinct("__l")) + 0.5) / F.greatest("__k", F.lit(1))),
        "lines": F.log1p("__k"),
        "longest": F.log1p(F.coalesce(F.array_max(F.transform("__w", lambda x: F.length(x))), F.lit(0))),
    }).drop("__w", "__l", "__n", "__chars", "__m", "__k")


@dataclass
class Discriminant:
    """Means and lower Cholesky factors per class, on features scaled by ``center`` and ``scale``."""

    center: np.ndarray
    scale: np.ndarray
    means: dict[int, np.ndarray]
    factors: dict[int, np.ndarray]
    log_prior: float
    constant: float | None = None

    def score(self) -> Column:
        """Probability of class 1 as an expression over the FEATURES columns."""
        if self.constant is not None:
            return F.lit(self.constant)
        x = [(F.col(f) - float(c)) / float(s) for f, c, s in zip(FEATURES, self.center, self.scale)]
        gap = self._log_density(x, 1) - self._log_density(x, 0) + F.lit(self.log_prior)
        return 1 / (1 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), gap))))

    def _log_density(self, x: list[Column], k: int) -> Column:
        inverse = np.linalg.inv(self.factors[k])
        total = F.lit(0.0)
        for i in range(len(x)):
            z = F.lit(0.0)
            for j in range(i + 1):
                z = z + F.lit(float(inverse[i, j])) * (x[j] - float(self.means[k][j]))
            total = total + z * z
        return total * -0.5 - float(np.log(np.diag(self.factors[k])).sum())


def fit(rows: DataFrame, label: str, shrinkage: float = SHRINKAGE) -> Discriminant:
    """Fit on the FEATURES columns of ``rows``; ``label`` is 0 or 1. One aggregate of sums and products."""
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = {int(r[label]): r for r in rows.filter(F.col(label).isin(0, 1)).groupBy(label).agg(
        F.count("*").alias("n"), *[F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)],
        *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}_{j}") for i, j in pairs]).collect()}
    if len(sums) < 2:
        constant = float(next(iter(sums))) if sums else 0.5
        return Discriminant(np.zeros(d), np.ones(d), {}, {}, 0.0, constant)
    n = {k: r["n"] for k, r in sums.items()}
    first = {k: np.array([r[f"s{i}"] for i in range(d)]) for k, r in sums.items()}
    second = {}
    for k, r in sums.items():
        m = np.zeros((d, d))
        for i, j in pairs:
            m[i, j] = m[j, i] = r[f"p{i}_{j}"]
        second[k] = m
    every = sum(n.values())
    center = sum(first.values()) / every
    spread = np.diag(sum(second.values())) / every - center**2
    scale = np.sqrt(np.maximum(spread, 1e-12))
    scale[scale < 1e-5] = 1.0
    means, factors = {}, {}
    for k in sums:
        mean = first[k] / n[k]
        covariance = (second[k] / n[k] - np.outer(mean, mean)) / np.outer(scale, scale)
        shrunk = (1 - shrinkage) * covariance + shrinkage * np.diag(np.diag(covariance)) + RIDGE * np.eye(d)
        means[k], factors[k] = (mean - center) / scale, np.linalg.cholesky(shrunk)
    return Discriminant(center, scale, means, factors, math.log(n[1] / n[0]))


def in_fold(id: str, fold: int = 1, folds: int = 3) -> Column:
    """Whether the CRC-32 of the id as text has the remainder ``fold``; not for a NULL id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
             label_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` per document; labels of held-out rows are not learned from."""
    read = narrow(docs, doc_id=id, text=text)
    rows = stored(statistics(read, "text").select("doc_id", in_fold("doc_id").alias("held_out"), *FEATURES),
                  "classifier-rows")
    told = narrow(labels, label_id=label_id, label=label).dropna()
    learned = rows.filter(~F.col("held_out")).join(told, F.col("doc_id") == F.col("label_id"))
    model = fit(learned, "label")
    return rows.select("doc_id", "held_out", model.score().cast("double").alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
