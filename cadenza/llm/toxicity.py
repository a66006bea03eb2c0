"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, and a linear classifier.

1. Lexicons. Whole words and word beginnings of ``STEM_LENGTHS`` characters are ranked by the log-likelihood ratio of how
   many toxic and other learning documents hold them; what only repeats a better entry is left out. This may use a bounded
   sample: at most about ``LEARNING_ROWS`` labelled rows, by hash of their ids. The entries are cut into ``LEXICONS``
   lexicons by their odds, from the surest to the weakest.
2. Voters. Every whole text is searched once for all entries. A lexicon votes 0, 1 or 2 by its hits (none, one, more); the
   patterns vote likewise by hits a hundred words, by the closest two hits, by the most hits of one entry and by the
   number of lexicons hit.
3. Label model. How often each combination of votes occurs is counted over all documents: at most 3 to the power of the
   voters. Expectation-maximisation estimates each voter's table of votes given the class (its accuracy) and, for the
   strongest conditional mutual informations, the table given another voter's vote too (their correlation), as a tree.
   Learning labels are known in it; of all other documents it only sees votes.
4. Classifier. Logistic regression on the logarithms of hits and lengths of all documents, trained on the posterior labels.
   Its probability is the score, so it also ranks documents with equal votes.

Defined results: NULL text is scored as the empty text. NULL labels and held-out rows are not learned from; a document
with several label rows counts once for each. Without toxic and other learning rows nothing can be told apart: every
score is then the toxic share of the learning labels, or 0 if there are none. Repeated rows are scored each by itself.
NULL ids are not held out. An empty table gives no rows. Extra columns are ignored; nothing but the text enters a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.classifier import in_fold
from cadenza.llm.common import narrow, stored

LEARNING_ROWS = 20_000
ENTRIES = 60
LEXICONS = 6
MIN_DOCUMENTS = 4
MIN_LIFT = 3.0
MIN_RATIO = 25.0  # so that among millions of candidates hardly one gets in by chance
STEM_LENGTHS = (3, 4, 5, 6, 7)
PATTERNS = ("density", "closest", "most_of_one", "lexicons_hit")
VOTERS = LEXICONS + len(PATTERNS)
OUTCOMES = 3
ROUNDS = 40
PRIOR = 0.5  # added to every cell of a table
THRESHOLD = 0.3
FEATURES = [*[f"hits{i}" for i in range(LEXICONS)], "density", "closest", "most_of_one", "lexicons_hit", "words"]
#: What parts words here: anything but letters, marks and digits.
APART = r"[^\p{L}\p{M}\p{N}]+"


def learning_rows(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """``text`` and ``y`` of labelled rows outside the held-out fold, about ``limit`` of them at most, by hash of the id."""
    told = stored(labels.filter(F.col("y").isin(0, 1) & F.col("label_id").isNotNull() & ~held_out("label_id")),
                  "toxic-labels")
    share = limit / max(1, told.count())
    if share < 1:
        told = told.filter(F.pmod(F.xxhash64(F.col("label_id").cast("string")), F.lit(1 << 20)) < int(share * (1 << 20)))
    return docs.join(told, F.col("doc_id") == F.col("label_id")).select("text", "y")


def held_out(id: str) -> Column:
    return in_fold(id, 2, 4)


def candidates(rows: DataFrame) -> DataFrame:
    """``entry`` (a word between blanks, or a blank and the beginning of a word), with the number of toxic and of other
    documents that hold it."""
    words = F.filter(F.split(F.lower("text"), APART), lambda w: w != "")
    word = rows.select("y", F.monotonically_increasing_id().alias("row"), F.explode(F.array_distinct(words)).alias("w"))
    forms = F.array(F.concat(F.lit(" "), "w", F.lit(" ")), *[
        F.when(F.length("w") > n, F.concat(F.lit(" "), F.substring("w", 1, n))) for n in STEM_LENGTHS])
    entries = word.select("y", "row", F.explode(forms).alias("entry")).filter("entry is not null").distinct()
    return entries.groupBy("entry").agg(F.sum("y").cast("long").alias("toxic"), F.sum(1 - F.col("y")).cast("long").alias(
        "other"))


def ratio(k: Column, n: int, other: Column, m: int) -> Column:
    """Log-likelihood ratio (G squared) of k of n against ``other`` of m."""
    both = (k + other) / float(n + m)
    part = lambda x, size: (
        F.when(x > 0, x * F.log(x / (size * both))).otherwise(0.0)
        + F.when(size - x > 0, (size - x) * F.log((size - x) / (size * (1 - both)))).otherwise(0.0))
    return 2 * (part(k, float(n)) + part(other, float(m)))


def mined_entries(rows: DataFrame, entries: int = ENTRIES) -> list[str]:
    """The best entries, by falling odds, from ``text`` and ``y``; an entry that begins with a better one, or is the
    beginning of one, is left out."""
    size = {int(r["y"]): r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n, m = size.get(1, 0), size.get(0, 0)
    if not n or not m:
        return []
    lift = (F.col("toxic") / float(n)) / ((F.col("other") + 0.5) / float(m))
    ranked = candidates(rows).filter((F.col("toxic") >= MIN_DOCUMENTS) & (lift >= MIN_LIFT)).withColumn(
        "g", ratio(F.col("toxic"), n, F.col("other"), m)).orderBy(F.desc("g"), F.length("entry").desc(), "entry")
    chosen: dict[str, float] = {}
    for r in ranked.filter(F.col("g") >= MIN_RATIO).withColumn("lift", lift).limit(40 * entries).collect():
        entry = r["entry"].rstrip()
        if not any(entry.startswith(c.rstrip()) or c.rstrip().startswith(entry) for c in chosen):
            chosen[r["entry"]] = r["lift"]
        if len(chosen) == entries:
            break
    return sorted(chosen, key=lambda c: (-chosen[c], c))


def search(shared):
    """A function for ``mapInArrow``: (doc_id, text) becomes (doc_id, FEATURES). Entries begin at the beginning of a word; those
    that end in a blank are whole words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for i, entry in enumerate(shared.value):
            stem = entry.strip()
            automaton.add_word(stem, (i, len(stem), entry.endswith(" "), i * LEXICONS // len(shared.value)))
        if len(shared.value):
            automaton.make_automaton()
        blank = re.compile(r"[^\W_]")  # a character of a word
        for batch in batches:
            out = np.zeros((len(FEATURES), batch.num_rows))
            for at, text in enumerate(batch.column(1)):
                low = (text.as_py() or "").lower()
                of_entry, lexicons, last, closest = {}, [0] * LEXICONS, None, None
                for end, (i, length, whole, lexicon) in automaton.iter(low) if len(shared.value) else ():
                    begin = end - length + 1
                    if begin and blank.match(low, begin - 1) or whole and blank.match(low, end + 1):
                        continue
                    of_entry[i] = of_entry.get(i, 0) + 1
                    lexicons[lexicon] += 1
                    if last is not None and (closest is None or begin - last < closest):
                        closest = begin - last
                    last = begin
                words = len(low.split())
                total = sum(lexicons)
                out[:, at] = [*lexicons, 100 * total / max(1, words), 1000 / (10 + closest) if closest else 0,
                              max(of_entry.values(), default=0), sum(x > 0 for x in lexicons), words]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x) for x in out]], ["doc_id", *FEATURES])

    return run


def votes() -> list[Column]:
    """The voters' outcomes 0, 1, 2 from the columns of :func:`search`."""
    level = lambda c, one, two: F.when(F.col(c) >= two, 2).when(F.col(c) >= one, 1).otherwise(0)
    return [*[level(f"hits{i}", 1, 2) for i in range(LEXICONS)], level("density", 0.2, 0.8),
            level("closest", 2.0, 8.0), level("most_of_one", 1, 2), level("lexicons_hit", 1, 2)]


@dataclass
class LabelModel:
    """P(class), P(vote | class) of each voter, or P(vote | parent's vote, class), as a tree over the voters."""

    prior: np.ndarray
    parent: list[int]
    tables: list[np.ndarray] = field(default_factory=list)

    def log_joint(self, patterns: np.ndarray) -> np.ndarray:
        """Logarithm of P(votes, class) of every pattern, one column per class."""
        out = np.tile(np.log(self.prior), (len(patterns), 1))
        for v, (p, table) in enumerate(zip(self.parent, self.tables)):
            before = patterns[:, p] if p >= 0 else np.zeros(len(patterns), dtype=int)
            out += np.log(table[:, before, patterns[:, v]]).T
        return out

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(class 1 | votes)."""
        joint = self.log_joint(patterns)
        return 1 / (1 + np.exp(np.clip(joint[:, 0] - joint[:, 1], -50, 50)))


def conditional_information(patterns: np.ndarray, weight: np.ndarray, voters: int) -> np.ndarray:
    """Mutual information of each two voters given the class; ``weight`` has one column per class."""
    out, total = np.zeros((voters, voters)), weight.sum()
    for i in range(voters):
        for j in range(i):
            for y in range(2):
                joint = np.zeros((OUTCOMES, OUTCOMES))
                np.add.at(joint, (patterns[:, i], patterns[:, j]), weight[:, y])
                size = joint.sum()
                if size <= 0:
                    continue
                joint /= size
                apart = np.outer(joint.sum(axis=1), joint.sum(axis=0))
                full = joint > 0
                out[i, j] += size / total * float((joint[full] * np.log(joint[full] / apart[full])).sum())
    return out + out.T


def strongest_tree(information: np.ndarray, least: float = 1e-4) -> list[int]:
    """For each voter the one it depends on, -1 for none: the spanning forest of the largest informations."""
    voters = len(information)
    parent, inside = [-1] * voters, [0]
    while len(inside) < voters:
        best = max(((information[i, j], -i, -j) for i in inside for j in range(voters) if j not in inside))
        i, j = -best[1], -best[2]
        parent[j] = i if best[0] > least else -1
        inside.append(j)
    return parent


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, toxic: np.ndarray, other: np.ndarray) -> LabelModel:
    """From vote patterns, how many documents have each, and how many of these are learning rows known to be toxic or not."""
    voters, known = patterns.shape[1], toxic + other
    share = (toxic.sum() + 1) / (known.sum() + 2)
    unknown = np.maximum(counts - known, 0)
    model = LabelModel(np.array([1 - share, share]), [-1] * voters)
    weight = np.stack([other, toxic], axis=1)  # the first round sees the learning rows only, and no correlations
    for step in range(ROUNDS):
        model.tables = []
        for v, p in enumerate(model.parent):
            table = np.full((2, OUTCOMES if p >= 0 else 1, OUTCOMES), PRIOR)
            before = patterns[:, p] if p >= 0 else np.zeros(len(patterns), dtype=int)
            for y in range(2):
                np.add.at(table[y], (before, patterns[:, v]), weight[:, y])
            model.tables.append(table / table.sum(axis=2, keepdims=True))
        belief = model.posterior(patterns)
        weight = np.stack([other + unknown * (1 - belief), toxic + unknown * belief], axis=1)
        if step % 10 == 0:
            model.parent = strongest_tree(conditional_information(patterns, weight, voters))
    return model


def posterior_column(model: LabelModel) -> Column:
    """P(toxic | votes) as an expression over the columns of :func:`search`."""
    gap = F.lit(float(np.log(model.prior[1]) - np.log(model.prior[0])))
    cast = votes()
    for v, (p, table) in enumerate(zip(model.parent, model.tables)):
        cells = np.log(table[1]) - np.log(table[0])
        place = cast[v] + (cast[p] * OUTCOMES if p >= 0 else 0)
        gap = gap + F.get(F.array(*[F.lit(float(x)) for x in cells.ravel()]), place)
    return 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), gap))))


def newton_sums(shared):
    """A function for ``mapInArrow``: (posterior, FEATURES) becomes the task's gradient and Hessian of the log likelihood,
    flat, at the broadcast (weights, means, scales)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beta, mean, scale = shared.value
        d = len(beta)
        gradient, hessian = np.zeros(d), np.zeros((d, d))
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.stack([np.log1p(batch.column(i + 1).to_numpy(zero_copy_only=False)) for i in range(d - 1)], axis=1)
            x = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
            gradient += x.T @ (y - p)
            hessian += (x * (p * (1 - p))[:, None]).T @ x
        flat = np.concatenate([gradient, hessian.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], ["at", "total"])

    return run


def fit_classifier(rows: DataFrame, rounds: int = 25, ridge: float = 1e-3) -> Column:
    """Logistic regression of the column ``posterior`` on the logarithms of FEATURES, over all rows, by Newton steps; a
    step adds up one small matrix per task. Returns the probability as an expression."""
    d = len(FEATURES) + 1
    told = stored(rows.select("posterior", *FEATURES), "toxic-told")
    stats = told.agg(F.count("*").alias("n"), *[F.avg(F.log1p(f)).alias(f"m{i}") for i, f in enumerate(FEATURES)],
                     *[F.stddev_pop(F.log1p(f)).alias(f"s{i}") for i, f in enumerate(FEATURES)]).first()
    mean = np.array([stats[f"m{i}"] for i in range(d - 1)])
    scale = np.array([stats[f"s{i}"] for i in range(d - 1)])
    scale[scale < 1e-9] = 1.0
    beta, n = np.zeros(d), stats["n"]
    penalty = ridge * np.eye(d)
    penalty[0, 0] = 1e-9
    for _ in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast((beta, mean, scale))
        flat = np.zeros(d + d * d)
        for r in told.mapInArrow(newton_sums(shared), "at int, total double").groupBy("at").agg(
                F.sum("total").alias("total")).collect():
            flat[r["at"]] = r["total"]
        hessian = flat[d:].reshape(d, d) / n + penalty + 1e-9 * np.eye(d)
        step = np.linalg.solve(hessian, flat[:d] / n - penalty @ beta)
        step *= min(1.0, 4.0 / max(1e-12, float(np.abs(step).max())))  # a far step would overshoot
        beta = beta + step
        if np.abs(step).max() < 1e-4:
            break
    gap = F.lit(float(beta[0]))
    for w, m, s, f in zip(beta[1:], mean, scale, FEATURES):
        gap = gap + (F.log1p(f) - float(m)) * float(w / s)
    return 1 / (1 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), gap))))


def classify(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
             label_id: str = "doc_id", learning_rows_limit: int = LEARNING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, and ``posterior``, the label model's, per document."""
    spark = docs.sparkSession
    read = narrow(docs, doc_id=id, text=text).withColumn("text", F.col("text").cast("string"))
    told = narrow(labels, label_id=label_id, y=label)
    learning = stored(learning_rows(read, told, learning_rows_limit), "toxic-learning")
    entries = mined_entries(learning)
    shared = spark.sparkContext.broadcast(entries)
    kind = docs.schema[id].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{f} double" for f in FEATURES)
    rows = stored(read.mapInArrow(search(shared), schema), "toxic-rows")
    if not entries:
        share = learning.agg(F.avg("y")).first()[0] or 0.0
        return rows.select("doc_id", held_out("doc_id").alias("held_out"), F.lit(float(share)).alias("score"),
                           F.lit(int(share >= threshold)).alias("predicted"), F.lit(float(share)).alias("posterior"))
    names = [f"v{i}" for i in range(VOTERS)]
    cast = rows.select("doc_id", *[v.alias(n) for v, n in zip(votes(), names)])
    known = told.filter(F.col("y").isin(0, 1) & ~held_out("label_id")).groupBy("label_id").agg(
        F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("other"))
    seen = cast.join(known, F.col("doc_id") == F.col("label_id"), "left").groupBy(*names).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
        F.coalesce(F.sum("other"), F.lit(0)).alias("other")).orderBy(*names).collect()
    model = fit_label_model(np.array([[r[v] for v in names] for r in seen]), *[
        np.array([float(r[c]) for r in seen]) for c in ("n", "toxic", "other")])
    believed = rows.withColumn("posterior", posterior_column(model))
    score = fit_classifier(believed)
    return believed.select("doc_id", held_out("doc_id").alias("held_out"), score.cast("double").alias("score"),
                           "posterior").select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast(
                               "int").alias("predicted"), "posterior")
