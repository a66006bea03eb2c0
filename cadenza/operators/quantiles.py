"""Exact quantiles without collecting a column.

Spark's ``percentile`` keeps every distinct value of a column in one aggregation buffer. It is used
where a column has few distinct values. Elsewhere the wanted order statistics are bracketed first:
each round takes sketch quantiles of the values between two known bounds, counts exactly around the
sketch's guesses and moves the bounds inward. A round costs two scans with small buffers and
shrinks a bracket by a factor of about five hundred.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_COLUMN = 100_000
_GUESS_SPREAD = (0.0, 0.001, 0.01)
_SKETCH_ACCURACY = 2_000
_ACCURACY = 10_000


@dataclass
class _Bracket:
    """Order statistic ``rank`` (0-based) of ``column`` lies strictly between ``low`` and ``high``."""

    column: str
    rank: int
    low: float
    high: float
    below: int  # rows <= low
    upto: int  # rows < high
    value: float | None = None

    @property
    def interval(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high

    def narrow(self, guess: float, less: int, not_more: int) -> None:
        """Take in that ``less`` rows are below ``guess`` and ``not_more`` are not above it."""
        if self.value is not None or not self.low < guess < self.high:
            return
        if less <= self.rank < not_more:
            self.value = guess
        elif not_more <= self.rank:
            self.low, self.below = guess, not_more
        else:
            self.high, self.upto = guess, less


def _number(column: str):
    """The column as double, NaN as NULL."""
    c = F.col(column).cast("double")
    return F.when(~F.isnan(c), c)


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    small: int = SMALL_COLUMN, rows: int | None = None) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column, NULLs and NaNs ignored; ``None`` for a column without values.

    ``rows``: the table's row count, if the caller has it already.
    """
    columns = list(dict.fromkeys(columns))
    if not columns:
        return {}
    df = df.select(*[_number(c).alias(c) for c in columns])
    if rows is not None and rows <= small:
        return _direct(df, columns, probs)
    return _bracketed(df, columns, probs, small)


def exact_medians(df: DataFrame, columns: Sequence[str], small: int = SMALL_COLUMN,
                  rows: int | None = None) -> dict[str, float | None]:
    return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5], small, rows).items()}


def _direct(df, columns, probs) -> dict[str, list[float | None]]:
    grid = F.array(*[F.lit(float(p)) for p in probs])
    row = df.agg(*[F.percentile(F.col(c).cast("double"), grid).alias(str(i)) for i, c in enumerate(columns)]).first()
    return {c: list(row[i]) if row[i] is not None else [None] * len(probs) for i, c in enumerate(columns)}


def _bracketed(df, columns, probs, small) -> dict[str, list[float | None]]:
    grid = _grid(probs)
    first = df.agg(*[
        f.alias(f"{name}{i}") for i, c in enumerate(columns) for name, f in (
            ("n", F.count(c)),
            ("low", F.count_if(F.col(c).cast("double") == F.lit(-math.inf))),
            ("high", F.count_if(F.col(c).cast("double") == F.lit(math.inf))),
            ("guess", F.percentile_approx(_inside((c, -math.inf, math.inf)), grid, _SKETCH_ACCURACY)),
        )
    ]).first()
    size = {c: first[f"n{i}"] for i, c in enumerate(columns)}
    if max(size.values()) <= small:
        return _direct(df, columns, probs)
    brackets = {}
    for i, c in enumerate(columns):
        low, high = first[f"low{i}"], size[c] - first[f"high{i}"]
        for r in {r for p in probs for r in _ranks(size[c], p) if size[c]}:
            infinite = -math.inf if r < low else math.inf if r >= high else None
            brackets[c, r] = _Bracket(c, r, -math.inf, math.inf, low, high, infinite)
    guesses = {c: sorted(set(first[f"guess{i}"])) for i, c in enumerate(columns) if first[f"guess{i}"]}
    _settle(df, list(brackets.values()), guesses, small)
    result: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    for c, n in size.items():
        for i, p in enumerate(probs):
            if n:
                lower, upper = (brackets[c, r].value for r in _ranks(n, p))
                gap = (n - 1) * p % 1
                result[c][i] = lower + (upper - lower) * gap if gap else lower
    return result


def approximate_medians(df: DataFrame, columns: Sequence[str], accuracy: int = _ACCURACY) -> dict[str, float | None]:
    """One-scan sketch medians, for columns where a rank error of 1/accuracy is acceptable."""
    if not columns:
        return {}
    row = df.agg(*[
        F.percentile_approx(_number(c), 0.5, accuracy).alias(str(i))
        for i, c in enumerate(columns)
    ]).first()
    return {c: row[i] for i, c in enumerate(columns)}


def _ranks(n: int, p: float) -> tuple[int, int]:
    position = (n - 1) * p
    return math.floor(position), math.ceil(position)


def _inside(interval):
    column, low, high = interval
    c = F.col(column).cast("double")
    return F.when((c > F.lit(low)) & (c < F.lit(high)), c)


def _by_interval(brackets) -> dict[tuple, list[_Bracket]]:
    groups = defaultdict(list)
    for b in brackets:
        groups[b.interval].append(b)
    return groups


def _grid(centres):
    """Probabilities close around the wanted ones."""
    return F.array(*[
        F.lit(p) for p in sorted({min(1.0, max(0.0, c + s * d)) for c in centres for d in _GUESS_SPREAD for s in (-1, 1)})
    ])


def _settle(df, brackets, guesses, small) -> None:
    """Find the value of every bracket. A value that many rows share is found as soon as it is guessed."""
    while guesses:
        for column, counted in _count_around(df, guesses).items():
            for guess, less, not_more in counted:
                for b in brackets:
                    if b.column == column:
                        b.narrow(guess, less, not_more)
        wide = [b for b in brackets if b.value is None and b.upto - b.below > small]
        guesses = _sketch(df, wide) if wide else {}
    groups = _by_interval(b for b in brackets if b.value is None)
    if groups:
        lists = df.agg(*[
            F.array_sort(F.collect_list(_inside(interval))).alias(f"l{i}") for i, interval in enumerate(groups)
        ])  # at most ``small`` values each
        chosen = [(i, b) for i, group in enumerate(groups.values()) for b in group]
        row = lists.select(*[F.element_at(f"l{i}", b.rank - b.below + 1) for i, b in chosen]).first()
        for (_, b), value in zip(chosen, row):
            b.value = value


def _sketch(df, wide) -> dict[str, list[float]]:
    """Guesses around the wanted ranks, per column. All brackets of one interval share a sketch."""
    groups = _by_interval(wide)
    aggregates = []
    for i, (interval, group) in enumerate(groups.items()):
        grid = _grid([(b.rank - b.below + 0.5) / (b.upto - b.below) for b in group])
        aggregates.append(F.percentile_approx(_inside(interval), grid, _SKETCH_ACCURACY).alias(str(i)))
    row = df.agg(*aggregates).first()
    guesses = defaultdict(set)
    for i, (column, _, _) in enumerate(groups):
        guesses[column].update(row[i])
    return {c: sorted(v) for c, v in guesses.items()}


def _count_around(df, guesses: dict[str, list[float]]) -> dict[str, list[tuple[float, int, int]]]:
    """``(guess, rows below, rows not above)`` per column, in one scan.

    A guess and the next larger double split off the rows that equal it.
    """
    columns = list(guesses)
    splits = [
        [-math.inf, *sorted({x for g in guesses[c] for x in (g, math.nextafter(g, math.inf))}), math.inf]
        for c in columns
    ]
    names = [f"b{i}" for i in range(len(columns))]
    numbered = Bucketizer(
        splitsArray=splits, inputCols=[f"v{i}" for i in range(len(columns))], outputCols=names, handleInvalid="keep"
    ).transform(df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)]))
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(n).cast("int").alias("b")) for i, n in enumerate(names)])
    counts = numbered.select(F.inline(cells)).groupBy("i", "b").agg(F.count(F.lit(1)).alias("n")).collect()
    result = {}
    for i, c in enumerate(columns):
        held = [0] * len(splits[i])
        for r in counts:
            if r["i"] == i and r["b"] is not None:
                held[r["b"]] = r["n"]
        upto = dict(zip(splits[i][1:], accumulate(held)))  # rows below each split
        result[c] = [(g, upto[g], upto[math.nextafter(g, math.inf)]) for g in guesses[c]]
    return result
