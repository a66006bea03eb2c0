import math

import numpy as np
import pandas as pd
import pytest

from cadenza.operators.quantiles import approximate_medians, exact_medians, exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(7)
    n = 5001
    heavy = np.where(rng.random(n) < 0.6, 3.0, rng.normal(size=n))
    return pd.DataFrame({
        "uniform": rng.random(n),
        "heavy": heavy,
        "long_tail": np.exp(rng.normal(0, 40, n)),
        "coded": rng.integers(0, 5, n).astype(float),
        "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n)),
    })


@pytest.mark.parametrize("small", [10**6, 50, 1])
def test_exact_quantiles_match_pandas(spark, numbers, small):
    df = spark.createDataFrame(numbers.astype(object).where(numbers.notna(), None),
                               ", ".join(f"{c} double" for c in numbers.columns))
    found = exact_quantiles(df, list(numbers.columns), PROBS, small=small)
    for c in numbers.columns:
        want = numbers[c].quantile(PROBS).to_list()
        assert found[c] == pytest.approx(want, rel=1e-12), c


@pytest.mark.parametrize("small", [10**6, 1])
def test_no_values_and_infinities(spark, small):
    df = spark.createDataFrame(
        [(None, -math.inf), (None, 1.0), (None, 2.0), (None, math.inf), (None, math.inf)], "none double, ends double")
    found = exact_quantiles(df, ["none", "ends"], [0.0, 0.25, 0.5, 0.75], small=small)
    assert found["none"] == [None] * 4
    assert found["ends"] == [-math.inf, 1.0, 2.0, math.inf]


def test_whole_number_columns(spark):
    df = spark.range(0, 1001).withColumnRenamed("id", "x")
    assert exact_medians(df, ["x"], small=10) == {"x": 500.0}
    assert abs(approximate_medians(df, ["x"])["x"] - 500) <= 1
