import decimal

import numpy as np
import pytest

from cadenza.llm import whitening as W


def by_definition(vectors):
    """x, the fit list's mean and covariance, and whitened rows by a plain eigendecomposition."""
    x = np.floor(64 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    centred = fit - fit.sum(axis=0) / len(fit)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(fit))
    return x, fit, values[::-1], vectors[:, ::-1]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in np.float32(rng.normal(0, 1 + np.arange(6) / 3))]) for i in range(200)]
    rows += [(200 + i, rows[0][1]) for i in range(300)]  # a hot vector
    return rows


def test_against_eigendecomposition(spark, table):
    odd = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6),
           (904, []), (905, [1.0, 2.0]), (None, table[3][1])]
    df = spark.createDataFrame(table + odd, "vec_id long, embedding array<float>").selectExpr("*", "1 AS y", "2 AS n")
    got = W.whiten(df, components=4).toPandas()
    x, fit, values, vectors = by_definition([v for _, v in table])
    assert len(got) == 4 * 501 and set(got["n"]) == {200} and got["identity_error"].max() < 1e-9
    named = got.dropna(subset=["vec_id"])
    for k in range(4):
        part = named[named["component"] == k + 1].set_index("vec_id")
        mine = part.loc[[i for i, _ in table], "whitened"].to_numpy()
        want = (x - fit.mean(axis=0)) @ vectors[:, k] / np.sqrt(values[k])
        assert np.allclose(mine, want * np.sign(mine[0] * want[0]), atol=1e-9)
        assert np.allclose(part["explained"], values[k] / values.sum())
    deviation = ((len(fit) * x - fit.sum(axis=0)) ** 2).sum(axis=1)
    first = named[named["component"] == 1].set_index("vec_id")["deviation"]
    assert [int(first[i]) for i, _ in table] == [int(d) for d in deviation]


def test_defined_results_of_small_tables(spark):
    kind = "vec_id string, embedding array<double>"
    assert W.whiten(spark.createDataFrame([], kind)).count() == 0
    assert W.whiten(spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0, 2.0])], kind)).count() == 0
    # two vectors: one component; entries far beyond what doubles add exactly
    got = W.whiten(spark.createDataFrame([("a", [2.0**40, 1.0]), ("b", [0.0, 1.0])], kind)).collect()
    assert sorted(r["component"] for r in got) == [1, 1] and {abs(r["whitened"]) for r in got} == {1.0}


def test_polynomial_and_roots(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(-9, 9, (7, 7))
    m = [[int(v) for v in row] for row in a @ a.T]
    poly = W.characteristic_polynomial(spark, m)
    assert np.allclose([float(c) for c in poly], np.poly(np.array(m, dtype=float)), rtol=1e-9, atol=1e-3)
    with decimal.localcontext() as context:
        context.prec = W.DIGITS
        roots = [float(r.decimal()) for r in W.largest_roots(poly, 5)]
    assert np.allclose(roots, np.linalg.eigvalsh(np.array(m, dtype=float))[::-1][:5], rtol=1e-10)


def test_repeated_roots_share_an_orthogonal_basis(spark):
    rotation, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(4, 4)))
    signs = np.array([[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]])
    m = [[int(v) for v in row] for row in signs @ np.diag([5, 5, 5, 0]) @ signs.T]
    poly = W.characteristic_polynomial(spark, m)
    with decimal.localcontext() as context:
        context.prec = W.DIGITS
        roots = W.largest_roots(poly, 3)
        assert [r.count for r in roots] == [3]
        basis = np.array([[float(v) for v in x] for x in W.null_vectors(m, roots[0])])
    assert np.allclose(basis @ basis.T, np.eye(3)) and np.allclose(basis @ np.array(m), 20 * basis)
