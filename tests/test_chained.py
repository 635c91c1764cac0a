"""Chained regressions on pattern moments against the same chain over the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from edcohort.operators import chained as ch
from edcohort.operators.impute import impute


def table(spark, n=150, d=4, seed=0, rate=.25):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + 10 * rng.normal(size=d)
    x[rng.random((n, d)) < rate * np.linspace(0, 1.6, d)] = np.nan
    rows = [(i, "t", *[None if v != v else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "k int, other string, " + ", ".join(f"c{i} double" for i in range(d))).repartition(3), x


def ridge(a, y):
    """Bayesian ridge on rows, by singular values."""
    am, ym = a.mean(axis=0), y.mean()
    u, s, vt = np.linalg.svd(a - am, full_matrices=False)
    n, e = len(y), s ** 2
    alpha, lam, old = 1 / (np.var(y) + np.finfo(float).eps), 1.0, None
    solve = lambda: vt.T @ ((s * (u.T @ (y - ym))) / (e + lam / alpha))
    for _ in range(300):
        coef = solve()
        rest = ((y - ym - (a - am) @ coef) ** 2).sum()
        gamma = (alpha * e / (lam + alpha * e)).sum()
        lam = (gamma + 2e-6) / ((coef ** 2).sum() + 2e-6)
        alpha = (n - gamma + 2e-6) / (rest + 2e-6)
        if old is not None and np.abs(old - coef).sum() < 1e-3:
            break
        old = coef
    coef = solve()
    return coef, ym - am @ coef


def over_rows(x, rounds, tol=1e-3):
    missing = np.isnan(x)
    sd = np.nanstd(x, axis=0)
    z = np.where(missing, np.nanmean(x, axis=0), x)
    for r in range(1, rounds + 1):
        before = z.copy()
        for k in sorted(np.flatnonzero(missing.any(axis=0)), key=lambda k: (missing[:, k].sum(), k)):
            others = [j for j in range(x.shape[1]) if j != k]
            coef, level = ridge(z[~missing[:, k]][:, others], x[~missing[:, k], k])
            z[missing[:, k], k] = z[missing[:, k]][:, others] @ coef + level
        move = [np.sqrt(((z - before)[missing[:, k], k] ** 2).mean()) / sd[k] for k in np.flatnonzero(missing.any(axis=0))]
        if max(move) < tol:
            return z, r
    return z, rounds


@pytest.mark.parametrize("numbers", [ch.DRIVER_NUMBERS, 0])
def test_equals_a_chain_over_the_rows(spark, numbers):
    df, x = table(spark)
    cols = [f"c{i}" for i in range(4)]
    chain = ch.fit_chain(df, cols, max_rounds=3 if not numbers else 10, driver_numbers=numbers)
    got = {r.k: r for r in ch.apply_chain(df, chain).collect()}
    want, rounds = over_rows(x, 3 if not numbers else 10)
    assert chain.rounds == rounds
    assert np.allclose([[got[i][c] for c in cols] for i in range(len(x))], want, rtol=1e-6)
    assert all(got[i].other == "t" and all(got[i][c] == x[i, j] for j, c in enumerate(cols) if x[i, j] == x[i, j]) for i in range(len(x)))


def test_stops_when_it_has_converged(spark):
    df, x = table(spark, n=400, rate=.1, seed=3)
    chain = ch.fit_chain(df, [f"c{i}" for i in range(4)], max_rounds=50)
    assert chain.converged and 1 < chain.rounds < 50
    last = [m for r, _, m in chain.moves if r == chain.rounds]
    assert max(last) < 1e-3 * np.nanstd(x, axis=0).max()


def test_one_column_is_a_line(spark):
    rows = [(i, float(i), 2.0 * i + 1 if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    out = {r.id: r.b for r in impute(df, ["a", "b"], "MICE").collect()}
    assert all(out[i] == pytest.approx(2.0 * i + 1, abs=1e-6) for i in range(60))


def test_odd_columns(spark):
    df = spark.createDataFrame([(1, 1.0, None, float("nan")), (2, 3.0, None, 4.0), (3, None, None, 6.0)], "k int, x double, y double, z double")
    got = {r.k: (r.x, r.y, r.z) for r in ch.impute_chained(df, ["x", "y", "z"]).collect()}
    assert got[2] == (3.0, None, 4.0) and got[1][0] == 1.0 and got[1][1] is None and got[1][2] is not None and got[3][0] is not None
    alone = spark.createDataFrame([(1, 1), (2, 3), (3, None)], "k int, x int")
    assert [r.x for r in ch.impute_chained(alone, ["x"]).orderBy("k").collect()] == [1.0, 3.0, 2.0]
    assert ch.impute_chained(df.limit(0), ["x", "y"]).count() == 0
    full = df.select("k", F.lit(1.0).alias("x"))
    assert ch.impute_chained(full, ["x"]).collect() == full.collect()
