"""Exact nearest-neighbour imputation against all pairs in NumPy."""

import numpy as np
import pytest

from edcohort.operators import neighbours as ne


def brute(values, k):
    mean, sd = np.nanmean(values, axis=0), np.nanstd(values, axis=0)
    sd = np.where(sd == 0, 1, sd)
    z = (np.where(np.isnan(values), mean, values) - mean) / sd
    out = values.copy()
    for i in range(len(z)):
        d = np.round(np.sqrt(((z - z[i]) ** 2).sum(axis=1)), ne.PLACES)
        order = [j for j in np.lexsort((np.arange(len(z)), d)) if j != i][:k]
        for c in range(values.shape[1]):
            if np.isnan(values[i, c]):
                ok = [j for j in order if not np.isnan(values[j, c])]
                w = np.array([1 / (d[j] + ne.EPSILON) for j in ok])
                out[i, c] = (w @ values[ok, c]) / w.sum() if ok else np.nan
    return out


@pytest.mark.parametrize("block", [ne.BLOCK, 7])
def test_imputation(spark, monkeypatch, block):
    monkeypatch.setattr(ne, "BLOCK", block)
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=(60, 3)), rng.normal(4, .1, size=(30, 3)), np.tile([[1.0, 2.0, 3.0]], (40, 1))])
    values[rng.random(values.shape) < .3] = np.nan
    values[100:115] = np.nan   # rows without any value, all at one point
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(values)]
    df = spark.createDataFrame(rows, "k int, a double, b double, c double").repartition(3)
    got = ne.impute_knn(df, ["a", "b", "c"], keys=["k"], k=4).toPandas().sort_values("k")[["a", "b", "c"]].to_numpy(float)
    assert np.allclose(got, brute(values, 4), equal_nan=True)


def test_rows_are_placed_in_pieces():
    """However long a batch is, a bounded number of rows meets all centres."""
    import pandas as pd
    long = pd.DataFrame({"v": np.arange(5000)})
    parts = list(ne._pieces([long, long[:0], long[:3]]))
    assert max(map(len, parts)) <= ne.PLACED and pd.concat(parts)["v"].tolist() == [*range(5000), 0, 1, 2]


def test_many_blocks(spark, monkeypatch):
    """The blocks are dealt out over tasks by their number, with the same result."""
    monkeypatch.setattr(ne, "BLOCK", 5)
    monkeypatch.setattr(ne, "BLOCKS", 2)
    values = np.random.default_rng(8).normal(size=(90, 2))
    values[::4, 1] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(values)]
    parts = []
    whole = type(spark.range(1)).repartition
    monkeypatch.setattr(type(spark.range(1)), "repartition", lambda d, n, *c: (parts.append(n), whole(d, n, *c))[1])
    got = ne.impute_knn(spark.createDataFrame(rows, "k int, a double, b double"), ["a", "b"], keys=["k"], k=3)
    assert np.allclose(got.toPandas().sort_values("k")[["a", "b"]].to_numpy(float), brute(values, 3), equal_nan=True) and parts


def test_indicators_first(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 5.0), (3, None, 7.0)], "k int, a double, b double")
    rows = {r.k: r for r in ne.impute_complex(df, ["a", "b"], keys=["k"], k=2).collect()}
    assert (rows[1].abinary, rows[1].bbinary, rows[3].abinary) == (1, 0, 0) and rows[1].b is not None


def test_nearest_of_a_block():
    """With ties, equal points and far-off centres of mass, against plain sorting."""
    rng = np.random.default_rng(2)
    for shift in (0, 1e5):
        x = shift + np.round(rng.normal(size=(300, 3)), 1)
        v = np.concatenate([x[:20], shift + rng.normal(size=(20, 3))])
        i, j, d = ne.nearest_of(v, x, 7)
        for q in range(len(v)):
            exact = np.round(np.sqrt(((x - v[q]) ** 2).sum(axis=1)), ne.PLACES)
            want = np.argsort(exact, kind="stable")[:7]
            assert j[i == q].tolist() == want.tolist() and d[i == q].tolist() == exact[want].tolist()
    assert ne.nearest_of(v[:2], x[:3], 7)[1].tolist().__len__() == 6
