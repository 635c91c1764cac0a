"""Operator 11 against scoring all pairs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edcohort.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, rid string, summary string, place int"


def brute(rows, *, n_positives=5, n_negatives=3, every=50):
    """Rows are (id, vector of integers or None, label or None); all pairs are scored."""
    rows = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and abs(x) != float("inf") and x == x for x in r[1])]
    score = lambda v, w: max(-H.LIMIT, min(H.LIMIT, sum(int(a) * int(b) for a, b in zip(v, w))))
    out = []
    for x, (i, v, label) in enumerate(rows):
        if i is None or i % every:
            continue
        s = [score(v, r[1]) for r in rows]
        order = sorted((y for y in range(len(rows)) if y != x), key=lambda y: (-s[y], rows[y][0] is None, rows[y][0] or 0, y))
        for p in [y for y in order if rows[y][2] == label][:n_positives]:
            ok = [y for y in order if rows[y][2] != label and 50 * s[p] <= 100 * s[y] <= 95 * s[p]]
            out += [(i, rows[p][0], k, rows[y][0], s[p], s[y]) for k, y in enumerate(ok[:n_negatives], 1)]
    return sorted(out, key=repr)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, H.mine(df, F.col("vec_id") % 50 == 0, **kw).collect()), key=repr)


def vectors(n, dims=12, seed=0, spread=1):
    rng = np.random.default_rng(seed)
    centre = rng.integers(-20, 20, (4, dims))
    return [(int(k), [float(x) for x in spread * (centre[k % 4] + rng.integers(-25, 25, dims))], int(rng.choice(4, p=[.7, .1, .1, .1]))) for k in rng.permutation(n)]


@pytest.mark.parametrize("blocks", [(1024, 4096), (3, 17)])
def test_against_all_pairs(spark, blocks):
    rows = vectors(400)
    got = mined(spark, rows, anchor_block=blocks[0], row_block=blocks[1])
    assert got == brute(rows) and len(got) > 30


def test_awkward_rows(spark):
    rows = vectors(60)
    one = rows[5]
    rows += [one, one, (50, rows[0][1], 1), (50, rows[0][1], 1), (None, rows[1][1], 0), (None, rows[1][1], 2), (100, None, 1), (150, rows[3][1], None),
             (200, [1.0, None, 2.0], 1), (250, [float("nan")] * 12, 1), (300, [float("inf")] * 12, 1), (350, [], 1), (400, [3.0, 4.0], 2), (450, [0.0] * 12, 3)]
    assert mined(spark, rows, anchor_block=2, row_block=9) == brute(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]) == brute([(0, [], 1), (1, [], 1), (2, [], 2)]) == [(0, 1, 1, 2, 0, 0)]


def test_one_vector_very_often(spark):
    """Ties over many blocks go by id."""
    rows = [(k, [7.0, 1.0, 0.0, 2.0], 1) for k in range(300)] + [(k, [5.0, 1.0, 0.0, 2.0], 2) for k in range(300, 500)] + vectors(80, 4, 3)
    assert mined(spark, rows, anchor_block=4, row_block=40) == brute(rows)


def test_scores_beyond_doubles(spark):
    rows = vectors(120, 6, 5, spread=float(1 << 24)) + [(50, [float(1 << 62)] * 6, 0), (51, [float(1 << 62)] * 6, 1)]
    assert mined(spark, rows, row_block=50) == brute(rows)


def test_bounds_hold_at_every_level():
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(size=(80, 37)))
    table = pa.table({"vector": pa.array(x.tolist()), "summary": pa.array(H.summaries(x).astype(np.float32).tolist(), pa.list_(pa.float32())),
                      "rid": pa.array(range(80)), "label": pa.array([0] * 80)})
    s, at, true, wide = H.Side(table, 37, 1.0), 0, x @ x.T, None
    for n in H.segment_counts(37):
        middle, spread = H.bounds(s, s, None, None, slice(at, at + 2 * n))
        assert (true <= middle + spread).all() and (true >= middle - spread).all()
        assert wide is None or spread.mean() < wide
        at, wide = at + 2 * n, spread.mean()
    assert at == s.summary.shape[1]
