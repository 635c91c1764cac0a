"""Hand-worked cases for the presentation build."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from edcohort.operators import presentations as pr

T0 = dt.datetime(2020, 3, 1, 8, 0)


def _lab(spark, rows):
    return spark.createDataFrame(rows, "seq long, patient long, ts timestamp_ntz, code string, result string")


def test_anchor_boundaries(spark):
    # minutes after the first time: 0 anchor, 120 snapped, 121 dropped,
    # 1440 dropped, 1441 new anchor, 1441+120 snapped to it
    mins = [0, 120, 121, 1440, 1441, 1561, 1562]
    rows = [(i, 1, T0 + dt.timedelta(minutes=m), "HB", "1") for i, m in enumerate(mins)]
    out = pr.anchor_times(_lab(spark, rows)).orderBy("seq").collect()
    got = {r.seq: r.anchor for r in out}
    a2 = T0 + dt.timedelta(minutes=1441)
    assert got == {0: T0, 1: T0, 4: a2, 5: a2}


def test_anchor_does_not_slide(spark):
    # 100 and 200 minutes: 200 is 200 after the anchor (not 100 after 100) -> dropped
    rows = [(0, 1, T0, "HB", "1"), (1, 1, T0 + dt.timedelta(minutes=100), "HB", "1"),
            (2, 1, T0 + dt.timedelta(minutes=200), "HB", "1")]
    out = pr.anchor_times(_lab(spark, rows)).collect()
    assert sorted(r.seq for r in out) == [0, 1]


def test_anchor_patients_independent_and_midnight(spark):
    late = dt.datetime(2020, 3, 1, 23, 30)
    rows = [(0, 1, late, "HB", "1"), (1, 1, late + dt.timedelta(minutes=90), "HB", "1"),
            (2, 2, late + dt.timedelta(minutes=90), "HB", "1")]
    out = {r.seq: (r.patient, r.anchor) for r in pr.anchor_times(_lab(spark, rows)).collect()}
    assert out[1] == (1, late)                      # next day, same anchor
    assert out[2] == (2, late + dt.timedelta(minutes=90))


def test_normalise_rules(spark):
    rows = [(0, 1, T0, "HB", None), (1, 1, T0, "MREB", "Oke"), (2, 1, T0, "MREB", "troebel"),
            (3, 1, T0, "BG", "A"), (4, 1, T0, "DAT", "x"), (5, 1, T0, "TOXK", "+++"),
            (6, 1, T0, "HB", "< 0.5"), (7, 1, T0, "HB", ">-35"), (8, 1, T0, "HB", "< -3.5"),
            (9, 1, T0, "HB", "1d"), (10, 1, T0, "HB", " 12.5 "), (11, 1, T0, "HB", "volgt"),
            (12, 1, T0, "KP01", "whatever"), (13, 1, T0, "HB", "<"), (14, 1, T0, "HB", "1e3")]
    out = {r.seq: (r.num, r.txt, r.marker)
           for r in pr.normalise(_lab(spark, rows)).collect()}
    assert out[0] == (None, None, 1)
    assert out[1] == (None, "Negatief", 0)
    assert out[2] == (None, "Bijzonder", 0)
    assert out[3] == (None, "A", 0)
    assert out[4] == (1.0, None, 0)
    assert out[5] == (3.0, None, 0)
    assert out[6] == (0.5, None, 0)
    assert out[7] == (35.0, None, 0)
    assert out[8] == (-3.5, None, 0)
    assert out[9] == (None, None, 1)
    assert out[10] == (12.5, None, 0)
    assert out[11] == (None, None, 1)
    assert out[12] == (1.0, None, 0)
    assert out[13] == (None, None, 1)
    assert out[14] == (1000.0, None, 0)


def test_dedup_keeps_first_and_sparse_filter(spark):
    rows = [(5, 1, T0, "HB", "2"), (3, 1, T0, "HB", "1"), (4, 1, T0, "K", "4"),
            (6, 2, T0, "HB", "7")]
    lab = pr.normalise(_lab(spark, rows).withColumn("anchor", F.col("ts")))
    d = pr.dedup_first(lab)
    got = {(r.patient, r.code): (r.seq, r.num) for r in d.collect()}
    assert got[(1, "HB")] == (3, 1.0)
    kept = pr.sparse_filter(d, min_present=2)
    assert {r.patient for r in kept.collect()} == {1}


def test_marker_takes_code_mean(spark):
    rows = [(0, 1, T0, "HB", "2"), (1, 1, T0, "K", "1"), (2, 2, T0, "HB", "volgt"),
            (3, 2, T0, "K", "3"), (4, 3, T0, "HB", "4"), (5, 3, T0, "K", "5")]
    lab = pr.normalise(_lab(spark, rows).withColumn("anchor", F.col("ts")))
    res = pr.resolve_markers(pr.dedup_first(lab))
    got = {(r.patient, r.code): r.num for r in res.collect()}
    assert got[(2, "HB")] == 3.0   # mean of 2 and 4


def test_top_fraction_half_even(spark):
    # 5 codes * 0.5 = 2.5 -> 2 kept (half-even), most frequent first, ties by code
    rows = []
    counts = {"A": 3, "B": 3, "C": 2, "D": 1, "E": 1}
    i = 0
    for c, n in counts.items():
        for _ in range(n):
            rows.append((i, 1, T0, c, "1"))
            i += 1
    top = pr.top_codes(_lab(spark, rows), fraction=0.5)
    assert sorted(r.code for r in top.collect()) == ["A", "B"]


def test_deny_filter(spark):
    rows = [(0, 1, T0, "ARCHSE", "1"), (1, 1, T0, "HB", "1"), (2, 1, T0, None, "1")]
    assert [r.seq for r in pr.deny_filter(_lab(spark, rows)).collect()] == [1]


def test_anchors_of_a_patient_with_most_rows(spark):
    """One patient with thousands of times in long islands, against a plain scan."""
    import datetime as dt

    import numpy as np
    rng = np.random.default_rng(1)
    start = dt.datetime(2020, 1, 1)
    minutes = np.cumsum(rng.choice([5, 60, 119, 121, 700, 1440, 1441, 5000], 4000, p=[.4, .2, .1, .1, .1, .05, .03, .02]))
    rows = [(i, 1, start + dt.timedelta(minutes=int(m))) for i, m in enumerate(minutes)] + [(9000 + i, 2 + i, start) for i in range(50)]
    df = spark.createDataFrame(rows, "seq long, patient long, ts timestamp_ntz")
    got = {(r.seq): r.anchor for r in pr.anchor_times(df).collect()}
    want, anchor = {}, None
    for i, m in enumerate(minutes.tolist()):
        if anchor is None or m - anchor > 1440:
            anchor = m
        if m - anchor <= 120:
            want[i] = start + dt.timedelta(minutes=anchor)
    assert {k: v for k, v in got.items() if k < 9000} == want and len(got) == len(want) + 50


def test_missed_codes_and_texts_are_errors(spark):
    import datetime as dt

    import pytest
    rows = [(i, 1 + i // 3, dt.datetime(2020, 1, 1, 8), c, v) for i, (c, v) in enumerate([("HB", "1"), ("NEW", "2"), ("BG", "AB")] * 4)]
    lab = spark.createDataFrame(rows, "seq long, patient long, ts timestamp_ntz, code string, result string")
    wide = pr.build_presentations(lab, fraction=1.0)
    assert {"lab_HB", "lab_NEW", "lab_BGAB"} <= set(wide.columns) and wide.first().lab_BGAB == 1
    with pytest.raises(ValueError, match="NEW"):
        pr.build_presentations(lab, ["HB", "BG"], fraction=1.0)
    with pytest.raises(ValueError, match="AB"):
        pr.build_presentations(lab, fraction=1.0, category_vals={"BG": ["A"]})
    assert pr.first_attributes(lab, ["result"], keys=["patient"]).count() == 4


@pytest.mark.parametrize("gap", [1440, 300])
def test_dense_islands_by_links_equal_the_fold(spark, gap):
    """Islands done by numbered links and doubling, in many buckets, against the fold of arrays and a plain loop."""
    import random

    from edcohort.operators import ordinal as od
    rnd = random.Random(4)
    base = dt.datetime(2020, 1, 1)
    rows, want = [], {}
    for p in (1, 2, 3):
        at, times = 0, set()
        for _ in range(400 if p == 1 else 30):
            at += rnd.choice([1, 3, 40, 200, 700, 1439, 1440, 1441, 1500])
            times.add(at)
        anchor, grouped = None, {}
        for t in sorted(times):
            if anchor is None or t - anchor > gap:
                anchor = t
            if t - anchor <= 120:
                grouped[t] = anchor
        want |= {(p, t): a for t, a in grouped.items()}
        rows += [(p, base + dt.timedelta(minutes=t)) for t in times]
    df = spark.createDataFrame(rows, "patient int, ts timestamp_ntz")
    minutes = lambda x: int((x - base).total_seconds() // 60)
    old = od.ROWS_PER_BUCKET
    od.ROWS_PER_BUCKET = 50
    try:
        for fold_times in (10_000, 20, 0):
            got = pr.anchor_times(df, gap_minutes=gap, fold_times=fold_times).collect()
            assert {(r.patient, minutes(r.ts)): minutes(r.anchor) for r in got} == want and len(got) == len(want)
    finally:
        od.ROWS_PER_BUCKET = old
