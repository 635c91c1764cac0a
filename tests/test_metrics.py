"""Evaluation operators against brute force and NumPy."""

import random

import numpy as np
from pyspark.sql import functions as F

from edcohort.operators import metrics as me
from edcohort.operators import ordinal as od
from edcohort.operators import stats as st


def _scored(spark, n=300, seed=3):
    rnd = random.Random(seed)
    rows = [("m", i % 3, rnd.randint(0, 1), round(rnd.random(), 1)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "model string, fold int, y int, p double")


def _brute_auc(ys, ps):
    pos = [p for y, p in zip(ys, ps) if y == 1]
    neg = [p for y, p in zip(ys, ps) if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_auc_matches_pairwise_and_complement(spark):
    rows, df = _scored(spark)
    got = {r.fold: r.auc for r in me.auc(df).collect()}
    for f in range(3):
        ys = [r[2] for r in rows if r[1] == f]
        ps = [r[3] for r in rows if r[1] == f]
        assert abs(got[f] - _brute_auc(ys, ps)) < 1e-12
    flip = {r.fold: r.auc for r in me.auc(df.withColumn("p", 1 - F.col("p"))).collect()}
    for f in range(3):
        assert abs(flip[f] - (1 - got[f])) < 1e-12


def test_roc_grid_matches_numpy_interp(spark):
    rows, df = _scored(spark)
    pts = me.roc_points(df)
    grid = {(r.fold, r.j): r.tpr for r in me.roc_grid(pts).collect()}
    mean_fpr = np.linspace(0, 1, 100)
    for f in range(3):
        p = sorted([(r.threshold, r.fpr, r.tpr) for r in pts.where(F.col("fold") == f).collect()],
                   reverse=True)
        fpr = np.array([x[1] for x in p])
        tpr = np.array([x[2] for x in p])
        ref = np.interp(mean_fpr, fpr, tpr)
        ref[0] = 0.0
        for j in range(100):
            assert abs(grid[(f, j)] - ref[j]) < 1e-12


def _kfold_reference(y, k):
    """Plain-Python stratified k-fold (unshuffled), from its documented rules."""
    classes = []
    for v in y:
        if v not in classes:
            classes.append(v)
    enc = [classes.index(v) for v in y]
    order = sorted(enc)
    alloc = [[sum(1 for j in range(i, len(order), k) if order[j] == c) for c in range(len(classes))]
             for i in range(k)]
    folds = [None] * len(y)
    for c in range(len(classes)):
        seq = [i for i in range(k) for _ in range(alloc[i][c])]
        idx = [n for n, e in enumerate(enc) if e == c]
        for n, f in zip(idx, seq):
            folds[n] = f
    return folds


def test_stratified_kfold_matches_reference(spark):
    rnd = random.Random(1)
    y = [1 if rnd.random() < 0.3 else 0 for _ in range(203)]
    y[0] = 1
    df = spark.createDataFrame([(i, v) for i, v in enumerate(y)], "id long, y int")
    got = {r.id: r.fold for r in od.stratified_kfold(df, label="y", order_by=["id"], k=5).collect()}
    ref = _kfold_reference(y, 5)
    assert [got[i] for i in range(len(y))] == ref


def test_global_ordinal_is_row_number(spark):
    df = spark.range(0, 5000).withColumn("g", F.col("id") % 3).withColumn("k", (F.col("id") * 7919) % 5000)
    out = od.global_ordinal(df, order_by=["k"], partition_by=["g"], name="rn")
    rows = sorted((r.g, r.k, r.rn) for r in out.collect())
    expect = {}
    for g, k, rn in rows:
        expect.setdefault(g, []).append(rn)
    for g, rns in expect.items():
        assert rns == list(range(len(rns)))


def test_kappa_symmetric_and_self(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1), rnd.randint(0, 1), 1) for _ in range(200)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    k = {(r.rater_a, r.rater_b): r.kappa for r in st.kappa_pairs(df, {"t": ["a", "b", "c"]}).collect()}
    assert abs(k[("a", "b")] - k[("b", "a")]) < 1e-12
    assert k[("a", "a")] == 1.0
    assert k[("c", "c")] is None           # one class only
    n = len(rows)
    po = sum(1 for a, b, _ in rows if a == b) / n
    pa, pb = sum(r[0] for r in rows) / n, sum(r[1] for r in rows) / n
    pe = pa * pb + (1 - pa) * (1 - pb)
    assert abs(k[("a", "b")] - (po - pe) / (1 - pe)) < 1e-12


def test_mann_whitney_against_brute_force(spark):
    rnd = random.Random(9)
    x = [rnd.randint(0, 10) for _ in range(40)]
    y = [rnd.randint(2, 12) for _ in range(30)]
    df = spark.createDataFrame([("a", v) for v in x] + [("b", v) for v in y], "cohort string, v int")
    r = st.mann_whitney(df, value="v", cohort="cohort", first="a", second="b").first()
    # U for y: pairs where y > x, ties count half
    u_y = sum(1.0 if b > a else 0.5 if a == b else 0.0 for a in x for b in y)
    u_x = len(x) * len(y) - u_y
    assert abs(r.u - min(u_x, u_y)) < 1e-9
    assert abs(r.u_x - (len(x) * len(y) - u_x)) < 1e-9 or abs(r.u_x - u_y) < 1e-9


def test_chi_square_yates_2x2(spark):
    rows = [("main", 1)] * 10 + [("main", 0)] * 20 + [("val", 1)] * 15 + [("val", 0)] * 5
    df = spark.createDataFrame(rows, "cohort string, y int")
    r = st.with_chi2_p(st.chi_square(df, value="y", cohort="cohort", cohorts=["main", "val"])).first()
    obs = np.array([[20, 5], [10, 15]], dtype=float)
    e = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    adj = obs + 0.5 * np.sign(e - obs)
    chi2 = ((adj - e) ** 2 / e).sum()
    assert abs(r.chi2 - chi2) < 1e-9 and r.dof == 1
    import math
    assert abs(r.p - math.erfc(math.sqrt(chi2 / 2))) < 1e-12


def test_calibration_edges(spark):
    df = spark.createDataFrame([("m", 0, 1, 1 / 3), ("m", 0, 0, 0.34), ("m", 0, 1, 2 / 3), ("m", 0, 0, 1.0)],
                               "model string, fold int, y int, p double")
    got = {r.bin: r.frac_pos for r in me.calibration(df).collect()}
    assert set(got) == {0, 1, 2}          # 1/3 falls in bin 0 (edge is 1/3 + 1e-8/3)
    assert got[0] == 1.0


def test_attribution_sums_to_margin(spark):
    from pyspark.ml.functions import vector_to_array
    from edcohort.operators import explain as ex
    from edcohort.operators import learn as le
    rnd = random.Random(2)
    rows = [(i, rnd.random(), rnd.random(), rnd.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    df = df.withColumn("y_var", ((F.col("a") + F.col("b") * 0.5) > 0.7).cast("int"))
    data = le.assemble(df, ["a", "b", "c"])
    model = le.gbt(maxIter=5, maxDepth=3).fit(data)
    att = ex.attribution(model, data, ["a", "b", "c"], key="id")
    margin = {r.id: r.contribution for r in att.where(F.col("feature") == "_margin").collect()}
    raw = {r.id: r.m for r in model.transform(data).select(
        "id", vector_to_array("rawPrediction")[1].alias("m")).collect()}
    for i in range(300):
        assert abs(margin[i] - raw[i]) < 1e-9
