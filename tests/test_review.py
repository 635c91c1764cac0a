"""NULL groups, large counts, bucketed running totals, dataset safety."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from edcohort.operators import metrics as me
from edcohort.operators import ordinal as od
from edcohort.operators import stats as st
from edcohort.sources import datasets as ds
from edcohort.sources import extracts as ex


def test_null_model_and_fold_keep_their_rows(spark):
    rows = [(m, f, y, p) for m in ("a", None) for f in (0, None) for y, p in ((1, .9), (0, .2), (1, .4), (0, .6))]
    df = spark.createDataFrame(rows, "model string, fold int, y int, p double")
    got = me.auc(df).collect()
    assert len(got) == 4 and {round(r.auc, 6) for r in got} == {0.75}
    assert me.roc_grid(me.roc_points(df)).groupBy("model", "fold").count().count() == 4
    fold_auc, band, summary = me.cross_validated_roc(df)
    assert summary.count() == 2 and summary.where("mean_auc is null").count() == 0


def test_null_group_has_quartiles(spark):
    df = spark.createDataFrame([(None, float(v)) for v in range(5)] + [("x", 1.0)], "g string, v double")
    r = {x.g: x for x in st.describe(df, group=["g"], value="v").collect()}
    assert (r[None].q25, r[None].q50, r[None].q75) == (1.0, 2.0, 3.0) and r["x"].q50 == 1.0


def test_null_label_is_a_class(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 1), (4, None)], "k int, y int")
    got = od.stratified_kfold(df, label="y", order_by=["k"], k=2).collect()
    assert len(got) == 4 and {r.fold for r in got if r.y is None} == {0, 1}
    assert od.dense_ordinal(df, keys=["y"]).count() == 4


def test_ties_beyond_three_million(spark):
    n = 3_200_000
    df = spark.range(n).select(F.lit(1.0).alias("v"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("c"))
    r = st.mann_whitney(df, value="v", cohort="c", first="a", second="b").first()
    assert r.u == r.n1 * r.n2 / 2 and r.z is None


def test_counts_beyond_four_billion(spark):
    n = 4_000_000_000
    cum = spark.createDataFrame([("m", 0, .9, n, 0, n, 0, n, n), ("m", 0, .1, 0, n, n, n, n, n)],
                                "model string, fold int, p double, tp long, fp long, ctp long, cfp long, _P long, _N long")
    assert me.auc_from(cum).first().auc == 1.0
    kinds = spark.createDataFrame([(1, 1), (0, 0), (1, 0), (0, None), (None, 1)], "a int, b int")
    k = {(r.rater_a, r.rater_b): r for r in st.kappa_pairs(kinds, {"t": ["a", "b"]}).collect()}
    assert k["a", "b"].n == 3 and k["a", "b"].kappa == pytest.approx(1 - (1 / 3) / (1 - 4 / 9)) and k["b", "a"].kappa == k["a", "b"].kappa
    assert k["a", "a"].n == 4 and k["a", "a"].kappa == 1.0


def test_value_of_a_third_cohort_only(spark):
    rows = [("x", "a")] * 3 + [("y", "a")] * 5 + [("x", "b")] * 4 + [("y", "b")] * 2 + [("z", "c")] * 9
    df = spark.createDataFrame(rows, "v string, c string")
    two = st.chi_square(df, value="v", cohort="c", cohorts=["a", "b"]).first()
    assert two.dof == 1 and two.n == 14


def test_running_totals_over_many_buckets(spark):
    """150,000 distinct scores in hot and small groups, 30 buckets, against NumPy."""
    rng = np.random.default_rng(2)
    n = 150_000
    score, group = rng.random(n), rng.choice(["hot", "b", None], n, p=[.8, .15, .05])
    df = spark.createDataFrame([(g, float(s), i) for i, (g, s) in enumerate(zip(group.tolist(), score.tolist(), strict=True))], "g string, s double, i long")
    out = od.prefix_sums(df, order_by=["s", "i"], sums={"run": F.lit(1), "total": F.col("i")}, partition_by=["g"], rows_per_bucket=5000)
    assert out._jdf.queryExecution().executedPlan().toString().count("rangepartitioning") == 0
    got = out.toPandas()
    assert len(got) == n
    for g in ("hot", "b", None):
        own = got[got.g == g] if g else got[got.g.isna()]
        own = own.sort_values(["s", "i"])
        assert (own.run.to_numpy() == np.arange(1, len(own) + 1)).all() and (own.total.to_numpy() == np.cumsum(own.i.to_numpy())).all()


def test_auc_over_many_distinct_scores(spark):
    rng = np.random.default_rng(4)
    y, p = (rng.random(120_000) < .3).astype(int), rng.random(120_000)
    df = spark.createDataFrame([("m", 0, int(a), float(b)) for a, b in zip(y, p, strict=True)], "model string, fold int, y int, p double")
    rank = p.argsort().argsort() + 1
    n1, n0 = y.sum(), (1 - y).sum()
    assert me.auc(df).first().auc == pytest.approx((rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0))


def test_models_read_back_with_their_own_columns(spark, tmp_path):
    root = str(tmp_path / "d")
    frames = {m: spark.range(4).selectExpr("id AS y_var", *[f"id * {m} AS c{k}" for k in range(m * 2)]) for m in (1, 2, 3)}
    for m in (3, 1, 2):
        ds.write_data_model({"main": frames[m]}, root, version=1, model=m, out=3)
    ds.commit_version(spark, root, 1)
    for m in (1, 2, 3):
        back = ds.read_data_model(spark, root, model=m, out=3)
        assert back.columns == frames[m].columns and sorted(back.collect()) == sorted(frames[m].collect())
    assert ds.latest_version_number(spark, root) == 1 and ds.latest_version_number(spark, str(tmp_path / "none")) == 0
    with pytest.raises(FileExistsError):
        ds.write_data_model({"main": frames[1]}, root, version=1, model=1, out=3)
    ds.write_data_model({"main": frames[1].limit(1)}, root, version=7, model=1, out=3)
    assert ds.latest_version_number(spark, root) == 1   # not committed yet
    ds.commit_version(spark, root, 7)
    for name in os.listdir(f"{root}/version=7/model=1/out=3/split=main"):
        if name.endswith(".parquet"):
            with open(f"{root}/version=7/model=1/out=3/split=main/{name}", "wb") as f:
                f.write(b"broken")
    assert ds.latest_version_number(spark, root) == 7   # found by name, whatever the files hold
    with pytest.raises(Exception, match=r"(?i)parquet"):
        ds.read_data_model(spark, root, model=1, out=3).collect()
    assert ds.write_processed(frames[2], f"{root}-p") == 1 and ds.write_processed(frames[3], f"{root}-p") == 2
    assert ds.read_processed(spark, f"{root}-p").columns == frames[3].columns


def test_line_with_an_empty_extra_field_is_skipped(spark, tmp_path):
    p = tmp_path / "a.txt"
    p.write_text("A;B;C\n1;2;3\n4;5;6;\n7;8;9;10\n11;12\n13;;15\n", encoding="latin-1")
    rows = ex.read_delimited(spark, str(p), sep=";", encoding="ISO-8859-1").orderBy("seq").collect()
    assert [(r.A, r.B, r.C) for r in rows] == [("1", "2", "3"), ("11", "12", None), ("13", None, "15")]


def test_scores_of_one_join(spark, monkeypatch):
    """Several scores come from one join, dealt out over tasks by rows, as each alone."""
    from edcohort.plans import evaluate as ev
    names = ["URESE", "AF_berekend", "Geboortedatum", "RR_diast", "RR_syst", "Comorb_dementie_Psychiatrisch", "Woonsituatie", "TRC",
             "metastase_of_chronische_ziekte_met_hoge_mortaliteit", "WD"]
    rows = [(None if i == 5 else i % 30, i % 2, *[(i * (j + 3)) % 91 for j in range(len(names))]) for i in range(40)]
    data = spark.createDataFrame(rows, ", ".join(["case_id int", "y_var int", *[f"{n} int" for n in names]]))
    shock = spark.createDataFrame([(i, i % 3 == 0 and 1 or 0) for i in range(20)], "case_id int, y_var int")
    want = sorted(str((r.case_id, r.y, float(r.p), s)) for s in ("CURB", "MEDS", "REMS", "abbMEDS")
                  for r in ev.score_dataset(data, shock, s).collect())
    monkeypatch.setattr(ev, "JOIN_ROWS", 7)
    got = ev.score_dataset(data, shock, ("CURB", "MEDS", "REMS", "abbMEDS"))
    assert sorted(str((r.case_id, r.y, r.p, r.score)) for r in got.collect()) == want and len(want) == 160
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
