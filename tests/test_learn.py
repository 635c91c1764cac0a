"""Tree SHAP against brute-force Shapley values, prefixes of boosting, folds, stores, and the entries from files."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from edcohort.functions.clinical import estimate_text
from edcohort.operators import boosting as bo
from edcohort.operators import explain as ex
from edcohort.operators import learn as le
from edcohort.plans import build as bu
from edcohort.plans import derive as de
from edcohort.plans import evaluate as ev
from edcohort.sources import datasets as ds
from edcohort.sources import models as mo


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 4))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(scale=.3, size=400) > 0).astype(int)
    rows = [(i, int(y[i]), i % 5, *map(float, x[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, y_var int, fold int, a double, b double, c double, d double")
    return le.assemble(df, list("abcd")).persist()


def expectation(tree, x, known, node=0):
    """Value of a coalition: the path where the feature is known, the cover-weighted mean elsewhere."""
    f = tree["feature"][node]
    if f < 0:
        return tree["value"][node]
    left, right = tree["left"][node], tree["right"][node]
    if f in known:
        return expectation(tree, x, known, left if x[f] <= tree["threshold"][node] else right)
    w = tree["cover"][left] / tree["cover"][node]
    return w * expectation(tree, x, known, left) + (1 - w) * expectation(tree, x, known, right)


def test_shapley_values(data):
    trees = ex.tree_arrays(le.gbt(maxIter=5, maxDepth=4).fit(data))
    x = np.array([r.features.toArray() for r in data.limit(6).collect()])
    got, base = ex.shapley_values(x, trees)
    value = lambda row, s: sum(t["weight"] * expectation(t, row, s) for t in trees)
    for row, phi in zip(x, got, strict=True):
        for i in range(4):
            others = [j for j in range(4) if j != i]
            want = sum(math.factorial(len(s)) * math.factorial(3 - len(s)) / 24 * (value(row, {*s, i}) - value(row, set(s)))
                       for n in range(4) for s in itertools.combinations(others, n))
            assert phi[i] == pytest.approx(want, abs=1e-9)
        assert base + phi.sum() == pytest.approx(sum(ex.tree_values(row[None], t)[0] for t in trees))


def test_fits_over_few_partitions(spark, data):
    """A table in many small partitions is fitted in as many tasks as there are cores; one fit at a time if it is large."""
    from threading import Lock
    wide = data.repartition(200)
    assert le.spread(wide).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    lock, running, most = Lock(), [0], []

    def task():
        with lock:
            running[0] += 1
            most.append(running[0])
        spark.range(1).count()
        with lock:
            running[0] -= 1

    le.in_parallel([task] * 4, le.LARGE_FIT + 1)
    assert max(most) == 1


def test_hold_out_is_read_once(spark, data, monkeypatch):
    """The fit and its scores read a kept table."""
    df = data.withColumn("split", F.when(F.col("fold") == 0, "test").otherwise("train"))
    seen = []
    monkeypatch.setattr(le, "spread", lambda d: (seen.append(d), d)[1])
    got = le.holdout_roc(df, key="k", make_estimator=lambda n: le.gbt(maxIter=2)).collect()
    assert len(got) == 1 and len(seen) == 1


def test_prefix_of_a_long_fit_is_a_short_fit(data):
    long, short = le.gbt(maxIter=6).fit(data), le.gbt(maxIter=3).fit(data)
    got = ex.prefix_scores(long, data, [3, 6], columns=["k"]).toPandas().pivot(index="k", columns="n_trees", values="p")
    for model, n in ((short, 3), (long, 6)):
        want = le.positive_probability(model.transform(data)).select("k", "p").toPandas().set_index("k").p
        assert np.allclose(got[n].sort_index(), want.sort_index())


def test_out_of_fold_without_fitting(data):
    model = le.logistic(400).fit(data)
    s = le.out_of_fold(data, None, name="m", key="k", models=[model])
    want = {r.k: r.p for r in le.positive_probability(model.transform(data)).collect()}
    assert {r.id: r.p for r in s.collect()} == pytest.approx(want)
    n = []
    le.out_of_fold(data, lambda rows: n.append(rows) or le.logistic(rows), name="m", key="k")
    assert n == [320] * 5   # the training rows, not all rows


def test_validation_cohort(spark, data):
    """Thresholded AUCs after the best round and after all rounds, by hand from the model that stopped."""
    df = data.drop("features", "label").withColumn("noise", F.rand(7))
    main, validation = df.where("k % 4 > 0"), df.where("k % 4 = 0")
    params = {"n_estimators": 40, "max_depth": 2}
    model, cuts = ev.early_stopping(main, list("abcd"), params, key="k", patience=3)
    assert len(model.history) == len(model.trees) <= 40 and model.settings.max_depth == 2
    got = {(r.model, r.rule): r for r in ev.score_validation_cohort(main, validation, list("abcd"), params, key="k", patience=3).collect()}
    assert {m for m, _ in got} == {"best_round", "all_rounds"} and len(got) == 6
    rows = validation.orderBy("k").collect()
    bins = bo.bin_matrix(np.array([[r.a, r.b, r.c, r.d] for r in rows]), cuts)
    y = np.array([r.y_var for r in rows])
    for name, n in (("best_round", model.best_round), ("all_rounds", len(model.trees))):
        hit = bo.logistic(bo.margin_after(bins, model.trees[:n])) > .5
        r = got[name, "p_gt_0.5"]
        assert (r.tp, r.fp, r.tn, r.fn) == (int((hit & (y == 1)).sum()), int((hit & (y == 0)).sum()), int((~hit & (y == 0)).sum()), int((~hit & (y == 1)).sum()))


def test_model_store(spark, data, tmp_path):
    model = le.random_forest(numTrees=3).fit(data)
    mo.save_model(model, str(tmp_path / "m"))
    back = mo.load_model(str(tmp_path / "m"), "random_forest")
    assert [r.p for r in le.positive_probability(back.transform(data)).collect()] == [r.p for r in le.positive_probability(model.transform(data)).collect()]


def test_estimate_text(spark):
    assert spark.range(1).select(estimate_text(F.lit(.5), F.lit(.25), F.lit(.75), 2).alias("t")).first().t == "0.50 (0.25-0.75)"


def test_from_files_to_a_summary(spark, tmp_path):
    """Two extracts and a visit table -> processed table -> stored data models -> cross-validated summary."""
    head = "Patientnummer;UniekLabnummer;Datum_tijd;Testcode;Resultaat;Naam\n"
    visits, lab = [], {1: [], 2: []}
    for p in range(1, 61):
        day, died = 1 + p % 28, "2020-03-30" if p % 3 == 0 else ""
        clock = "" if p == 7 else f"{8 + p % 4:02d}:15"
        visits.append(f"{p},2020-03-{day:02d},{clock},1950-01-{day:02d},{p % 2},{died},0,0,{60 + p}")
        hour = 9 + p % 4 if p != 7 else 8
        for code, value in (("HB", f"{6 + p % 5}.5"), ("NA", str(130 + p % 20)), ("CRP", f"< {p % 9 + 1}")):
            lab[1 + p % 2].append(f"{p};L{p};{day:02d}-03-2020 {hour:02d}:00;{code};{value};X")
    (tmp_path / "v.csv").write_text("nummer,Datum_SEH,Uur_Binnenkomst_SEH,Geboortedatum,Geslacht,Datum_overlijden,septischeshock,"
                                    "Sterfte_in_ziekenhuis,Pols\n" + "\n".join(visits) + "\n")
    for n, lines in lab.items():
        (tmp_path / f"y{n}.txt").write_text(head + "\n".join(lines) + "\n9;L9;01-03-2020 09:00;HB;1;X;\n", encoding="latin-1")
    root = str(tmp_path / "processed")
    paths = [str(tmp_path / f"y{n}.txt") for n in (1, 2)]
    assert bu.build_from_files(spark, paths, str(tmp_path / "v.csv"), root, numeric=["Geslacht", "Sterfte_in_ziekenhuis", "septischeshock", "Pols"], fraction=1.0) == 1
    done = ds.read_processed(spark, root)
    rows = {r.nummer: r for r in done.collect()}
    assert len(rows) == 60 and sorted(r.visit_id for r in rows.values()) == list(range(60))
    assert (rows[7].Datum_SEH.hour, rows[7].Uur_Binnenkomst_SEH, rows[8].lab_HB, rows[8].lab_CRP) == (7, "07:00:00", 9.5, 9.0)
    features = (("nummer", "Geboortedatum", "Geslacht", "Datum_SEH", "Uur_Binnenkomst_SEH"), ("Pols",), ())
    labs = [c for c in done.columns if c.startswith("lab_")]
    cohort = done.where("nummer in (1, 2)").select("nummer", F.to_date("Datum_SEH").alias("Datum_SEH"))
    out = str(tmp_path / "models")
    version = de.derive_and_export(done, cohort, out, models=(1, 2), out=3, as_of="2021-01-01", lab_columns=labs, features=features, key="visit_id")
    one, two = (ds.read_data_model(spark, out, model=m, out=3) for m in (1, 2))
    assert version == 1 and one.count() == 58 and set(two.columns) - set(one.columns) == {"Pols"}
    r = one.where("visit_id = 6").first()   # patient 7: no clock time, so 07:00
    assert r.Uur_Binnenkomst_SEH == pytest.approx(7 / 60) and r.y_var == 0 and r.Geboortedatum == 70
    result = ev.cross_validate(two, [c for c in two.columns if c not in ("visit_id", "y_var")], le.logistic, name="lr", key="visit_id", k=3)
    assert 0 <= result["summary"].first().mean_auc <= 1 and result["scored"].count() == 58
    both = ev.compare({"lr": result, "again": result})
    assert both[0].count() == 2 and both[1].count() == 200


def test_score_dataset_takes_shock_by_key(spark):
    from edcohort.functions.scores import meds
    from edcohort.plans import queries as q
    sf = "/root/testdata/sf0.001"
    got = {r.case_id: r.p for r in q._score(spark, sf, "MEDS").collect()}
    d = q._cases_aged(spark, sf).select("case_id", meds().alias("m")).collect()
    low = {r.case_id for r in d if r.m <= 4}
    assert low and all(got[c] == 0.01 for c in low)


def test_fit_table_lies_on_disk(spark, monkeypatch):
    """The table of the fits is kept on disk: memory is for the copy that a fit makes of it."""
    from edcohort.plans import queries as q
    rows = [(i, i % 2, *[float((i * (j + 3)) % 11) for j in range(len(q.ML_FEATURES))]) for i in range(40)]
    df = spark.createDataFrame(rows, ["case_id", "y_var", *q.ML_FEATURES])
    monkeypatch.setattr(q, "_model", lambda *a: df)
    data = q._ml_data(spark, "")
    assert data.count() == 40 and data.storageLevel.useDisk and not data.storageLevel.useMemory
    data.unpersist()
