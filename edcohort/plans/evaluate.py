"""Entry 3 (evaluate): data model -> stratified folds -> out-of-fold predictions
-> ROC / calibration tables, optionally next to a clinical risk score."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scores as sc
from ..functions.clinical import abbmeds_risk
from ..operators import boosting as bo
from ..operators import learn as le
from ..operators import metrics as me
from ..operators.ordinal import holdout_split, stratified_kfold
from ..session import reliable_checkpoint


def cross_validate(df: DataFrame, features: Sequence[str], make_estimator: Callable, *,
                   name: str, key: str = "case_id", label: str = "y_var", k: int = 5, band: str = "ci") -> dict:
    """E8 + E10 for one model: {'scored', 'fold_auc', 'band', 'summary', 'brier',
    'calibration'}.  ``make_estimator`` gets the number of training rows."""
    folded = stratified_kfold(df, label=label, order_by=[key], k=k)
    data = le.kept(le.assemble(folded, features, label=label).select(key, "fold", "label", "features"))
    scored = le.out_of_fold(data, make_estimator, name=name, key=key)
    data.unpersist()
    fold_auc, curve, summary = le.cv_roc(scored, band=band)
    brier, calib = le.cv_calibration(scored)
    return {"scored": scored, "fold_auc": fold_auc, "band": curve, "summary": summary,
            "brier": brier, "calibration": calib}


#: Rows, about, that one task of a join sorts.
JOIN_ROWS = 250_000


def score_dataset(data: DataFrame, shock: DataFrame, score: str | Sequence[str], *, key: str = "case_id", label: str = "y_var",
                  shock_label: str = "y_var", **names) -> DataFrame:
    """R7 + J6: (key, y, p) of a clinical score on a stored data model, or (key, y, p, score) of several by one join.  The
    shock column that MEDS needs was dropped from the stored model with the outcomes; it is the label of the
    out=1 model and is joined by key (a case without one counts as no shock)."""
    parts = -(-data.count() // JOIN_ROWS)
    s = shock.select(F.col(key).alias("_key"), F.col(shock_label).alias("septischeshock"))
    d = data.drop("septischeshock")
    if parts > 1:   # as many tasks as the rows ask for, however well they are packed
        d, s = d.repartition(parts, key), s.repartition(parts, "_key")
    d = d.join(s, F.col(key) == F.col("_key"), "left").drop("_key")
    d = d.withColumn("septischeshock", F.coalesce("septischeshock", F.lit(0)))
    risk = lambda n: sc.risk_score(n, **names) if n != "abbMEDS" else abbmeds_risk(sc.abbmeds(**names))
    if isinstance(score, str):
        return d.select(key, F.col(label).alias("y"), risk(score).alias("p"))
    each = F.explode(F.array(*[F.struct(risk(n).cast("double").alias("p"), F.lit(n).alias("score")) for n in score]))
    return d.select(key, F.col(label).alias("y"), each.alias("_s")).select(key, "y", "_s.p", "_s.score")


def risk_score_cross_validate(scored: DataFrame, *, name: str, key: str = "case_id", k: int = 3, part: str = "train",
                              band: str = "ci") -> dict:
    """{'fold_auc', 'band', 'summary'} of a fixed score (key, y, p), on the training part of each
    fold (``part='train'``, as the source) or on the held-out fold (``'test'``)."""
    d = stratified_kfold(scored.select(key, "y", "p"), label="y", order_by=[key], k=k).withColumn("model", F.lit(name))
    if part == "train":
        d = me.train_part_counts(d, k)
    fold_auc, curve, summary = me.cross_validated_roc(d, band=band, counted=part == "train")
    return {"fold_auc": fold_auc, "band": curve, "summary": summary}


def compare(entries: dict[str, dict]) -> tuple[DataFrame, DataFrame]:
    """(summaries, mean curves with bands) of models and scores, as two tables; each entry is
    a result of ``cross_validate`` or ``risk_score_cross_validate`` with the band its caller chose."""
    tables = []
    for part in ("summary", "band"):
        out = None
        for name, result in entries.items():
            s = result[part].withColumn("entry", F.lit(name))
            out = s if out is None else out.unionByName(s, allowMissingColumns=True)
        tables.append(out)
    return tables[0], tables[1]


def early_stopping(main: DataFrame, features: Sequence[str], params: dict, *, key: str = "case_id", label: str = "y_var",
                   patience: int = 10):
    """M3 + M5: (model, cut points) of boosting on a 70/30 split of ``main`` that stops after ``patience`` rounds without a lower
    log-loss on the test part; the model's ``history`` has log-loss and error of both parts."""
    d = holdout_split(main, key=key)
    d = reliable_checkpoint(d.select(key, label, *features, (F.col("split") == "test").cast("int").alias("fold")))
    cuts = bo.cut_points(d, features)
    blocks = reliable_checkpoint(bo.blocks_of(d, features, cuts, key=key, label=label))
    model, = bo.boost(blocks, cuts, [bo.profile("depthwise", name="stopped", leave_out=1, patience=patience,
                                                rounds=params.get("n_estimators", 100),
                                                max_depth=params.get("max_depth", 3))])
    return model, cuts


def score_validation_cohort(main: DataFrame, validation: DataFrame, features: Sequence[str], params: dict, *, key: str = "case_id",
                            label: str = "y_var",
                            patience: int = 10) -> DataFrame:
    """M3 + M5 + E13 with the parameters of S10: boosting stopped on the test part of the main cohort; thresholded AUCs on
    the validation cohort after the best round and after all rounds that ran."""
    main = reliable_checkpoint(main.select(key, label, *features))   # the split reads it several times
    model, cuts = early_stopping(main, features, params, key=key, label=label, patience=patience)
    best, ran = model.best_round, len(model.trees)
    scored = bo.scores(bo.blocks_of(validation, features, cuts, key=key, label=label, fold=None), [model], [best, ran], held_out=False)
    names = [F.when(F.col("n_trees") == best, "best_round"), F.when(F.col("n_trees") == ran, "all_rounds")]
    scored = scored.withColumn("model", F.explode(F.array_compact(F.array(*names))))
    return me.threshold_auc(scored)
