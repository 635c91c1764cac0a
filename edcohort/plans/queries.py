"""Driver-table bindings: one Spark query per operator key (see SURVEY 7.3).

Every query reads whole driver tables through the views in ``views.py``.
Outputs are made comparable with the oracle: timestamps as text, doubles
rounded to 6 places.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.results import CATEGORICAL_CODES, DENY_CODES
from ..operators import boosting as bo
from ..operators import cohort as co
from ..operators import presentations as pr
from ..operators.audit import StepAudit
from ..session import checkpoint_dir, reliable_checkpoint
from ..sources import extracts as ex_
from ..sources.models import load_model, save_model
from . import views as V
from .build import build_processed_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

CATALOGUE = [c for c in V.LAB_CODES if c not in DENY_CODES]


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Timestamps -> 'yyyy-MM-dd HH:mm:ss' text, doubles rounded."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ------------------------------------------------------------ build (Entry 1)
def _lab_top(spark, sf):
    return pr.top_fraction_filter(pr.deny_filter(V.lab(spark, sf)), fraction=0.80)


def _anchored(spark, sf):
    return pr.anchor_times(_lab_top(spark, sf))


def _dedup(spark, sf):
    # three consumers downstream (counts, means, pivot): materialize once
    return reliable_checkpoint(pr.dedup_first(pr.normalise(_anchored(spark, sf))))


def _kept(spark, sf):
    return pr.resolve_markers(pr.sparse_filter(_dedup(spark, sf), min_present=2))


def _wide(spark, sf):
    return pr.build_presentations(V.lab(spark, sf), fraction=0.80)


@query("deny_filter")
def q_deny_filter(spark, sf):
    return pr.code_counts(pr.deny_filter(V.lab(spark, sf)))


@query("code_filter_top")
def q_code_filter_top(spark, sf):
    return pr.top_codes(pr.deny_filter(V.lab(spark, sf)), fraction=0.80)


@query("pilot_slice")
def q_pilot_slice(spark, sf):
    return pr.pilot_slice(V.lab(spark, sf)).select("seq", "patient", "code", "result")


@query("step_counts")
def q_step_counts(spark, sf):
    # some rows of the stand-in lose their time, so that the step has something to count
    lab = V.lab(spark, sf).withColumn("ts", F.when(F.col("seq") % 17 != 0, F.col("ts")))
    return pr.step_counts(lab, fraction=0.80)


@query("result_normalise")
def q_result_normalise(spark, sf):
    return comparable(pr.normalise(V.lab(spark, sf)).select("seq", "code", "num", "txt", "marker"))


@query("anchor_times")
def q_anchor_times(spark, sf):
    return comparable(_anchored(spark, sf).select("seq", "patient", "code", "anchor"))


@query("dedup_first")
def q_dedup_first(spark, sf):
    return comparable(_dedup(spark, sf))


@query("sparse_rows")
def q_sparse_rows(spark, sf):
    counts = pr.present_counts(_dedup(spark, sf))
    return comparable(counts.where(F.col("n_present") >= 2))


@query("marker_mean")
def q_marker_mean(spark, sf):
    kept0 = pr.sparse_filter(_dedup(spark, sf), min_present=2)
    return comparable(pr.marker_means(kept0).withColumnRenamed("_mean", "mean"))


@query("presentation_wide")
def q_presentation_wide(spark, sf):
    """The wide table, one row per presentation and column: its columns come from the data."""
    wide = _wide(spark, sf)
    keys = ["patient", "anchor", "seq", "Tijd", "Num_vars"]
    return comparable(_melt(wide, keys, [c for c in wide.columns if c not in keys]))


def _melt(df, keys, columns):
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns]))
    return df.select(*keys, cells.alias("_c")).select(*keys, "_c.*")


@query("num_vars")
def q_num_vars(spark, sf):
    return comparable(_wide(spark, sf).select("patient", "anchor", "Num_vars"))


@query("one_hot")
def q_one_hot(spark, sf):
    wide = _wide(spark, sf)
    cats = tuple(f"lab_{c}" for c in CATEGORICAL_CODES)
    hot = [c for c in wide.columns if c.startswith(cats) and not c.endswith("binary")]
    return comparable(_melt(wide, ["patient", "anchor"], hot))


@query("visit_lab_match")
def q_visit_lab_match(spark, sf):
    out = build_processed_table(V.lab(spark, sf), V.visits(spark, sf))
    return comparable(out.select("visit_id", "nummer", "Datum_SEH", "anchor", "Num_vars",
                                 "lab_HB", "lab_TRC", "lab_MREBNegatief"))


@query("match_audit")
def q_match_audit(spark, sf):
    audit = co.match_audit(V.visits(spark, sf), _wide(spark, sf))
    return comparable(audit.select("visit_id", "hits", "first_hit", "last_hit"))


# ------------------------------------------------- parsing of text columns
from ..functions.parsing import clock_time, date_and_time, parse_timestamp, safe_double  # noqa: E402


def _texts(spark, sf):
    """Orders with the time, clock and key texts that an extract may hold."""
    o = V.read(spark, sf, "orders")
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    pick = lambda *v: F.element_at(F.array(*v), (k % len(v) + 1).cast("int"))
    none = F.lit(None).cast("string")
    return o.select(
        k.alias("case_id"), F.date_format(day, "yyyy-MM-dd").alias("day"),
        pick(F.concat(F.date_format(day, "dd-MM-yyyy"), F.lit(" 08:15")), F.lit("31-02-2020 08:00"), none, F.lit("soon")).alias("stamp"),
        pick(F.lit("13:45"), F.lit("08:15:30"), none, F.lit("noon"), F.lit("25:00")).alias("clock"),
        pick(k.cast("string"), none, F.concat(k.cast("string"), F.lit("d")), F.concat(F.lit(" "), k.cast("string"))).alias("key"))


@query("parse_coerce")
def q_parse_coerce(spark, sf):
    return comparable(_texts(spark, sf).select("case_id", parse_timestamp("stamp").alias("ts")))


@query("arrival_fill")
def q_arrival_fill(spark, sf):
    t = _texts(spark, sf)
    return comparable(t.select("case_id", date_and_time("day", "clock").alias("arrival"),
                               F.coalesce(F.hour(clock_time("clock")), F.lit(-1)).alias("hour")))


@query("null_key_drop")
def q_null_key_drop(spark, sf):
    t = _texts(spark, sf).select("case_id", safe_double("key").cast("bigint").alias("key"))
    return t.na.drop(subset=["key"])


# ------------------------------------------------------------ derive (Entry 2)
from ..functions import clinical as cl  # noqa: E402
from ..functions import scores as sc  # noqa: E402
from ..functions.parsing import leading_token_number  # noqa: E402
from ..operators import metrics as me  # noqa: E402
from . import evaluate as ev  # noqa: E402
from .derive import data_model, derive_and_export, export_splits  # noqa: E402

AS_OF = "2002-01-01"
CASE_LABS = ["TRC", "URESE"]
# The stand-in registry: the visit-table columns the `cases` view carries.
CASE_FEATURES = (
    ("nummer", "Geboortedatum", "Geslacht", "Datum_SEH", "Uur_Binnenkomst_SEH"),
    ("Comorb_infarct", "Comorb_Hartfalen", "Comorb_dementie_Psychiatrisch",
     "metastase_of_chronische_ziekte_met_hoge_mortaliteit", "Woonsituatie", "Thuismedicatie_aantal"),
    ("Pols", "RR_syst", "RR_diast", "AF_berekend", "Saturatie", "Temperatuur", "GCS_afgeleid",
     "zuurstoftherapie", "WD"),
)


def _cases_aged(spark, sf):
    c = V.cases(spark, sf)
    return c.withColumn("Geboortedatum", cl.age_years("Geboortedatum", AS_OF))


def _model(spark, sf, m, out=3):
    return data_model(V.cases(spark, sf), m, out, as_of=AS_OF, lab_columns=CASE_LABS,
                      features=CASE_FEATURES)


@query("outcome_31d")
def q_outcome_31d(spark, sf):
    c = V.cases(spark, sf)
    return c.select("case_id", cl.outcome_within("Datum_overlijden", "Datum_SEH", 31).alias("y"))


@query("days_to_death")
def q_days_to_death(spark, sf):
    c = V.cases(spark, sf)
    return c.select("case_id", cl.days_to_death("Datum_overlijden", "Datum_SEH").alias("days"))


@query("age_years")
def q_age_years(spark, sf):
    c = V.cases(spark, sf)
    return c.select("case_id", cl.age_years("Geboortedatum", AS_OF).alias("age"))


@query("hour_fraction")
def q_hour_fraction(spark, sf):
    c = V.cases(spark, sf)
    return comparable(c.select("case_id", cl.hour_fraction("Datum_SEH").alias("tijd")))


@query("outcome_select")
def q_outcome_select(spark, sf):
    c = V.cases(spark, sf)
    parts = [cl.select_outcome(c, o).select("case_id", F.col("y_var").alias(f"y{o}"))
             for o in (1, 2, 3)]
    return parts[0].join(parts[1], "case_id").join(parts[2], "case_id")


@query("o2_parse")
def q_o2_parse(spark, sf):
    c = V.cases(spark, sf)
    return comparable(c.select("case_id", leading_token_number("zuurstoftherapie").alias("o2")))


@query("curb")
def q_curb(spark, sf):
    return _cases_aged(spark, sf).select("case_id", sc.curb().alias("curb"))


@query("meds")
def q_meds(spark, sf):
    return _cases_aged(spark, sf).select("case_id", sc.meds().alias("meds"))


@query("abbmeds")
def q_abbmeds(spark, sf):
    return _cases_aged(spark, sf).select("case_id", sc.abbmeds().alias("abbmeds"))


@query("mrems")
def q_mrems(spark, sf):
    return _cases_aged(spark, sf).select("case_id", sc.mrems().alias("mrems"))


@query("score_risk")
def q_score_risk(spark, sf):
    d = _cases_aged(spark, sf)
    return comparable(d.select(
        "case_id",
        sc.risk_score("CURB").alias("curb_risk"),
        sc.risk_score("MEDS").alias("meds_risk"),
        sc.risk_score("REMS").alias("rems_risk"),
        cl.abbmeds_risk(sc.abbmeds()).alias("abbmeds_risk"),
        cl.mean_arterial_pressure().alias("map")))


for _m in (1, 2, 3):
    def _fs(spark, sf, _m=_m):
        return comparable(_model(spark, sf, _m))
    QUERIES[f"feature_set_{_m}"] = _fs


@query("split_main")
def q_split_main(spark, sf):
    s = export_splits(_model(spark, sf, 1), V.cohort(spark, sf))
    return s["main"].select("case_id", "y_var")


@query("split_validation")
def q_split_validation(spark, sf):
    s = export_splits(_model(spark, sf, 1), V.cohort(spark, sf))
    return s["validation"].select("case_id", "nummer", F.col("Datum_SEH").cast("string").alias("Datum_SEH"),
                                  "y_var")


# ------------------------------------------------------- evaluate (Entry 3)
@query("roc_points")
def q_roc_points(spark, sf):
    return comparable(me.roc_points(V.scored(spark, sf)))


@query("auc_by_fold")
def q_auc_by_fold(spark, sf):
    return comparable(me.auc(V.scored(spark, sf)))


@query("roc_grid")
def q_roc_grid(spark, sf):
    return comparable(me.roc_grid(me.roc_points(V.scored(spark, sf))))


@query("roc_mean_band")
def q_roc_mean_band(spark, sf):
    _, band, _ = me.cross_validated_roc(V.scored(spark, sf))
    return comparable(band)


@query("compare_models")
def q_compare_models(spark, sf):
    _, _, summary = me.cross_validated_roc(V.scored(spark, sf))
    return comparable(summary)


@query("accuracy_cv")
def q_accuracy_cv(spark, sf):
    return comparable(me.accuracy_cv(V.scored(spark, sf)))


@query("brier_cv")
def q_brier_cv(spark, sf):
    return comparable(me.brier_cv(V.scored(spark, sf)))


@query("calibration")
def q_calibration(spark, sf):
    return comparable(me.calibration(V.scored(spark, sf)))


@query("threshold_auc")
def q_threshold_auc(spark, sf):
    return comparable(me.threshold_auc(V.scored(spark, sf)))


# ------------------------------------------------- statistics and splits
from ..operators import ordinal as od  # noqa: E402
from ..operators import stats as st  # noqa: E402

RATER_TARGETS = {"Shock": "Shock", "Mortality": "Death"}
RATER_COLUMNS = {t: [f"{t}_Int_{i}" for i in V.RATERS] for t in V.TARGETS}


def _cohorted(spark, sf):
    """Cases with scores, both outcomes and a main/validation label."""
    d = _cases_aged(spark, sf).withColumns({
        "abbMEDS": sc.abbmeds(), "mREMS": sc.mrems(),
        "y_shock": F.col("septischeshock"),
        "y_death": cl.outcome_within("Datum_overlijden", "Datum_SEH", 31)})
    return co.label_cohorts(d, V.cohort(spark, sf))


def _scores_long(df):
    rows = F.explode(F.array(F.struct(F.lit("abbMEDS").alias("score"), F.col("abbMEDS").alias("value")),
                             F.struct(F.lit("mREMS").alias("score"), F.col("mREMS").alias("value"))))
    return df.select("cohort", rows.alias("_s")).select("cohort", "_s.score", "_s.value")


def _with_total(df):
    return df.unionByName(df.withColumn("cohort", F.lit("total")))


@query("kfold")
def q_kfold(spark, sf):
    lab = V.read(spark, sf, "labels").select("doc_id", "quality")
    return od.stratified_kfold(lab, label="quality", order_by=["doc_id"], k=5)


@query("holdout_sizes")
def q_holdout_sizes(spark, sf):
    o = V.read(spark, sf, "orders").select("o_orderkey")
    s = od.holdout_split(o, key="o_orderkey", test_fraction=0.3, seed=42)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("presentation_id")
def q_presentation_id(spark, sf):
    pres = _anchored(spark, sf).select("patient", "anchor").distinct()
    return comparable(od.dense_ordinal(pres, keys=["anchor", "patient"], name="id"))


@query("scale_pop")
def q_scale_pop(spark, sf):
    c = V.cases(spark, sf).select("case_id", "Pols", "TRC", "URESE")
    return comparable(st.standard_scale(c, ["Pols", "TRC", "URESE"]))


def _score(spark, sf, score):
    """The R7 score dataset of a score or several: model 3 as stored, its shock label from the out=1 model."""
    return ev.score_dataset(_model(spark, sf, 3), _model(spark, sf, 1, out=1), score)


@query("score_dataset")
def q_score_dataset(spark, sf):
    return comparable(_score(spark, sf, ("CURB", "MEDS", "REMS", "abbMEDS")))


def _risk_cv(spark, sf, score, **kw):
    return ev.risk_score_cross_validate(_score(spark, sf, score), name=score, **kw)


@query("cv_risk_roc")
def q_cv_risk_roc(spark, sf):
    return comparable(_risk_cv(spark, sf, "CURB")["fold_auc"].drop("model"))


@query("cv_risk_band")
def q_cv_risk_band(spark, sf):
    """The mean curve of the score with both bands."""
    ci = _risk_cv(spark, sf, "CURB")["band"]
    sd = _risk_cv(spark, sf, "CURB", band="sd")["band"]
    sd = sd.select("model", "j", F.col("lower").alias("lower_sd"), F.col("upper").alias("upper_sd"))
    return comparable(ci.join(sd, ["model", "j"]))


@query("compare_data_models")
def q_compare_data_models(spark, sf):
    """The scored models next to CURB and MEDS."""
    _, band, summary = me.cross_validated_roc(V.scored(spark, sf))
    entries = {"models": {"summary": summary, "band": band}}
    entries |= {s: _risk_cv(spark, sf, s, band="sd") for s in ("CURB", "MEDS")}
    return comparable(ev.compare(entries)[0])


@query("rater_points")
def q_rater_points(spark, sf):
    return comparable(st.rater_points(V.raters(spark, sf), RATER_TARGETS, RATER_COLUMNS))


@query("kappa_pairs")
def q_kappa_pairs(spark, sf):
    k = st.kappa_pairs(V.raters(spark, sf), RATER_COLUMNS)
    return comparable(k.select("target", "rater_a", "rater_b", "n", "kappa"))


@query("describe_scores")
def q_describe_scores(spark, sf):
    long = _with_total(_scores_long(_cohorted(spark, sf)))
    return comparable(st.describe(long, group=["cohort", "score"], value="value"))


def _mw(spark, sf):
    return st.mann_whitney(_scores_long(_cohorted(spark, sf)), value="value", cohort="cohort",
                           first="main", second="validation", group=["score"])


@query("mann_whitney")
def q_mann_whitney(spark, sf):
    return comparable(_mw(spark, sf))


@query("mann_whitney_p")
def q_mann_whitney_p(spark, sf):
    return comparable(st.with_normal_p(_mw(spark, sf)))


def _outcomes_long(df):
    rows = F.explode(F.array(F.struct(F.lit("shock").alias("outcome"), F.col("y_shock").alias("y")),
                             F.struct(F.lit("death31").alias("outcome"), F.col("y_death").alias("y"))))
    return df.select("cohort", rows.alias("_o")).select("cohort", "_o.outcome", "_o.y")


def _chi(spark, sf):
    long = _outcomes_long(_cohorted(spark, sf))
    parts = [st.chi_square(long.where(F.col("outcome") == o), value="y", cohort="cohort",
                           cohorts=["main", "validation"]).withColumn("outcome", F.lit(o))
             for o in ("shock", "death31")]
    return parts[0].unionByName(parts[1])


@query("chi_square")
def q_chi_square(spark, sf):
    return comparable(_chi(spark, sf))


@query("chi_square_p")
def q_chi_square_p(spark, sf):
    return comparable(st.with_chi2_p(_chi(spark, sf)))


@query("outcome_freq")
def q_outcome_freq(spark, sf):
    long = _with_total(_outcomes_long(_cohorted(spark, sf)))
    return st.value_frequencies(long, group=["cohort", "outcome"], value="y")


@query("crosstab")
def q_crosstab(spark, sf):
    long = _outcomes_long(_cohorted(spark, sf)).where(F.col("outcome") == "death31")
    return st.crosstab(long, value="y", cohort="cohort", cohorts=["main", "validation"])


# ------------------------------------------------------------- imputation
from ..operators import impute as im  # noqa: E402

NUMERIC_CATALOGUE = [c for c in CATALOGUE if c not in CATEGORICAL_CODES]
NUMERIC_LAB_COLS = [f"lab_{c}" for c in NUMERIC_CATALOGUE]


def _wide_raw(spark, sf):
    """Wide numeric lab table before any fill (presence = non-NULL)."""
    return pr.pivot_presentations(_kept(spark, sf), NUMERIC_CATALOGUE)


@query("impute_zero")
def q_impute_zero(spark, sf):
    w = im.impute(_wide_raw(spark, sf), NUMERIC_LAB_COLS, "zero")
    return comparable(w.select("patient", "anchor", *NUMERIC_LAB_COLS))


@query("impute_median")
def q_impute_median(spark, sf):
    w = im.impute(_wide_raw(spark, sf), NUMERIC_LAB_COLS, "median")
    return comparable(w.select("patient", "anchor", *NUMERIC_LAB_COLS))


@query("impute_indicator")
def q_impute_indicator(spark, sf):
    w = im.impute(_wide_raw(spark, sf), NUMERIC_LAB_COLS, "complex_zero")
    return comparable(w.select("patient", "anchor", *[f"{c}binary" for c in NUMERIC_LAB_COLS]))


@query("impute_indicator2")
def q_impute_indicator2(spark, sf):
    w = im.impute(_wide_raw(spark, sf), NUMERIC_LAB_COLS, "complex_zero2")
    return comparable(w.select("patient", "anchor", *[f"{c}binary" for c in NUMERIC_LAB_COLS]))


from ..operators import neighbours as ne  # noqa: E402


@query("impute_knn")
def q_impute_knn(spark, sf):
    w = ne.impute_knn(_wide_raw(spark, sf), NUMERIC_LAB_COLS)
    return comparable(w.select("patient", "anchor", *NUMERIC_LAB_COLS))


@query("impute_complex")
def q_impute_complex(spark, sf):
    w = ne.impute_complex(_wide_raw(spark, sf), NUMERIC_LAB_COLS)
    return comparable(w.select("patient", "anchor", *NUMERIC_LAB_COLS, *[f"{c}binary" for c in NUMERIC_LAB_COLS]))


# --------------------------------------------------------- model fitting
from ..operators import learn as le  # noqa: E402

ML_FEATURES = [c for group in CASE_FEATURES for c in group if c not in ("nummer", "Datum_SEH")] \
    + CASE_LABS
ML_FOLDS = 5


def _ml_data(spark, sf, k=ML_FOLDS):
    d = _model(spark, sf, 3)
    d = od.stratified_kfold(d, label="y_var", order_by=["case_id"], k=k)
    # fitted k times: keep the assembled input (recomputed from lineage if an executor is lost)
    return le.kept(le.assemble(d, ML_FEATURES).select("case_id", "fold", "label", "features"))


def _cv(spark, sf, name, make):
    data = _ml_data(spark, sf)
    scored = le.out_of_fold(data, make, name=name, key="case_id")
    data.unpersist()
    return scored


def _cv_summary(scored):
    _, _, summary = le.cv_roc(scored)
    return comparable(summary)


@query("cv_gbt")
def q_cv_gbt(spark, sf):
    return _cv_summary(_cv(spark, sf, "gbt", lambda n: le.gbt()))


@query("cv_lr")
def q_cv_lr(spark, sf):
    return _cv_summary(_cv(spark, sf, "logistic", le.logistic))


@query("cv_rf")
def q_cv_rf(spark, sf):
    return _cv_summary(_cv(spark, sf, "random_forest", lambda n: le.random_forest()))


@query("cv_mlp")
def q_cv_mlp(spark, sf):
    """M9: the small network, trained by mini-batches."""
    return _cv_summary(tu.network_scores(_folded(spark, sf), ML_FEATURES, key="case_id", name="neural_net"))


@query("cv_calibration")
def q_cv_calibration(spark, sf):
    """Brier summary and calibration bins, one row per bin."""
    brier, bins = le.cv_calibration(_cv(spark, sf, "logistic", le.logistic))
    return comparable(od.null_safe_join(bins, brier, ["model"]))


@query("cv_counts")
def q_cv_counts(spark, sf):
    """Rows and positives of the scored table per fold: what a fit cannot change."""
    s = _cv(spark, sf, "logistic", le.logistic)
    return s.groupBy("model", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").cast("bigint").alias("n_pos"),
                                          F.sum(F.col("p").between(0, 1).cast("bigint")).alias("n_scored"))


def _holdout_data(spark, sf):
    d = od.holdout_split(_model(spark, sf, 3), key="case_id", test_fraction=0.3, seed=42)
    return le.assemble(d, ML_FEATURES).select("case_id", "split", "label", "features")


@query("holdout_roc")
def q_holdout_roc(spark, sf):
    return comparable(le.holdout_roc(_holdout_data(spark, sf), key="case_id",
                                     make_estimator=lambda n: le.gbt()))


@query("validation_scoring")
def q_validation_scoring(spark, sf):
    """M5 -> E13: boosting stopped on the main cohort's test part, thresholded AUCs on the validation
    cohort.  Parameters are the defaults: the stand-in parameter table names settings at random."""
    parts = export_splits(_model(spark, sf, 3), V.cohort(spark, sf))
    return comparable(ev.score_validation_cohort(parts["main"], parts["validation"], ML_FEATURES, {}))


# ------------------------------------------------- distillation, grid search
from ..operators import tuning as tu  # noqa: E402

# The sizes, depths and numbers of trees that the source tries.
TOP_N = (20, 15, 10, 5, 3, 1)
DEPTHS = (3, 5, 7, 9, 11, 13, 15)
TREES = (100, 150, 200, 250, 300, 350)


def _folded(spark, sf):
    d = od.stratified_kfold(_model(spark, sf, 3), label="y_var", order_by=["case_id"], k=ML_FOLDS)
    return reliable_checkpoint(d.select("case_id", "fold", "y_var", *ML_FEATURES))


@query("distil")
def q_distil(spark, sf):
    """AUC over five folds with the first 20, 15, 10, 5, 3 and 1 features."""
    return comparable(tu.distil(_folded(spark, sf), ML_FEATURES, TOP_N, key="case_id"))


@query("distil_counts")
def q_distil_counts(spark, sf):
    """Rows, positives and scores in [0, 1] of each size and fold, after a few rounds: what a fit cannot change."""
    s = tu.distilled(_folded(spark, sf), ML_FEATURES, TOP_N, key="case_id", rounds=2)
    return s.groupBy("model", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").cast("bigint").alias("n_pos"),
                                          F.sum(F.col("p").between(0, 1).cast("bigint")).alias("n_scored"))


# ------------------------------------------------------ versions, parameters
from ..sources import datasets as ds  # noqa: E402


def _versioned(spark, sf):
    c = V.cases(spark, sf)
    return c.select("case_id", ((F.year("Datum_SEH") % 7) + 1).cast("int").alias("version"))


@query("latest_version")
def q_latest_version(spark, sf):
    return ds.latest_version(_versioned(spark, sf))


def _param_table(spark, sf):
    o = V.read(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("param_id"), F.col("o_orderpriority").alias("algorithm"), (k % 7).cast("int").alias("algo_version"),
        (k % 3).cast("int").alias("model_version"), (F.col("o_custkey") % 3 + 1).cast("int").alias("data_model"),
        (k % 2 + 1).cast("int").alias("out"),
        F.concat(F.lit("max_depth="), (k % 13 + 3).cast("string"), F.lit(";n_estimators="),
                 (k % 6 * 50 + 100).cast("string"), F.lit(";key="), k.cast("string")).alias("params"))


@query("hyper_params")
def q_hyper_params(spark, sf):
    return ds.latest_parameters(_param_table(spark, sf))


# ------------------------------------------------------ baseline table
def _long(df, section, cohort, item, stats):
    rows = F.explode(F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("value"))
                               for s in stats]))
    return df.select(F.lit(section).alias("section"), cohort.alias("cohort"), item.alias("item"),
                     rows.alias("_s")).select("section", "cohort", "item", "_s.stat", "_s.value")


@query("baseline_table")
def q_baseline_table(spark, sf):
    """Scores described per cohort, Mann-Whitney between cohorts, chi-square
    and frequencies of the outcomes, as one long table."""
    coh = _cohorted(spark, sf)
    desc = st.describe(_with_total(_scores_long(coh)), group=["cohort", "score"], value="value")
    parts = [
        _long(desc, "describe", F.col("cohort"), F.col("score"),
              ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]),
        _long(st.with_normal_p(_mw(spark, sf)), "mann_whitney", F.lit("main_vs_validation"), F.col("score"), ["u", "z", "p"]),
        _long(st.with_chi2_p(_chi(spark, sf)), "chi_square", F.lit("main_vs_validation"), F.col("outcome"),
              ["chi2", "dof", "p"]),
    ]
    freq = st.value_frequencies(_with_total(_outcomes_long(coh)), group=["cohort", "outcome"], value="y")
    parts.append(_long(freq, "frequency", F.col("cohort"),
                       F.concat(F.col("outcome"), F.lit("="), F.col("y").cast("string")), ["n"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return comparable(out)


@query("match_histogram")
def q_match_histogram(spark, sf):
    return co.hit_histogram(co.match_audit(V.visits(spark, sf), _wide(spark, sf)))


@query("impute_mice")
def q_impute_mice(spark, sf):
    w = im.impute(_wide_raw(spark, sf), NUMERIC_LAB_COLS, "MICE")
    return comparable(w.select("patient", "anchor", *NUMERIC_LAB_COLS))


# ------------------------------------------------------------ attribution
from ..operators import explain as ex  # noqa: E402


def _attribution(spark, sf):
    data = le.kept(_holdout_data(spark, sf))   # the fit reads it several times
    model = le.gbt().fit(data.where(F.col("split") == "train"))
    test = reliable_checkpoint(data.where(F.col("split") == "test"))
    data.unpersist()
    return ex.attribution(model, test, ML_FEATURES, key="case_id")


@query("attribution")
def q_attribution(spark, sf):
    return comparable(_attribution(spark, sf))


@query("attribution_sums")
def q_attribution_sums(spark, sf):
    """Cases attributed, and the largest gap between base + values and the margin."""
    a = _attribution(spark, sf)
    margin = F.when(F.col("feature") == "_margin", -F.col("contribution")).otherwise(F.col("contribution"))
    gap = a.groupBy("case_id").agg(F.sum(margin).alias("gap"))
    return comparable(gap.agg(F.count(F.lit(1)).alias("n_cases"), F.abs(F.max(F.abs("gap"))).alias("gap")))


@query("cv_gbt_leafwise")
def q_cv_gbt_leafwise(spark, sf):
    """M8: best-first trees of 31 leaves."""
    return _cv_summary(tu.boosted_scores(_folded(spark, sf), ML_FEATURES, {"gbt_leafwise": "leafwise"}, key="case_id"))


# ------------------------------------------------- five algorithms
@query("compare_algorithms")
def q_compare_algorithms(spark, sf):
    """Each two of the five algorithms, their AUCs compared fold by fold."""
    return comparable(tu.paired_differences(tu.algorithm_scores(_folded(spark, sf), ML_FEATURES, key="case_id")))


@query("compare_algorithms_counts")
def q_compare_algorithms_counts(spark, sf):
    """Rows, positives and scores in [0, 1] of each algorithm and fold, after short fits: what a fit cannot change."""
    s = tu.algorithm_scores(_folded(spark, sf), ML_FEATURES, key="case_id", rounds=1, trees=2, epochs=1)
    return s.groupBy("model", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").cast("bigint").alias("n_pos"),
                                          F.sum(F.col("p").between(0, 1).cast("bigint")).alias("n_scored"))


@query("early_stop_history")
def q_early_stop_history(spark, sf):
    """M5: log-loss and error of each round that ran, on the training and the test part."""
    model, _ = ev.early_stopping(_model(spark, sf, 3), ML_FEATURES, {})
    return comparable(bo.history(spark, [model]).drop("fold"))


@query("grid_counts")
def q_grid_counts(spark, sf):
    """Rows and positives of each depth, number of trees and fold of the whole grid."""
    ledger = f"{checkpoint_dir(spark)}/grid-{uuid.uuid4()}"
    s = tu.grid_scores(_folded(spark, sf), ML_FEATURES, DEPTHS, TREES, key="case_id", ledger=ledger)
    return s.groupBy("max_depth", "n_trees", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").cast("bigint").alias("n_pos"))


# ------------------------------------------------------- imputation, scaling
@query("impute_mice_cells")
def q_impute_mice_cells(spark, sf):
    """Per column, the cells observed and their sum (unchanged), the cells imputed, and those left empty."""
    raw = _wide_raw(spark, sf)
    raw = reliable_checkpoint(raw.withColumns({f"was_{c}": F.col(c).isNotNull() for c in NUMERIC_LAB_COLS}))
    w = im.impute(raw, NUMERIC_LAB_COLS, "MICE")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("x"), F.col(f"was_{c}").alias("was"))
                                for c in NUMERIC_LAB_COLS]))
    w = w.select(cells.alias("_c")).select("_c.*")
    seen = F.col("was")
    return comparable(w.groupBy("column").agg(
        F.count_if(seen).alias("n_observed"), F.sum(F.when(seen, F.col("x"))).alias("sum_observed"),
        F.count_if(~seen & F.col("x").isNotNull()).alias("n_imputed"), F.count_if(F.col("x").isNull()).alias("n_empty")), 3)


@query("scale_fold")
def q_scale_fold(spark, sf):
    """M1: columns scaled with the moments of the other folds' rows."""
    d = od.stratified_kfold(_model(spark, sf, 3), label="y_var", order_by=["case_id"], k=ML_FOLDS)
    return comparable(st.scale_by_fold(d.select("case_id", "fold", "Pols", "TRC", "URESE"), ["Pols", "TRC", "URESE"]))


# --------------------------------------------------------- steps, extracts
@query("build_steps")
def q_build_steps(spark, sf):
    """Rows of each step of the build, as kept with the processed version."""
    root = f"{checkpoint_dir(spark)}/processed-{uuid.uuid4()}"
    audit = StepAudit()
    ds.write_processed(build_processed_table(V.lab(spark, sf), V.visits(spark, sf), audit=audit), root, audit=audit)
    return ds.read_steps(spark, root).select("position", "step", "n_rows")


def _extracts(spark, sf):
    return V.write_lab_extracts(spark, sf, f"{checkpoint_dir(spark)}/extracts-{uuid.uuid4()}")


@query("extract_scan")
def q_extract_scan(spark, sf):
    """The lab results read back from yearly Latin-1 extract files."""
    lab = ex_.read_lab_extract(spark, _extracts(spark, sf))
    return comparable(lab.select("patient", "labno", "ts", "code", "result"))


@query("extract_quarantine")
def q_extract_quarantine(spark, sf):
    """Lines of the extracts whose field count is not the header's, by year, reason and use."""
    paths = _extracts(spark, sf)
    out = None
    for path in paths:
        q = ex_.lab_quarantine(spark, [path]).withColumn("year", F.lit(int(path.rpartition("=")[2])))
        out = q if out is None else out.unionByName(q)
    return out.groupBy("year", "reason", "used", "n_fields").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("line").contains("Müller")).alias("n_umlaut"),
        F.sum(F.length("line")).alias("n_chars"))


# ---------------------------------------------- E8 on continuous scores
@query("compare_models_continuous")
def q_compare_models_continuous(spark, sf):
    """Fold AUCs, spread and mean curve's area of scores of which nearly each is its own."""
    s = V.scored_continuous(spark, sf)
    fold_auc, _, summary = me.cross_validated_roc(s)
    per = fold_auc.groupBy("model").agg(F.count(F.lit(1)).alias("n_folds"), F.min("auc").alias("min_auc"), F.max("auc").alias("max_auc"))
    return comparable(od.null_safe_join(summary.select("model", "std_auc"), per, ["model"]))


@query("visit_scan")
def q_visit_scan(spark, sf):
    """The visits read back from a comma-separated table, with arrival times made of date and clock."""
    path = V.write_visit_table(spark, sf, f"{checkpoint_dir(spark)}/visits-{uuid.uuid4()}")
    v = ex_.read_visits(spark, path, numeric=["Pols"])
    return comparable(v.select(F.col("visit_no").cast("bigint").alias("visit_no"), "nummer", "Datum_SEH", "Pols"))


@query("data_model_scan")
def q_data_model_scan(spark, sf):
    """Rows, positives and columns of two data models, read back from a committed version of each split."""
    root = f"{checkpoint_dir(spark)}/models-{uuid.uuid4()}"
    derive_and_export(V.cases(spark, sf), V.cohort(spark, sf), root, models=(1, 3), out=3, as_of=AS_OF, lab_columns=CASE_LABS,
                      features=CASE_FEATURES)
    out = None
    for m in (1, 3):
        for split in ("main", "validation"):
            d = ds.read_data_model(spark, root, model=m, out=3, split=split)
            row = d.agg(F.count(F.lit(1)).alias("n"), F.sum("y_var").cast("bigint").alias("n_pos")).select(
                F.lit(m).alias("data_model"), F.lit(split).alias("split"), "n", "n_pos", F.lit(len(d.columns)).alias("n_columns"))
            out = row if out is None else out.unionByName(row)
    return out


@query("model_store")
def q_model_store(spark, sf):
    """Cases of the test part, and those that a stored and loaded model scores as the fitted one."""
    d = _holdout_data(spark, sf).persist()
    train, test = d.where("split = 'train'"), d.where("split = 'test'")
    model = le.logistic(train.count()).fit(train)
    path = f"{checkpoint_dir(spark)}/model-{uuid.uuid4()}"
    save_model(model, path)
    a, b = (le.positive_probability(m.transform(test)).select("case_id", F.col("p").alias(n))
            for m, n in ((model, "p"), (load_model(path, "logistic"), "q")))
    j = a.join(b, "case_id")
    return j.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p") == F.col("q")).alias("n_equal"))


@query("estimate_text")
def q_estimate_text(spark, sf):
    """the AUC of each model and fold with its model's range, as text."""
    a = me.auc(V.scored(spark, sf))
    w = Window.partitionBy("model")
    return a.select("model", "fold", cl.estimate_text("auc", F.min("auc").over(w), F.max("auc").over(w)).alias("estimate"))
