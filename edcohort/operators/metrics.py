"""Evaluation operators on a scored table (model, fold, id, y, p).

Scale notes: every curve starts with a partial aggregation to one row per
(group, distinct score); running totals over the scores use the distributed
``prefix_sums`` (no single-task window over raw rows); the 100-point grid is
filled from at most 100 cell summaries per group, never from a grid x points
product.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .ordinal import null_safe_join, prefix_sums

# Normal quantile and the divisors the source uses for intervals.
Z95 = 1.96
CI_N = 5      # interval of fold statistics: sd / sqrt(5) whatever the fold count
BAND_N = 4    # band around the mean curve: sd / sqrt(4)


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def score_counts(scored: DataFrame, *, group: Sequence[str] = ("model", "fold"),
                 y: str = "y", p: str = "p") -> DataFrame:
    """Positives and negatives per (group, distinct score)."""
    return scored.groupBy(*group, p).agg(F.sum(F.col(y)).cast("bigint").alias("tp"),
                                         F.sum(1 - F.col(y)).cast("bigint").alias("fp"))


def train_part_counts(scored: DataFrame, k: int, *, model: str = "model", fold: str = "fold",
                      y: str = "y", p: str = "p") -> DataFrame:
    """Counts per (model, fold, score) of the *training* part of each of ``k`` folds: rows are
    counted by their own fold first, the counts then go to the other folds."""
    own = score_counts(scored, group=[model, fold], y=y, p=p)
    others = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i != F.col(fold))
    out = own.withColumn("_to", F.explode(others)).groupBy(model, "_to", p)
    return out.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp")).withColumnRenamed("_to", fold)


def cumulated(scored: DataFrame, *, group: Sequence[str] = ("model", "fold"),
              y: str = "y", p: str = "p", counted: bool = False) -> DataFrame:
    """One row per (group, distinct score) with running positives/negatives
    (scores descending) and the group totals ``_P``, ``_N``.  The counts are kept once
    (checkpoint): the running totals read them several times."""
    counts = reliable_checkpoint(scored if counted else score_counts(scored, group=group, y=y, p=p))
    cum = prefix_sums(counts, order_by=[-F.col(p)], partition_by=list(group),
                      sums={"ctp": F.col("tp"), "cfp": F.col("fp")})
    totals = counts.groupBy(*group).agg(F.sum("tp").alias("_P"), F.sum("fp").alias("_N"))
    return null_safe_join(cum, totals, list(group))


def points_from(cum: DataFrame, *, group: Sequence[str] = ("model", "fold"), p: str = "p") -> DataFrame:
    pts = cum.select(*group, F.col(p).alias("threshold"),
                     _div(F.col("cfp"), F.col("_N")).alias("fpr"),
                     _div(F.col("ctp"), F.col("_P")).alias("tpr"))
    start = cum.groupBy(*group).agg((F.max(p) + 1).alias("threshold")).select(
        *group, "threshold", F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def auc_from(cum: DataFrame, *, group: Sequence[str] = ("model", "fold")) -> DataFrame:
    d = lambda c: F.col(c).cast("double")  # noqa: E731  products of counts pass 2**63
    term = d("fp") * (2 * d("ctp") - d("tp"))
    return cum.groupBy(*group).agg(
        _div(F.sum(term), 2 * F.first(d("_P")) * F.first(d("_N"))).alias("auc"),
        F.first("_P").alias("n_pos"), F.first("_N").alias("n_neg"))


def roc_points(scored: DataFrame, *, group: Sequence[str] = ("model", "fold"),
               y: str = "y", p: str = "p") -> DataFrame:
    """(group, threshold, fpr, tpr) for every distinct score, descending,
    plus the start point (0, 0) at threshold max(p) + 1."""
    return points_from(cumulated(scored, group=group, y=y, p=p), group=group, p=p)


def auc(scored: DataFrame, *, group: Sequence[str] = ("model", "fold"),
        y: str = "y", p: str = "p") -> DataFrame:
    """Trapezoid area under the ROC points, as one aggregate:
    sum over scores of fp_i * (2 * cum_tp_i - tp_i) / (2 P N)."""
    return auc_from(cumulated(scored, group=group, y=y, p=p), group=group)


def grid_x(j: Column, n_grid: int = 100) -> Column:
    """x_j of ``np.linspace(0, 1, n_grid)``: j * (1 / (n - 1)), last point exactly 1."""
    step = 1.0 / (n_grid - 1)
    return F.when(j == n_grid - 1, F.lit(1.0)).otherwise(j.cast("double") * F.lit(step))


def roc_grid(points: DataFrame, *, group: Sequence[str] = ("model", "fold"),
             n_grid: int = 100) -> DataFrame:
    """Tpr interpolated (``np.interp``) at ``n_grid`` points of [0, 1];
    the value at 0 is forced to 0.

    Each ROC point is sent to the first grid index whose x is >= its fpr, so a
    grid point sees, through a running max/min over <= n_grid cells, the last
    point with fpr <= x and the first point with fpr > x."""
    j0 = F.ceil(F.col("fpr") * F.lit(float(n_grid - 1))).cast("int")
    j1 = F.when(grid_x(j0, n_grid) < F.col("fpr"), j0 + 1).otherwise(j0)
    cell = F.when((j1 > 0) & (grid_x(j1 - 1, n_grid) >= F.col("fpr")), j1 - 1).otherwise(j1)
    cells = (points.withColumn("_j", cell)
             .groupBy(*group, "_j")
             .agg(F.max(F.struct("fpr", "tpr")).alias("_hi"), F.min(F.struct("fpr", "tpr")).alias("_lo")))
    # grid rows: n_grid per group, made from the (small) group list
    groups = points.select(*group).distinct().withColumn(
        "_j", F.explode(F.sequence(F.lit(0), F.lit(n_grid - 1))))
    g = null_safe_join(groups, cells, [*group, "_j"], "left")
    upto = Window.partitionBy(*group).orderBy("_j").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*group).orderBy("_j").rowsBetween(1, Window.unboundedFollowing)
    g = (g.withColumn("_left", F.max("_hi").over(upto))
         .withColumn("_right", F.min("_lo").over(after)))
    x = grid_x(F.col("_j"), n_grid)
    lf, lt = F.col("_left.fpr"), F.col("_left.tpr")
    rf, rt = F.col("_right.fpr"), F.col("_right.tpr")
    interp = F.when(F.col("_right").isNull(), lt).otherwise(((rt - lt) / (rf - lf)) * (x - lf) + lt)
    return g.select(*group, F.col("_j").alias("j"), x.alias("fpr"),
                    F.when(F.col("_j") == 0, F.lit(0.0)).otherwise(interp).alias("tpr"))


def _summary(per_fold: DataFrame, value: str, group: Sequence[str], ci_n: int = CI_N) -> DataFrame:
    m, s = F.avg(value), F.stddev_pop(value)
    out = per_fold.groupBy(*group).agg(m.alias(f"mean_{value}"), s.alias(f"std_{value}"))
    half = F.lit(Z95) * F.col(f"std_{value}") / F.lit(math.sqrt(ci_n))
    return out.withColumns({f"ci_low_{value}": F.col(f"mean_{value}") - half,
                            f"ci_high_{value}": F.col(f"mean_{value}") + half})


def roc_mean_band(grid: DataFrame, *, model: str = "model", n_grid: int = 100,
                  band_n: int = BAND_N, band: str = "ci") -> DataFrame:
    """E4 (curve): mean tpr over folds per grid point (last forced to 1),
    population sd, band clipped to [0, 1]: mean +- 1.96 sd / sqrt(band_n) (``band='ci'``) or
    mean +- 1 sd (``'sd'``)."""
    if band not in ("ci", "sd"):
        raise ValueError(f"unknown band {band!r}; expected 'ci' or 'sd'")
    agg = grid.groupBy(model, "j").agg(F.first("fpr").alias("fpr"), F.avg("tpr").alias("mean_tpr"),
                                       F.stddev_pop("tpr").alias("std_tpr"))
    mean = F.when(F.col("j") == n_grid - 1, F.lit(1.0)).otherwise(F.col("mean_tpr"))
    half = F.col("std_tpr") * F.lit(Z95 / math.sqrt(band_n) if band == "ci" else 1.0)
    return agg.withColumn("mean_tpr", mean).withColumns({
        "upper": F.least(F.col("mean_tpr") + half, F.lit(1.0)),
        "lower": F.greatest(F.col("mean_tpr") - half, F.lit(0.0))})


def roc_summary(band: DataFrame, fold_auc: DataFrame, *, model: str = "model",
                ci_n: int = CI_N) -> DataFrame:
    """E4 (numbers): AUC of the mean curve (not the mean of fold AUCs),
    population sd of the fold AUCs, interval mean +- 1.96 sd / sqrt(ci_n)."""
    w = Window.partitionBy(model).orderBy("j")
    seg = (F.col("fpr") - F.lag("fpr").over(w)) * (F.col("mean_tpr") + F.lag("mean_tpr").over(w)) / 2.0
    area = band.withColumn("_seg", seg).groupBy(model).agg(F.sum("_seg").alias("mean_auc"))
    sd = fold_auc.groupBy(model).agg(F.stddev_pop("auc").alias("std_auc"))
    half = F.lit(Z95) * F.col("std_auc") / F.lit(math.sqrt(ci_n))
    return (null_safe_join(area, sd, [model]).withColumns({"ci_low": F.col("mean_auc") - half,
                                                  "ci_high": F.col("mean_auc") + half}))


def cross_validated_roc(scored: DataFrame, *, model: str = "model", fold: str = "fold",
                        y: str = "y", p: str = "p", n_grid: int = 100, band: str = "ci", counted: bool = False):
    """E8 on a scored table, or on ``counted`` scores: (fold AUCs, mean curve with band, summary).  The running
    totals and the grid, which the three tables share, are kept once (checkpoint)."""
    group = [model, fold]
    cum = reliable_checkpoint(cumulated(scored, group=group, y=y, p=p, counted=counted))
    fold_auc = auc_from(cum, group=group)
    grid = reliable_checkpoint(roc_grid(points_from(cum, group=group, p=p), group=group, n_grid=n_grid))
    curve = roc_mean_band(grid, model=model, n_grid=n_grid, band=band)
    return fold_auc, curve, roc_summary(curve, fold_auc, model=model)


def accuracy_cv(scored: DataFrame, *, model: str = "model", fold: str = "fold",
                y: str = "y", p: str = "p", threshold: float = 0.5) -> DataFrame:
    """E5: accuracy of p > threshold per fold, then mean/sd/interval over folds."""
    hit = (F.col(y) == (F.col(p) > threshold).cast("int")).cast("double")
    per = scored.groupBy(model, fold).agg(F.avg(hit).alias("accuracy"))
    return _summary(per, "accuracy", [model])


def brier_cv(scored: DataFrame, *, model: str = "model", fold: str = "fold",
             y: str = "y", p: str = "p") -> DataFrame:
    """Brier score per fold, then mean/sd/interval over folds."""
    per = scored.groupBy(model, fold).agg(F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier"))
    return _summary(per, "brier", [model])


def calibration(scored: DataFrame, *, model: str = "model", fold: str = "fold",
                y: str = "y", p: str = "p", n_bins: int = 3) -> DataFrame:
    """Equal-width calibration bins (edges ``linspace(0, 1 + 1e-8, n_bins + 1)``,
    empty bins dropped) per fold, averaged over folds by bin id."""
    step = (1.0 + 1e-8) / n_bins
    b = None
    for i in range(1, n_bins):
        t = (F.col(p) >= F.lit(i * step)).cast("int")
        b = t if b is None else b + t
    b = b if b is not None else F.lit(0)
    per = scored.withColumn("bin", b).groupBy(model, fold, "bin").agg(
        F.avg(p).alias("mean_pred"), F.avg(F.col(y).cast("double")).alias("frac_pos"))
    return per.groupBy(model, "bin").agg(F.avg("mean_pred").alias("mean_pred"),
                                         F.avg("frac_pos").alias("frac_pos"),
                                         F.count(F.lit(1)).alias("n_folds"))


def confusion(df: DataFrame, *, group: Sequence[str], y: str, pred: str) -> DataFrame:
    """A10: tp, fp, tn, fn per group (conditional sums in one aggregate)."""
    yy, pp = F.col(y), F.col(pred)
    return df.groupBy(*group).agg(
        F.sum(((yy == 1) & (pp == 1)).cast("bigint")).alias("tp"),
        F.sum(((yy == 0) & (pp == 1)).cast("bigint")).alias("fp"),
        F.sum(((yy == 0) & (pp == 0)).cast("bigint")).alias("tn"),
        F.sum(((yy == 1) & (pp == 0)).cast("bigint")).alias("fn"))


def with_rates(conf: DataFrame) -> DataFrame:
    """Sensitivity, specificity, and the AUC of a binary predictor (sens + spec) / 2."""
    sens = _div(F.col("tp"), F.col("tp") + F.col("fn"))
    spec = _div(F.col("tn"), F.col("tn") + F.col("fp"))
    return conf.withColumns({"sens": sens, "spec": spec}).withColumn(
        "auc", (F.col("sens") + F.col("spec")) / 2.0)


# The operating points of the validation cohort (name, shift, threshold).
OPERATING_POINTS = (("p_plus_0.1_gt_0.5", 0.1, 0.5), ("p_gt_0.25", 0.0, 0.25), ("p_gt_0.5", 0.0, 0.5))


def threshold_auc(scored: DataFrame, *, model: str = "model", y: str = "y", p: str = "p",
                  rules=OPERATING_POINTS) -> DataFrame:
    """AUC of thresholded predictions ((sens + spec) / 2) at each rule."""
    rule_rows = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(s).alias("shift"),
                                             F.lit(t).alias("threshold")) for n, s, t in rules]))
    x = scored.select(model, y, p, rule_rows.alias("_r")).select(
        model, y, F.col("_r.rule").alias("rule"),
        ((F.col(p) + F.col("_r.shift")) > F.col("_r.threshold")).cast("int").alias("_pred"))
    return with_rates(confusion(x, group=[model, "rule"], y=y, pred="_pred"))
