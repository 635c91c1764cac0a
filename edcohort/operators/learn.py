"""Model fitting and cross-validated evaluation with MLlib.

Fits run on executors; the driver only loops over folds, algorithms or grid
points (a handful each).  Predictions are returned as a scored table
(model, fold, id, y, p) -- the input of every evaluation operator.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from . import metrics as me
from .ordinal import null_safe_join

SEED = 42


def assemble(df: DataFrame, features: Sequence[str], *, label: str = "y_var",
             out: str = "features") -> DataFrame:
    """Feature columns -> one vector column; label -> double ``label``."""
    va = VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")
    return va.transform(df).withColumn("label", F.col(label).cast("double"))


# ---------------------------------------------------------------- estimators
def gbt(**kw):
    """M4: gradient-boosted trees (100 rounds of depth-3 trees, rate 0.1)."""
    p = dict(maxIter=100, maxDepth=3, stepSize=0.1, seed=SEED)
    p.update(kw)
    return GBTClassifier(**p)


def logistic(n_rows: int, C: float = 1.0, **kw):
    """M6: L2 logistic regression with the objective of C=1 scaled by 1/n."""
    p = dict(regParam=1.0 / (C * max(n_rows, 1)), elasticNetParam=0.0, standardization=False,
             maxIter=100)
    p.update(kw)
    return LogisticRegression(**p)


def random_forest(**kw):
    """M7: random forest, 100 trees."""
    p = dict(numTrees=100, seed=SEED)
    p.update(kw)
    return RandomForestClassifier(**p)


#: Fits that run at a time; each is itself distributed.  Above ``LARGE_FIT`` rows a fit has tasks for all cores and it alone
#: keeps its copy of the rows: one runs at a time.
PARALLEL_FITS, LARGE_FIT = 4, 2_000_000
#: Rows of a partition of the table that a fit goes over hundreds of times.
FIT_ROWS = 100_000


def spread(data: DataFrame) -> DataFrame:
    """``data`` in as many partitions as it has use for: each step of a fit has a task for each of them."""
    cores = data.sparkSession.sparkContext.defaultParallelism
    return data.repartition(max(cores, -(-data.count() // FIT_ROWS)))


def kept(data: DataFrame) -> DataFrame:
    """``data`` spread and kept on disk until ``unpersist``.  A fit reads it once or twice and keeps its own copy in memory; a second
    one there, in column buffers of more than half a region of the heap each, has no room beside it."""
    return spread(data).persist(StorageLevel.DISK_ONLY)


def in_parallel(tasks: Sequence[Callable], rows: int = 0) -> list:
    """Results of a few driver-side fits over ``rows`` rows each, in order, on a small thread pool."""
    from pyspark import inheritable_thread_target
    with ThreadPoolExecutor(PARALLEL_FITS if rows <= LARGE_FIT else 1) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(t)) for t in tasks]]


def fold_sizes(data: DataFrame, fold: str = "fold") -> dict[int, int]:
    """Rows of each fold (one row per fold comes back)."""
    return {r[fold]: r["count"] for r in data.groupBy(fold).count().collect()}


# ---------------------------------------------------------- out-of-fold
def positive_probability(pred: DataFrame) -> DataFrame:
    return pred.withColumn("p", vector_to_array(F.col("probability"))[1])


def out_of_fold(data: DataFrame, make_estimator: Callable, *, name: str, key: str,
                fold: str = "fold", models: Sequence | None = None) -> DataFrame:
    """Fit on the other folds, predict the held-out fold; union of folds
    -> scored table (model, fold, id, y, p).

    ``make_estimator`` is called with the number of training rows.  Given ``models`` nothing is
    fitted: fold i is scored by ``models[i]``, or all folds by the only one.  The scored table is kept
    once (checkpoint), as every measure reads it."""
    sizes = fold_sizes(data, fold)
    folds, total = sorted(sizes), sum(sizes.values())
    if models is None:
        models = in_parallel([lambda i=i: make_estimator(total - sizes[i]).fit(data.where(F.col(fold) != i)) for i in folds], total)
    elif len(models) == 1:
        models = list(models) * len(folds)
    parts = []
    for i, model in zip(folds, models, strict=True):
        pred = positive_probability(model.transform(data.where(F.col(fold) == i)))
        parts.append(pred.select(F.lit(name).alias("model"), F.col(fold).alias("fold"),
                                 F.col(key).alias("id"), F.col("label").cast("int").alias("y"), "p"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return reliable_checkpoint(out)


def cv_roc(scored: DataFrame, band: str = "ci"):
    """E8 on out-of-fold predictions: (fold AUCs, mean curve with band, summary with accuracy)."""
    fold_auc, curve, summary = me.cross_validated_roc(scored, band=band)
    acc = me.accuracy_cv(scored)
    return fold_auc, curve, null_safe_join(summary, acc, ["model"], "left")


def cv_calibration(scored: DataFrame):
    """Brier summary and averaged calibration bins."""
    return me.brier_cv(scored), me.calibration(scored)


# ---------------------------------------------------------- hold-out
def holdout_roc(df: DataFrame, *, key: str, split: str = "split", make_estimator: Callable = lambda n: gbt(),
                name: str = "holdout") -> DataFrame:
    """Fit on 'train', AUC on 'test'."""
    df = kept(df)
    train = df.where(F.col(split) == "train")
    model = make_estimator(train.count()).fit(train)
    pred = positive_probability(model.transform(df.where(F.col(split) == "test")))
    scored = pred.select(F.lit(name).alias("model"), F.lit(0).alias("fold"),
                         F.col("label").cast("int").alias("y"), "p")
    scored = reliable_checkpoint(scored)
    df.unpersist()
    return me.auc(scored)
