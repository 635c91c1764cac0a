"""Global order without a single-task window (H1), stratified folds (M2), hold-out split (M3).

``prefix_sums`` computes running totals over a total order.  A row's bucket is an expression
of its order key alone (the number of split points at or below it; split points come from a
hash sample of the keys), so the totals per (group, bucket) are one partial aggregate, the
local running totals one window on (group, bucket), and nothing depends on where a row ran: no
checkpoint, and a lost executor cannot make the two disagree.  The number of buckets follows
the number of rows, so no window holds more than about ``ROWS_PER_BUCKET`` distinct keys of a
group, however large the group is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PID = "_h1_pid"
#: Rows in one bucket, about; buckets at most, and sampled keys per bucket.
ROWS_PER_BUCKET = 100_000
MAX_BUCKETS = 4096
SAMPLES_PER_BUCKET = 16


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL; the keys come from ``left``."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"_r_{k}"])
    return left.join(right, cond, how).drop(*[f"_r_{k}" for k in keys])


def _split_points(df: DataFrame, buckets: int) -> list:
    """``buckets`` - 1 evenly spaced order keys of a sample by hash (the same in every run)."""
    sample = df.select("_h1_key").orderBy(F.xxhash64("_h1_key"), "_h1_key").limit(buckets * SAMPLES_PER_BUCKET)
    keys = [r[0] for r in sample.orderBy("_h1_key").collect()]   # bounded by MAX_BUCKETS * SAMPLES_PER_BUCKET
    return keys[SAMPLES_PER_BUCKET::SAMPLES_PER_BUCKET][:buckets - 1]


def _bucket(splits: list, kind) -> Column:
    """Number of split points at or below the key: first by blocks, then inside the block."""
    if not splits:
        return F.lit(0)

    def literal(v):
        return F.struct(*[F.lit(x).cast(f.dataType).alias(f.name) for x, f in zip(v, kind.fields)])

    width = math.isqrt(len(splits)) + 1
    blocks = [splits[i:i + width] for i in range(0, len(splits), width)]
    key = F.col("_h1_key")
    firsts = F.array(*[literal(b[0]) for b in blocks])
    block = F.size(F.filter(firsts, lambda v: v <= key))
    inside = F.array(*[F.array(*[literal(v) for v in b]) for b in blocks])
    own = F.size(F.filter(F.get(inside, block - 1), lambda v: v <= key))
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * width + own)


def prefix_sums(df: DataFrame, *, order_by: Sequence, sums: dict[str, Column], partition_by: Sequence[str] = (),
                rows_per_bucket: int | None = None) -> DataFrame:
    """Add ``name`` = running total (inclusive) of each ``sums[name]`` over
    ``order_by`` (ascending) within ``partition_by``; NULL groups are groups.

    ``order_by`` must be a total order inside each group (add a unique key when
    it is not), otherwise tied rows get an arbitrary split of the running total.
    """
    part = list(partition_by)
    per = rows_per_bucket or ROWS_PER_BUCKET
    tmp = {name: f"_h1_v_{name}" for name in sums}
    base = df.withColumns({tmp[k]: v for k, v in sums.items()})
    key = F.struct(*[_as_col(c).alias(f"k{i}") for i, c in enumerate(order_by)])
    base = base.withColumn("_h1_key", key)
    buckets = min(MAX_BUCKETS, -(-df.count() // per))
    splits = _split_points(base, buckets) if buckets > 1 else []
    base = base.withColumn(_PID, _bucket(splits, base.schema["_h1_key"].dataType))
    local = Window.partitionBy(_PID, *part).orderBy("_h1_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = base.withColumns({f"{t}_loc": F.sum(t).over(local) for t in tmp.values()})
    if splits:
        totals = base.groupBy(_PID, *part).agg(*[F.sum(t).alias(t) for t in tmp.values()])
        before = Window.partitionBy(*part).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(
            _PID, *part, *[F.coalesce(F.sum(t).over(before), F.lit(0)).alias(f"{t}_off") for t in tmp.values()])
        out = null_safe_join(out, offsets, [_PID, *part])
    else:
        out = out.withColumns({f"{t}_off": F.lit(0) for t in tmp.values()})
    out = out.withColumns({k: F.col(f"{t}_loc") + F.col(f"{t}_off") for k, t in tmp.items()})
    return out.drop(_PID, "_h1_key", *tmp.values(), *[f"{t}_loc" for t in tmp.values()], *[f"{t}_off" for t in tmp.values()])


def global_ordinal(df: DataFrame, *, order_by: Sequence, name: str = "ordinal",
                   partition_by: Sequence[str] = (), start: int = 0, **kw) -> DataFrame:
    """H1: ``row_number`` over a total order (``start``-based), distributed."""
    out = prefix_sums(df, order_by=order_by, sums={name: F.lit(1)},
                      partition_by=partition_by, **kw)
    return out.withColumn(name, F.col(name) - F.lit(1 - start))


def dense_ordinal(df: DataFrame, *, keys: Sequence[str], name: str = "id", **kw) -> DataFrame:
    """A1 option: dense number (0-based) of distinct ``keys`` in sorted order,
    joined back to every row."""
    distinct = df.select(*keys).distinct()
    numbered = global_ordinal(distinct, order_by=list(keys), name=name, **kw)
    return null_safe_join(df, numbered, list(keys))


def stratified_kfold(df: DataFrame, *, label: str, order_by: Sequence[str], k: int = 5,
                     fold_col: str = "fold", **kw) -> DataFrame:
    """M2: unshuffled stratified k-fold assignment.

    Classes are numbered by first appearance in ``order_by``; class c gets, for
    fold i, as many rows as there are positions congruent to i mod k inside
    class c's block of the class-sorted label vector; a class's rows fill the
    folds in row order, fold 0 first.
    """
    first = F.min(F.struct(*[F.col(c) for c in order_by]))
    classes = df.groupBy(label).agg(first.alias("_first"), F.count(F.lit(1)).alias("_n"))
    # one row per class: a bounded, tiny table
    w = Window.orderBy("_first")
    classes = classes.withColumn(
        "_o", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    o, n = F.col("_o"), F.col("_n")
    alloc = [F.floor((o + n - 1 - i + k) / k) - F.floor((o - 1 - i + k) / k) for i in range(k)]
    bounds = []
    run = None
    for i in range(k - 1):
        run = alloc[i] if run is None else run + alloc[i]
        bounds.append(run)
    classes = classes.select(label, F.array(*bounds).alias("_bounds") if bounds
                             else F.array().cast("array<bigint>").alias("_bounds"))

    ranked = global_ordinal(df, order_by=list(order_by), name="_r", partition_by=[label], **kw)
    out = null_safe_join(ranked, classes, [label])   # one row per class
    fold = F.size(F.filter("_bounds", lambda b: b <= F.col("_r")))
    return out.withColumn(fold_col, fold.cast("int")).drop("_r", "_bounds")


def holdout_split(df: DataFrame, *, key: str, test_fraction: float = 0.3, seed: int = 42,
                  split_col: str = "split", **kw) -> DataFrame:
    """M3: shuffled hold-out split of exact size: the first ceil(test_fraction * n)
    rows in hash order (xxhash64 of key and seed, key breaks ties) are 'test'."""
    n = df.count()
    n_test = math.ceil(test_fraction * n)
    h = F.xxhash64(F.col(key), F.lit(seed))
    ranked = global_ordinal(df.withColumn("_h", h), order_by=["_h", key], name="_r", **kw)
    return (ranked.withColumn(split_col, F.when(F.col("_r") < n_test, "test").otherwise("train"))
            .drop("_h", "_r"))


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], *,
                    group: Sequence[str] = (), **kw) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / ``quantile_cont``),
    per group, without holding a column in one task.

    Value counts (partial aggregation) -> running totals over the distinct
    values (``prefix_sums``) -> for position h = (n - 1) q the values at
    floor(h) and ceil(h) are the distinct values whose count range covers
    them.  Returns (group..., q, quantile)."""
    g = list(group)
    counts = (df.where(F.col(value).isNotNull()).groupBy(*g, value)
              .agg(F.count(F.lit(1)).alias("_c")))
    cum = prefix_sums(counts, order_by=[value], partition_by=g, sums={"_cum": F.col("_c")}, **kw)
    n = cum.groupBy(*g).agg(F.sum("_c").alias("_n"))
    qrows = F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q")
    pos = n.select(*g, "_n", qrows).withColumn("_h", (F.col("_n") - 1) * F.col("q"))
    pos = pos.withColumns({"_lo": F.floor("_h"), "_hi": F.ceil("_h")})
    # each position is covered by exactly one distinct value: cum - c <= pos < cum.
    # pos has len(qs) rows per group; without groups it is len(qs) rows in
    # total, a proven bound, so it is broadcast and the range test runs per row.
    def cover(p_col):
        return (F.col("_cum") - F.col("_c") <= F.col(p_col)) & (F.col(p_col) < F.col("_cum"))

    def attach(positions):
        if g:
            return null_safe_join(cum, positions, g)
        return cum.join(F.broadcast(positions), on=F.lit(True), how="inner")

    lo = attach(pos).where(cover("_lo")).select(
        *g, "q", "_h", "_lo", F.col(value).cast("double").alias("_vlo"))
    hi = attach(pos.select(*g, "q", "_hi")).where(cover("_hi")).select(
        *g, "q", F.col(value).cast("double").alias("_vhi"))
    out = null_safe_join(lo, hi, [*g, "q"])
    return out.select(*g, "q", (F.col("_vlo") + (F.col("_h") - F.col("_lo")) *
                                (F.col("_vhi") - F.col("_vlo"))).alias("quantile"))
