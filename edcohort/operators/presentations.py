"""Long laboratory results -> one row per presentation.

Shuffle plan of ``build_presentations`` (Entry 1 of the source):
  1. distinct (patient, time)             -> partial aggregate, keys spread
  2. anchor fold per island of a patient  -> one sorted array of distinct times
                                             without a day-long gap between them
  3. rows x anchors on (patient, day)     -> equi-join, <= 2 anchors per key
  4. dedup on (patient, anchor, code)     -> partial aggregate (map-side combine)
  5. pivot on (patient, anchor)           -> explicit code list, one aggregate
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import safe_double
from ..session import reliable_checkpoint
from ..functions.results import CATEGORICAL_CODES, DENY_CODES, normalise_result

_US_PER_MINUTE = 60_000_000
_US_PER_DAY = 86_400_000_000


# ----------------------------------------------------------------- P4, P5, P6
def pilot_slice(df: DataFrame, *, seq: str = "seq", first: int = 1, last: int = 9999) -> DataFrame:
    """Rows ``first``..``last`` by 0-based position in the order of ``seq`` (the source
    keeps positions 1..9999, i.e. 9,999 rows)."""
    from .ordinal import global_ordinal
    return global_ordinal(df, order_by=[seq], name="_position").where(F.col("_position").between(first, last)).drop("_position")


def deny_filter(df: DataFrame, *, code: str = "code", deny: Sequence[str] = DENY_CODES) -> DataFrame:
    """P5: drop archive/comment codes (a NULL code is dropped as well)."""
    return df.where(~F.col(code).isin(*deny))


def code_counts(df: DataFrame, *, code: str = "code") -> DataFrame:
    """A3: frequency table of codes (partial aggregation before the shuffle)."""
    return df.groupBy(code).agg(F.count(F.lit(1)).alias("n"))


def top_codes(df: DataFrame, *, code: str = "code", fraction: float = 0.80, counts: DataFrame | None = None) -> DataFrame:
    """P6 helper: the ``bround(distinct_codes * fraction)`` most frequent codes,
    ties broken by code.  One row per code: bounded by the code catalogue.  ``counts`` are ``df``'s, if they are known."""
    counts = code_counts(df, code=code) if counts is None else counts
    w = Window.orderBy(F.col("n").desc(), F.col(code).asc())
    keep = F.bround(F.count(F.lit(1)).over(Window.partitionBy()) * F.lit(fraction), 0)
    return (counts.withColumn("_rank", F.row_number().over(w)).withColumn("_keep", keep)
            .where(F.col("_rank") <= F.col("_keep")).select(code, "n"))


def top_fraction_filter(df: DataFrame, *, code: str = "code", fraction: float = 0.80) -> DataFrame:
    """Keep rows whose code is among the most frequent ``fraction`` of codes."""
    keep = top_codes(df, code=code, fraction=fraction).select(code)
    # one row per kept code; AQE broadcasts it after checking its runtime size
    return df.join(keep, on=code, how="left_semi")


def step_counts(df: DataFrame, *, patient: str = "patient", ts: str = "ts", code: str = "code",
                fraction: float = 0.80) -> DataFrame:
    """A12 + A1: rows that each step of the build drops before the time grouping, in one pass: no code or a
    denied one, a code outside the top fraction, no time, no patient; and what is left."""
    kept = kept_codes(deny_filter(df, code=code), code=code, fraction=fraction)
    denied = F.col(code).isNull() | F.col(code).isin(*DENY_CODES)
    rare = ~denied & ~F.col(code).isin(*kept)
    used = ~denied & F.col(code).isin(*kept)
    left = used & F.col(ts).isNotNull() & F.col(patient).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(denied).alias("denied"), F.count_if(rare).alias("rare"),
                  F.count_if(used & F.col(ts).isNull()).alias("no_time"),
                  F.count_if(used & F.col(ts).isNotNull() & F.col(patient).isNull()).alias("no_patient"), F.count_if(left).alias("left"),
                  F.count_distinct(F.when(left, F.col(patient))).alias("patients"))


# ------------------------------------------------------------------------ A6
#: Distinct times of an island up to which they are folded as one array.
FOLD_TIMES = 10_000


def linked_anchors(times: DataFrame, gap_us: int) -> DataFrame:
    """A6 for islands of any size: (_p, _island, _a) from distinct times (_p, _island, _t).

    A time's link is the first time at least the gap after it; the anchors are what the links reach from an island's
    first time.  Links are found by numbering the times (one running count over times and the points they ask for), and
    followed by doubling: each round joins the reached times with links that jump twice as far, so a chain of n
    anchors takes about log2(n) rounds, each a join on (patient, island, number).  No step holds an island in one task."""
    from .ordinal import null_safe_join, prefix_sums
    key = ["_p", "_island"]
    asked = times.select(*key, (F.col("_t") + F.lit(gap_us)).alias("_at"), F.col("_t").alias("_from"))
    both = times.select(*key, F.col("_t").alias("_at"), F.lit(None).cast("long").alias("_from")).unionByName(asked)
    # before equal times, a point that is asked for: it has as many times below it as its number says
    both = prefix_sums(reliable_checkpoint(both), order_by=["_at", F.col("_from").isNull().cast("int"), "_from"],
                       partition_by=key, sums={"_below": F.col("_from").isNull().cast("long")})
    both = reliable_checkpoint(both)
    numbered = both.where(F.col("_from").isNull()).select(*key, F.col("_at").alias("_t"), F.col("_below").alias("_i"))
    asks = both.where(F.col("_from").isNotNull()).select(*key, F.col("_from").alias("_t"), (F.col("_below") + 1).alias("_to"))
    last = numbered.groupBy(*key).agg(F.max("_i").alias("_last"))
    links = null_safe_join(null_safe_join(asks, numbered, [*key, "_t"]), last, key)
    links = reliable_checkpoint(links.where(F.col("_to") <= F.col("_last")).select(*key, "_i", "_to"))
    reached = numbered.where(F.col("_i") == 1).select(*key, "_i")
    while True:
        step = null_safe_join(reached, links, [*key, "_i"]).select(*key, F.col("_to").alias("_i"))
        step = reliable_checkpoint(step)
        if not step.limit(1).count():
            break
        reached = reliable_checkpoint(reached.unionByName(step))   # links jump past all reached so far: nothing comes twice
        onward = links.select(*key, F.col("_i").alias("_to"), F.col("_to").alias("_next"))
        links = reliable_checkpoint(null_safe_join(links, onward, [*key, "_to"]).select(*key, "_i", F.col("_next").alias("_to")))
    return null_safe_join(reached, numbered, [*key, "_i"]).select(*key, F.col("_t").alias("_a"))


def anchor_times(df: DataFrame, *, patient: str = "patient", ts: str = "ts",
                 snap_minutes: int = 120, gap_minutes: int = 1440,
                 anchor: str = "anchor", fold_times: int = FOLD_TIMES) -> DataFrame:
    """Anchored time grouping.

    Per patient, over distinct times ascending: the first time is an anchor;
    a time whose whole-minute distance to the current anchor is at most
    ``snap_minutes`` is moved to the anchor; one more than ``gap_minutes`` away
    starts a new anchor; anything in between is discarded (the row is dropped).
    Rows with a NULL time or patient are dropped.  The anchor does not slide.
    """
    t_us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            F.col(ts).cast("timestamp_ntz"))
    rows = df.where(F.col(patient).isNotNull() & F.col(ts).isNotNull()).withColumn("_t", t_us)

    times = rows.select(patient, "_t").distinct().withColumn("_d", F.floor(F.col("_t") / _US_PER_DAY))
    gap_us = (gap_minutes + 1) * _US_PER_MINUTE
    # islands: a time further than the gap from the one before is an anchor whatever the state, so the
    # fold runs per island, not per patient.  Such gaps show in one (first, last) row per patient and
    # day where a gap is a day at least; else a patient is one island.
    if gap_us >= _US_PER_DAY:
        by_day = Window.partitionBy(patient).orderBy("_d")
        days = times.groupBy(patient, "_d").agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
        days = days.withColumn("_new", (F.col("_first") - F.lag("_last").over(by_day) >= F.lit(gap_us)).cast("int"))
        days = days.select(patient, "_d", F.sum(F.coalesce("_new", F.lit(0))).over(by_day).alias("_island"))
        times = times.join(days, on=[patient, "_d"])
    else:
        times = times.withColumn("_island", F.lit(0))
    fold = F.aggregate(
        F.slice("_ts", 2, F.greatest(F.size("_ts") - 1, F.lit(1))),
        F.array(F.element_at("_ts", 1)),
        lambda acc, x: F.when(x - F.element_at(acc, -1) >= F.lit(gap_us),
                              F.concat(acc, F.array(x))).otherwise(acc))
    # the fold holds the times of an island as an array; the islands with too many for that are done by links
    times = reliable_checkpoint(times.select(patient, "_island", "_t"))
    sizes = times.groupBy(patient, "_island").agg(F.count("*").alias("_n"))
    dense = sizes.where(F.col("_n") > fold_times).drop("_n")
    some = dense.limit(1).count() > 0
    small = times.join(dense, [patient, "_island"], "left_anti") if some else times
    anchors = (small.groupBy(patient, "_island").agg(F.array_sort(F.collect_list("_t")).alias("_ts"))
               .select(patient, F.explode(fold).alias("_a")))
    if some:
        large = times.join(dense, [patient, "_island"], "left_semi")
        anchors = anchors.unionByName(linked_anchors(large.select(F.col(patient).alias("_p"), "_island", "_t"), gap_us)
                                      .select(F.col("_p").alias(patient), "_a"))
    # each anchor may govern times in its own day and (near midnight) the next one
    snap_us = (snap_minutes + 1) * _US_PER_MINUTE
    days = F.array_distinct(F.array(F.floor(F.col("_a") / _US_PER_DAY),
                                    F.floor((F.col("_a") + snap_us - 1) / _US_PER_DAY)))
    anchors = anchors.select(patient, "_a", F.explode(days).alias("_day"))

    rows = rows.withColumn("_day", F.floor(F.col("_t") / _US_PER_DAY))
    joined = rows.join(anchors, on=[patient, "_day"], how="inner").where(
        (F.col("_t") >= F.col("_a")) & (F.col("_t") - F.col("_a") < F.lit(snap_us)))
    anchor_ts = F.timestamp_add("MICROSECOND", F.col("_a"),
                                F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return joined.withColumn(anchor, anchor_ts).drop("_t", "_a", "_day")


# ---------------------------------------------------------------- F10 + A4
def normalise(df: DataFrame, *, code: str = "code", result: str = "result") -> DataFrame:
    """F10 on every row: adds ``num``, ``txt``, ``marker``."""
    return df.withColumns(normalise_result(code, result))


def first_attributes(df: DataFrame, attributes: Sequence[str], *, keys: Sequence[str] = ("patient", "anchor"),
                     seq: str = "seq") -> DataFrame:
    """Attributes (such as the lab number) of the first row of each presentation, as one aggregation."""
    first = F.min_by(F.struct(*[F.col(a) for a in attributes]), F.col(seq)).alias("_f")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_f.{a}").alias(a) for a in attributes])


def dedup_first(df: DataFrame, *, keys: Sequence[str] = ("patient", "anchor", "code"),
                seq: str = "seq", values: Sequence[str] = ("num", "txt", "marker"), copies: str | None = None) -> DataFrame:
    """A4: first row (lowest ``seq``) per key, as one aggregation; ``copies`` names a column for the number of its rows."""
    first = F.min_by(F.struct(*[F.col(v) for v in values]), F.col(seq))
    more = [F.count(F.lit(1)).alias(copies)] if copies else []
    return (df.groupBy(*keys).agg(F.min(seq).alias(seq), first.alias("_v"), *more)
            .select(*keys, seq, *[F.col(f"_v.{v}").alias(v) for v in values], *([copies] if copies else [])))


# ---------------------------------------------------------------- P7 + F15
def present_counts(dedup: DataFrame, *, keys: Sequence[str] = ("patient", "anchor")) -> DataFrame:
    """Codes present per presentation (a marker counts as present, the text NaN does not)."""
    present = F.col("num").isNotNull() | F.col("txt").isNotNull() | (F.col("marker") == 1)
    return dedup.groupBy(*keys).agg(F.count_if(present).alias("n_present"))


def sparse_filter(dedup: DataFrame, *, keys: Sequence[str] = ("patient", "anchor"),
                  min_present: int = 2) -> DataFrame:
    """P7 in long form: keep presentations with at least ``min_present`` codes.

    The source drops wide rows with fewer than LAB_THRESHOLD + 4 = 7 non-null
    cells; five cells (patient, lab number, id, time, hour) are always filled,
    so that is two present lab codes."""
    keep = present_counts(dedup, keys=keys).where(F.col("n_present") >= min_present)
    return dedup.join(keep.select(*keys), on=list(keys), how="left_semi")


def marker_means(dedup: DataFrame, *, code: str = "code") -> DataFrame:
    """F15 helper: per code, the mean of its numeric values (text codes: the
    mean of texts that are numbers).  One row per code."""
    value = F.coalesce(F.col("num"), safe_double(F.col("txt")))
    return dedup.groupBy(code).agg(F.avg(value).alias("_mean"))


def resolve_markers(dedup: DataFrame, *, code: str = "code") -> DataFrame:
    """a marker takes its code's mean; NULL when the code has no number."""
    means = marker_means(dedup, code=code)
    is_cat = F.col(code).isin(*CATEGORICAL_CODES)
    out = dedup.join(means, on=code, how="left")   # one row per code; AQE sizes it
    m = F.col("marker") == 1
    return (out.withColumn("num", F.when(m & ~is_cat, F.col("_mean")).otherwise(F.col("num")))
            .withColumn("txt", F.when(m & is_cat, F.col("_mean").cast("string"))
                        .otherwise(F.col("txt")))
            .drop("_mean"))


# ------------------------------------------------------------------ A5 + J1
def lab_column(c: str, prefix: str = "lab_") -> str:
    return f"{prefix}{c}"


def pivot_presentations(long: DataFrame, codes: Sequence[str], *,
                        keys: Sequence[str] = ("patient", "anchor"), code: str = "code",
                        seq: str = "seq", prefix: str = "lab_",
                        categorical: Sequence[str] = CATEGORICAL_CODES) -> DataFrame:
    """A5 + J1: one row per presentation, one column per code of the explicit
    ``codes`` list (numeric codes -> double, categorical codes -> string), plus
    the first row's ``seq``.  Fixed column list = stable plan and schema."""
    aggs = [F.min(seq).alias(seq)]
    for c in codes:
        v = F.col("txt") if c in categorical else F.col("num")
        aggs.append(F.max(F.when(F.col(code) == c, v)).alias(lab_column(c, prefix)))
    return long.groupBy(*keys).agg(*aggs)


# ------------------------------------------------------------- I3, A8, F14, F16
def indicator_columns(df: DataFrame, columns: Sequence[str], *, suffix: str = "binary") -> DataFrame:
    """I3 (complex_zero): ``<c>binary`` = 1 when the value is present."""
    return df.withColumns({f"{c}{suffix}": F.col(c).isNotNull().cast("int") for c in columns})


#: Codes and texts of a category up to which they become columns; more is an error, never a cut.
MAX_CODES = 5000
MAX_CATEGORY_VALUES = 200


def kept_codes(lab: DataFrame, *, code: str = "code", fraction: float = 0.80, counts: DataFrame | None = None) -> list[str]:
    """Codes that P6 keeps, sorted: the columns of the wide table."""
    top = top_codes(lab, code=code, fraction=fraction, counts=counts)
    rows = top.select(code).limit(MAX_CODES + 1).collect()
    if len(rows) > MAX_CODES:
        raise ValueError(f"more than {MAX_CODES} codes to pivot")
    return sorted(r[0] for r in rows)


def category_values(long: DataFrame, *, code: str = "code",
                    categorical: Sequence[str] = CATEGORICAL_CODES) -> dict[str, list[str]]:
    """Distinct texts per categorical code; raises when a code has more than ``MAX_CATEGORY_VALUES``."""
    texts = long.where(F.col(code).isin(*categorical) & F.col("txt").isNotNull()).select(code, "txt").distinct()
    rows = texts.limit(len(categorical) * MAX_CATEGORY_VALUES + 1).collect()   # one job; over the limit some code has too many
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r[0], []).append(r[1])
    for k, v in out.items():
        if len(v) > MAX_CATEGORY_VALUES:
            raise ValueError(f"{k} has more than {MAX_CATEGORY_VALUES} different texts")
    return {k: sorted(v) for k, v in out.items()}


def one_hot(df: DataFrame, values: dict[str, Sequence[str]]) -> DataFrame:
    """Per categorical column, one 0/1 column per value (name = column + value);
    NULL -> all 0; the source column is dropped.  One ``select``."""
    new = {}
    for col, vals in values.items():
        for v in vals:
            new[f"{col}{v}"] = F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0))
    return df.withColumns(new).drop(*values.keys())


def count_positive(columns: Sequence[str]) -> Column:
    """F16: number of listed columns whose value is > 0."""
    terms = [F.coalesce((F.col(c) > 0).cast("int"), F.lit(0)) for c in columns]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


# --------------------------------------------------------------- composition
def build_presentations(lab: DataFrame, codes: Sequence[str] | None = None, *, fraction: float = 0.80,
                        snap_minutes: int = 120, gap_minutes: int = 1440, min_present: int = 2,
                        category_vals: dict[str, Sequence[str]] | None = None,
                        prefix: str = "lab_", fill_zero: bool = True, impute: str | None = None,
                        pilot: bool = False, attributes: Sequence[str] = (),
                        materialize: bool = True, audit=None) -> DataFrame:
    """Entry 1 up to the visit match: lab rows (seq, patient, ts, code, result)
    -> one row per presentation with lab values, presence indicators, one-hot
    categories, zero fill and ``Num_vars``.

    The columns are the codes that the top-fraction filter keeps, and every text of the
    categorical ones.  Given ``codes`` or ``category_vals`` only check that: a kept code or a text
    that they miss is an error.  ``pilot`` keeps the pilot slice, ``impute`` names a strategy of
    ``impute.impute`` for the numeric columns, ``fill_zero=False`` leaves missing numbers NULL;
    ``attributes`` of the first row (``labno``) are kept.  An ``audit`` (``audit.StepAudit``) records each step.

    The deduplicated long rows feed three consumers (presence counts, code
    means, the pivot); ``materialize`` writes them once as a reliable
    checkpoint so the anchor fold and its joins are not recomputed per
    consumer and a lost executor does not re-run them.
    """
    lab = pilot_slice(lab) if pilot else lab
    counts = reliable_checkpoint(code_counts(lab)) if audit is not None else None
    raw, lab = lab, deny_filter(lab)
    kept = kept_codes(lab, fraction=fraction, counts=None if counts is None else deny_filter(counts))
    if codes is not None and set(kept) - set(codes):
        raise ValueError(f"codes without a column: {sorted(set(kept) - set(codes))}")
    codes = kept
    rows = lab.where(F.col("code").isin(*codes)) if codes else lab.where(F.lit(False))
    frequent = rows
    rows = anchor_times(rows, snap_minutes=snap_minutes, gap_minutes=gap_minutes)
    dedup = dedup_first(normalise(rows), copies="_copies" if audit is not None else None)
    if materialize:
        dedup = reliable_checkpoint(dedup)
    if audit is not None:
        n = F.col("n")
        total, allowed, used = counts.agg(F.sum(n), F.sum(F.when(F.col("code").isNotNull() & ~F.col("code").isin(*DENY_CODES), n)),
                                          F.sum(F.when(F.col("code").isin(*codes), n))).first()
        grouped, firsts = dedup.agg(F.sum("_copies"), F.count(F.lit(1))).first()
        dedup = dedup.drop("_copies")
        for name, size, df in (("lab results", total, raw), ("allowed codes", allowed, lab), ("frequent codes", used, frequent),
                               ("grouped times", grouped, rows), ("first results", firsts, dedup)):
            audit.step(name, size, df)
    long = resolve_markers(sparse_filter(dedup, min_present=min_present))
    wide = pivot_presentations(long, codes, prefix=prefix)
    if attributes:
        from .ordinal import null_safe_join
        wide = null_safe_join(wide, first_attributes(rows, attributes), ["patient", "anchor"], "left")
    wide = wide.withColumn("Tijd", (F.hour("anchor") + F.minute("anchor")) / F.lit(60.0))
    lab_cols = [lab_column(c, prefix) for c in codes]
    wide = indicator_columns(wide, lab_cols)
    cats = [c for c in codes if c in CATEGORICAL_CODES]
    found = category_values(long)
    for c, vals in (category_vals or {}).items():
        if set(found.get(c, [])) - set(vals):
            raise ValueError(f"texts of {c} without a column: {sorted(set(found[c]) - set(vals))}")
    values = {lab_column(c, prefix): found.get(c, []) for c in cats}
    wide = one_hot(wide, values)
    numeric = [c for c in lab_cols if c not in values]
    hot = [f"{col}{v}" for col, vals in values.items() for v in vals]
    if impute is not None:
        from .impute import impute as impute_columns
        wide = impute_columns(wide, numeric, impute)
    elif fill_zero:
        wide = wide.fillna(0, subset=numeric)
    counted = numeric + [f"{c}binary" for c in lab_cols] + hot + ["Tijd"]
    return wide.withColumn("Num_vars", count_positive(counted))
