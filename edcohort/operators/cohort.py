"""Visit matching and cohort splits.

``match_visits`` is an interval join written as an equi-join on
(patient, day) plus the strict range predicate: the visit side is expanded to
the (at most two) days its window touches, so no patient's visits are paired
with all of that patient's presentations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_US_PER_MINUTE = 60_000_000
_US_PER_DAY = 86_400_000_000
_EPOCH = "1970-01-01 00:00:00"


def _us(col: str):
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"),
                            F.col(col).cast("timestamp_ntz"))


def visit_hits(visits: DataFrame, presentations: DataFrame, *, visit_key: str = "visit_id",
               v_patient: str = "nummer", v_time: str = "Datum_SEH",
               p_patient: str = "patient", p_time: str = "anchor",
               window_minutes: int = 900) -> DataFrame:
    """All (visit, presentation) pairs with the same patient and
    ``v_time < p_time < v_time + window`` (strict at both ends)."""
    win_us = window_minutes * _US_PER_MINUTE
    v = visits.withColumn("_vt", _us(v_time))
    days = F.sequence(F.floor(F.col("_vt") / _US_PER_DAY),
                      F.floor((F.col("_vt") + win_us) / _US_PER_DAY))
    v = v.withColumn("_vday", F.explode(days))
    p = (presentations.withColumnRenamed(p_patient, "_pp").withColumn("_pt", _us(p_time))
         .withColumn("_pday", F.floor(F.col("_pt") / _US_PER_DAY)))
    overlap = [c for c in p.columns if c in set(v.columns)]
    p = p.drop(*overlap)
    cond = [(F.col(v_patient) == F.col("_pp")), (F.col("_vday") == F.col("_pday")),
            (F.col("_pt") > F.col("_vt")), (F.col("_pt") < F.col("_vt") + F.lit(win_us))]
    out = v.join(p, on=cond, how="inner").drop("_vt", "_pt", "_vday", "_pday")
    return out.drop("_pp") if p_patient in v.columns else out.withColumnRenamed("_pp", p_patient)


def match_visits(visits: DataFrame, presentations: DataFrame, *, visit_key: str = "visit_id",
                 v_patient: str = "nummer", v_time: str = "Datum_SEH",
                 p_patient: str = "patient", p_time: str = "anchor",
                 window_minutes: int = 900, require_unique: bool = True) -> DataFrame:
    """Visit columns + presentation columns (names already in the visit
    table are dropped from the presentation side, P11) for visits with exactly
    one presentation in range."""
    if not require_unique:
        return visit_hits(visits, presentations, visit_key=visit_key, v_patient=v_patient, v_time=v_time,
                          p_patient=p_patient, p_time=p_time, window_minutes=window_minutes)
    # the test for one hit moves keys only; the wide rows join once, for the visits that pass
    hits = visit_hits(visits.select(visit_key, F.col(v_patient).alias("_v_patient"), v_time),
                      presentations.select(F.col(p_patient).alias("_p_patient"), F.col(p_time).alias("_p_time")),
                      visit_key=visit_key, v_patient="_v_patient", v_time=v_time, p_patient="_p_patient", p_time="_p_time",
                      window_minutes=window_minutes)
    w = Window.partitionBy(visit_key)
    one = (hits.withColumn("_n", F.count(F.lit(1)).over(w)).where(F.col("_n") == 1)
           .select(F.col(visit_key).alias("_v"), "_p_patient", "_p_time"))
    out = visits.join(one, visits[visit_key] == one["_v"])
    wide = presentations.withColumnsRenamed({p_patient: "_w_patient", p_time: "_w_time"})
    wide = wide.drop(*[c for c in wide.columns if c in set(visits.columns)])
    out = out.join(wide, (out["_p_patient"] == wide["_w_patient"]) & (out["_p_time"] == wide["_w_time"]))
    back = {"_w_time": p_time} | ({} if p_patient in visits.columns else {"_w_patient": p_patient})
    return out.drop("_v", "_p_patient", "_p_time", *([] if p_patient not in visits.columns else ["_w_patient"])).withColumnsRenamed(back)


def match_audit(visits: DataFrame, presentations: DataFrame, *, visit_key: str = "visit_id",
                v_time: str = "Datum_SEH", p_time: str = "anchor", **kw) -> DataFrame:
    """Per visit, the number of presentations found and their time range
    (visits without a hit report 0)."""
    hits = visit_hits(visits, presentations, visit_key=visit_key, v_time=v_time,
                      p_time=p_time, **kw)
    per = hits.groupBy(visit_key).agg(F.count(F.lit(1)).alias("hits"),
                                      F.min(p_time).alias("first_hit"),
                                      F.max(p_time).alias("last_hit"))
    return (visits.select(visit_key).join(per, on=visit_key, how="left")
            .withColumn("hits", F.coalesce(F.col("hits"), F.lit(0))))


def hit_histogram(audit: DataFrame) -> DataFrame:
    """Number of visits by number of hits."""
    return audit.groupBy("hits").agg(F.count(F.lit(1)).alias("visits"))


def validation_split(df: DataFrame, cohort: DataFrame, *, keys: Sequence[str] = ("nummer", "Datum_SEH"),
                     date_key: str | None = "Datum_SEH") -> tuple[DataFrame, DataFrame]:
    """J3 + J4 (+F5): (main, validation).  Validation = rows whose key pair is in
    the cohort; main = the rest (null-safe keys, as the source merges NaN keys).
    The cohort is a study list; whether it is broadcast is left to AQE's
    runtime size check."""
    keyed = df.withColumn(date_key, F.to_date(date_key)) if date_key else df
    c = cohort.select(*keys).distinct()
    cond = [keyed[k].eqNullSafe(c[k]) for k in keys]
    validation = keyed.join(c, on=cond, how="left_semi")
    main = keyed.join(c, on=cond, how="left_anti")
    return main, validation


def label_cohorts(df: DataFrame, cohort: DataFrame, *, keys: Sequence[str] = ("nummer", "Datum_SEH"),
                  date_key: str | None = "Datum_SEH", cohort_col: str = "cohort") -> DataFrame:
    """J3 + J4 + T5 in one pass: every row with its cohort, 'validation' or 'main', by one left join."""
    keyed = df.withColumn(date_key, F.to_date(date_key)) if date_key else df
    c = cohort.select(*[F.col(k).alias(f"_c_{k}") for k in keys]).distinct().withColumn("_in", F.lit(True))
    out = keyed.join(c, on=[keyed[k].eqNullSafe(c[f"_c_{k}"]) for k in keys], how="left")
    label = F.when(F.col("_in"), "validation").otherwise("main")
    return out.withColumn(cohort_col, label).drop("_in", *[f"_c_{k}" for k in keys])
