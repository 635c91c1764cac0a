"""Entry 2 (derive): processed table -> data models 1/2/3 with outcome, split main/validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clinical import age_years, hour_fraction, select_outcome
from ..functions.parsing import clock_time, leading_token_number
from ..functions.registry import FEATURES
from ..operators.cohort import validation_split


def data_model(df: DataFrame, model: int, out: int, *, as_of: str,
               lab_columns: Sequence[str], key: str = "case_id",
               features: Sequence[Sequence[str]] = FEATURES, arrival: str = "Datum_SEH",
               birth: str = "Geboortedatum", arrival_time: str = "Uur_Binnenkomst_SEH",
               oxygen: str = "zuurstoftherapie", outcome_days: int = 31) -> DataFrame:
    """P8 + F3 + F4 + F8 + F9 + F14: the columns of data model ``model`` (1, 2 or 3)
    with label ``y_var`` for outcome ``out``; the presentation key is kept.

    Model 1 = y_var + base + lab columns; model 2 adds history and drugs;
    model 3 adds vital signs (oxygen text parsed to litres).  Missing numbers
    become 0.  ``arrival_time`` is derived from ``arrival`` when absent.
    """
    if model not in (1, 2, 3):
        raise ValueError(f"unknown data model {model!r}")
    base, hist, vital = features
    d = df
    if arrival_time not in d.columns:
        d = d.withColumn(arrival_time, F.col(arrival))
    d = select_outcome(d, out, arrival=arrival, days=outcome_days)
    text = isinstance(d.schema[arrival_time].dataType, T.StringType)
    clock = clock_time(arrival_time) if text else F.col(arrival_time).cast("timestamp_ntz")
    d = d.withColumn(birth, age_years(birth, as_of)).withColumn(arrival_time, hour_fraction(clock))
    cols = [key, "y_var", *base, *lab_columns]
    if model >= 2:
        cols += list(hist)
    if model >= 3:
        if oxygen in vital:
            d = d.withColumn(oxygen, leading_token_number(oxygen))
        cols += list(vital)
    seen, ordered = set(), []
    for c in cols:
        if c not in seen:
            seen.add(c)
            ordered.append(c)
    d = d.select(*ordered)
    numeric = [f.name for f in d.schema.fields
               if isinstance(f.dataType, T.NumericType) and f.name != key]
    return d.fillna(0, subset=numeric)


def export_splits(model_df: DataFrame, cohort: DataFrame, *, keys=("nummer", "Datum_SEH"),
                  drop_keys: bool = False) -> dict[str, DataFrame]:
    """F5 + J3 + J4: {'main', 'validation', 'full'} frames of one data model."""
    main, validation = validation_split(model_df, cohort, keys=keys, date_key="Datum_SEH")
    full = model_df.withColumn("Datum_SEH", F.to_date("Datum_SEH"))
    out = {"main": main, "validation": validation, "full": full}
    if drop_keys:
        out = {k: v.drop(*keys) for k, v in out.items()}
    return out


def derive_and_export(processed: DataFrame, cohort: DataFrame, root: str, *, models=(1, 2, 3),
                      out: int = 3, as_of: str, lab_columns: Sequence[str], key: str = "case_id",
                      features: Sequence[Sequence[str]] = FEATURES, split: bool = True) -> int:
    """Entry 2: every requested data model of ``processed`` written as a new
    version of the dataset at ``root``, split into main and validation (or one
    'full' split); study keys are dropped on export.  The version becomes
    visible when all of it is written."""
    from ..sources.datasets import claim_version, commit_version, write_data_model
    version = claim_version(processed.sparkSession, root)
    for m in models:
        dm = data_model(processed, m, out, as_of=as_of, lab_columns=lab_columns, key=key,
                        features=features)
        parts = export_splits(dm, cohort, drop_keys=True)
        chosen = {k: parts[k] for k in (("main", "validation") if split else ("full",))}
        write_data_model(chosen, root, version=version, model=m, out=out)
    commit_version(processed.sparkSession, root, version)
    return version
