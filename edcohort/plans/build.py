"""Entry 1 (build): lab extract + visit table -> processed presentation table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.audit import StepAudit
from ..operators.cohort import match_visits
from ..operators.presentations import build_presentations
from ..session import reliable_checkpoint
from ..sources.datasets import write_processed
from ..sources.extracts import read_lab_extract, read_visits


def build_processed_table(lab: DataFrame, visits: DataFrame, *, fraction: float = 0.80, snap_minutes: int = 120,
                          gap_minutes: int = 1440, min_present: int = 2, window_minutes: int = 900,
                          visit_key: str = "visit_id", v_patient: str = "nummer", v_time: str = "Datum_SEH",
                          impute: str | None = None, fill_zero: bool = True, pilot: bool = False, audit=None) -> DataFrame:
    """Presentations built from ``lab`` matched to ``visits``: one row per visit
    with exactly one presentation within ``window_minutes`` after arrival.
    ``impute``, ``fill_zero`` and ``pilot`` are the entry's options (see ``build_presentations``); an ``audit``
    records the rows and columns of each step (A12).  The wide table is kept once (checkpoint): the match reads its
    keys, then its rows."""
    wide = reliable_checkpoint(build_presentations(lab, fraction=fraction, snap_minutes=snap_minutes, gap_minutes=gap_minutes,
                                                   min_present=min_present,
                                                   impute=impute, fill_zero=fill_zero, pilot=pilot, audit=audit))
    if audit is not None:
        audit.step("presentations", wide.count(), wide)
        audit.step("visits", visits.count(), visits)
    return match_visits(visits, wide, visit_key=visit_key, v_patient=v_patient, v_time=v_time,
                        p_patient="patient", p_time="anchor", window_minutes=window_minutes)


def build_from_files(spark: SparkSession, lab_paths: Sequence[str], visit_path: str, out_root: str, *,
                     numeric: Sequence[str] = (), **options) -> int:
    """Entry 1 from files: yearly lab extracts and the visit table to a new version of the
    processed dataset at ``out_root``, with the counts of its steps; returns the version."""
    audit = StepAudit()
    lab = read_lab_extract(spark, lab_paths)
    visits = read_visits(spark, visit_path, numeric=numeric)
    return write_processed(build_processed_table(lab, visits, audit=audit, **options), out_root, audit=audit)
