"""Clinical risk scores as column expressions.

A missing input behaves like a failed comparison (the rule gives no points),
which is what the row-wise source rules do with NaN; "truthy" flags treat a
missing value as 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clinical import RISK_MAPS, mean_arterial_pressure, score_to_risk

# Default column names of the visit registry.
COLS = {
    "age": "Geboortedatum",          # already converted to whole years
    "dementia": "Comorb_dementie_Psychiatrisch",
    "urea": "URESE",
    "resp": "AF_berekend",
    "syst": "RR_syst",
    "diast": "RR_diast",
    "housing": "Woonsituatie",
    "platelets": "TRC",
    "shock": "septischeshock",
    "metastasis": "metastase_of_chronische_ziekte_met_hoge_mortaliteit",
    "pulse": "Pols",
    "saturation": "Saturatie",
    "gcs": "GCS_afgeleid",
    "wd": "WD",
}


def _cols(overrides):
    c = dict(COLS)
    c.update(overrides or {})
    return {k: F.col(v) for k, v in c.items()}


def _pts(cond: Column, points: int) -> Column:
    return F.when(cond, F.lit(points)).otherwise(F.lit(0))


def _truthy(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)) != 0


def curb(**names) -> Column:
    """CURB-65."""
    c = _cols(names)
    bp = (F.when((c["diast"] < 60) & (c["diast"] > 0), 1)
          .when((c["syst"] < 90) & (c["syst"] > 0), 1).otherwise(0))
    return (_pts(c["dementia"] > 0, 1) + _pts(c["urea"] > 7, 1) + _pts(c["resp"] > 30, 1)
            + _pts(c["age"] >= 65, 1) + bp)


def meds(**names) -> Column:
    """R2: MEDS as used for the cross-validated scores (base 3 points)."""
    c = _cols(names)
    return (F.lit(3) + _pts(c["age"] >= 65, 3) + _pts(c["housing"].isin(2, 3), 2)
            + _pts(_truthy(c["dementia"]), 2) + _pts(c["platelets"] < 150, 3)
            + _pts(c["shock"] == 1, 3) + _pts(c["resp"] > 30, 3)
            + _pts(c["metastasis"] == 1, 6))


def rems(**names) -> Column:
    """REMS as used for the cross-validated scores (constant 0)."""
    return F.lit(0)


def abbmeds(**names) -> Column:
    """abbMEDS of the baseline table (base 0)."""
    c = _cols(names)
    return (_pts(c["metastasis"] == 1, 6) + _pts(c["resp"] > 20, 3) + _pts(c["shock"] == 1, 3)
            + _pts(c["platelets"] < 150, 3) + _pts(c["age"] >= 65, 3) + _pts(c["wd"] == 2, 2)
            + _pts(c["housing"].isin(2, 3), 2) + _pts(_truthy(c["dementia"]), 2))


def _bands(x: Column, uppers, points, last: int) -> Column:
    """First band whose exclusive upper bound exceeds x; NULL falls to ``last``."""
    out = None
    for u, p in zip(uppers, points):
        out = F.when(x < u, p) if out is None else out.when(x < u, p)
    return out.otherwise(last)


# mREMS bands (exclusive upper bounds -> points, then the top points).
MREMS_AGE = ((45, 54, 64, 74), (0, 2, 3, 5), 6)
MREMS_PULSE = ((39, 55, 70, 110, 139, 179), (4, 3, 2, 0, 2, 3), 4)
MREMS_RESP = ((5, 9, 12, 25, 35, 50), (4, 3, 1, 0, 1, 3), 4)
MREMS_MAP = ((49, 70, 110, 130, 160), (4, 2, 0, 2, 3), 4)
MREMS_SAT = ((75, 85, 90), (4, 3, 1), 0)          # a saturation of 0 scores 0
MREMS_GCS = ((13, 1), (11, 1), (8, 2), (5, 3))    # lower bounds (exclusive) -> points
MREMS_GCS_LOW = 4


def mrems(**names) -> Column:
    """mREMS of the baseline table."""
    c = _cols(names)
    age = _bands(c["age"], *MREMS_AGE)
    pulse = _bands(c["pulse"], *MREMS_PULSE)
    resp = _bands(c["resp"], *MREMS_RESP)
    mapv = _bands(mean_arterial_pressure(c["syst"], c["diast"]), *MREMS_MAP)
    sat = F.when(c["saturation"] == 0, 0).otherwise(_bands(c["saturation"], *MREMS_SAT))
    gcs = None
    for lower, p in MREMS_GCS:
        gcs = F.when(c["gcs"] > lower, p) if gcs is None else gcs.when(c["gcs"] > lower, p)
    gcs = gcs.otherwise(MREMS_GCS_LOW)
    return age + pulse + resp + mapv + sat + gcs + _pts(_truthy(c["dementia"]), 1)


RAW_SCORES = {"CURB": curb, "REMS": rems, "MEDS": meds}


def risk_score(score: str, **names) -> Column:
    """Raw score by name, mapped to a risk with F18."""
    if score not in RAW_SCORES:
        raise ValueError(f"unknown score {score!r}; expected one of {sorted(RAW_SCORES)}")
    return score_to_risk(RAW_SCORES[score](**names), RISK_MAPS[score])
