"""Clinical derivations on visit rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86400
# Fixed value: days per year used for whole-year ages.
DAYS_PER_YEAR = 365.2425


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def age_years(birth, as_of) -> Column:
    """whole years between a birth date and ``as_of`` (a date literal or column).

    ``as_of`` is required: the age depends on the run date, so it must be stated."""
    ref = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return F.floor(F.datediff(ref, _c(birth)) / F.lit(DAYS_PER_YEAR))


def hour_fraction(ts, corrected: bool = False) -> Column:
    """arrival clock time as a number.

    The default keeps the source formula ``(hour + minute) / 60``;
    ``corrected=True`` gives ``hour + minute / 60``."""
    h, m = F.hour(_c(ts)), F.minute(_c(ts))
    return (h + m / F.lit(60.0)) if corrected else (h + m) / F.lit(60.0)


def whole_days_between(start_ts, end) -> Column:
    """Floor of the day difference (a negative part day floors to -1)."""
    end_ts = _c(end).cast("timestamp_ntz")
    secs = F.timestamp_diff("SECOND", _c(start_ts).cast("timestamp_ntz"), end_ts)
    return F.floor(secs / F.lit(float(DAY_SECONDS)))


def outcome_within(death, arrival, days: int = 31) -> Column:
    """1 when death falls within [-1, days] whole days of arrival, else 0."""
    d = whole_days_between(arrival, death)
    return F.when(_c(death).isNull(), 0).when(d.between(-1, days), 1).otherwise(0)


def days_to_death(death, arrival, days: int = 31, alive: int = 1000) -> Column:
    """days from arrival to death when in [-1, days), else ``alive``."""
    d = whole_days_between(arrival, death)
    return (F.when(_c(death).isNull(), alive)
            .when((d >= -1) & (d < days), d).otherwise(alive).cast("int"))


# The three outcome columns and their selector numbers.
OUTCOME_COLUMNS = ("septischeshock", "Sterfte_in_ziekenhuis", "Datum_overlijden")


def select_outcome(df, out: int, *, arrival: str = "Datum_SEH", days: int = 31,
                   outcome_columns=OUTCOME_COLUMNS, label: str = "y_var"):
    """F8: add the label for outcome 1 (shock), 2 (in-house death) or
    3 (death within ``days``) and drop the three raw outcome columns."""
    shock, inhouse, death = outcome_columns
    if out == 1:
        y = F.col(shock).cast("int")
    elif out == 2:
        y = F.col(inhouse).cast("int")
    elif out == 3:
        y = outcome_within(death, arrival, days)
    else:
        raise ValueError(f"unknown outcome {out!r}; expected 1, 2 or 3")
    return df.withColumn(label, y).drop(*outcome_columns)


def mean_arterial_pressure(syst="RR_syst", diast="RR_diast") -> Column:
    """(systolic + 2 * diastolic) / 3."""
    return (_c(syst) + 2 * _c(diast)) / F.lit(3.0)


# Score -> mortality risk maps (inclusive score ranges).
CURB_RISK = ((0, 1, 0.015), (2, 2, 0.092), (3, 5, 0.22))
MEDS_RISK = ((0, 4, 0.01), (5, 7, 0.032), (8, 11, 0.080), (12, 15, 0.18), (16, 26, 0.42))
REMS_RISK = ()
RISK_MAPS = {"CURB": CURB_RISK, "REMS": REMS_RISK, "MEDS": MEDS_RISK}


def score_to_risk(score, risk_map) -> Column:
    """map a whole-number score to a risk; scores outside the map are kept."""
    s = _c(score)
    out = None
    for lo, hi, risk in risk_map:
        cond = s.between(lo, hi)
        out = F.when(cond, F.lit(risk)) if out is None else out.when(cond, F.lit(risk))
    return s.cast("double") if out is None else out.otherwise(s.cast("double"))


# Three-tier abbMEDS risk (upper bounds exclusive).
ABBMEDS_TIERS = ((5, 0.016), (13, 0.234))
ABBMEDS_TOP_RISK = 0.59


def abbmeds_risk(score) -> Column:
    """three-tier risk for abbMEDS."""
    s = _c(score)
    (b1, r1), (b2, r2) = ABBMEDS_TIERS
    return F.when(s < b1, r1).when(s < b2, r2).otherwise(ABBMEDS_TOP_RISK)


def estimate_text(est, low, high, digits: int = 3) -> Column:
    """'estimate (low-high)' text."""
    f = f"%.{digits}f"
    return F.format_string(f"{f} ({f}-{f})", _c(est), _c(low), _c(high))
