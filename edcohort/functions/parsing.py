"""Parsing helpers: timestamps, dates, guarded numeric casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide which texts are numbers.
# A plain number with optional sign, decimals and exponent, blanks around it.
NUMERIC_PATTERN = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"
# First number inside a text such as "< 0.5" or ">35"; the sign is only part of
# the match when the number has a decimal point.
FIRST_NUMBER_PATTERN = r"[-+]?\d*\.\d+|\d+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_double(col) -> Column:
    """text -> double when the whole text is a number, else NULL.

    ``try_cast`` alone accepts '1d' and '1.0f'; the pattern guard rejects them."""
    c = _c(col)
    return F.when(c.rlike(NUMERIC_PATTERN), F.trim(c).try_cast("double"))


def first_number(col) -> Column:
    """first number found in the text, NULL when there is none."""
    hit = F.regexp_extract(_c(col), FIRST_NUMBER_PATTERN, 0)
    return F.when(hit != "", hit.try_cast("double"))


def parse_timestamp(col, fmt: str = "dd-MM-yyyy HH:mm") -> Column:
    """strict timestamp parse, invalid text (e.g. 31-02) -> NULL."""
    return F.try_to_timestamp(_c(col), F.lit(fmt)).cast("timestamp_ntz")


def parse_date(col, fmt: str = "dd-MM-yyyy") -> Column:
    """strict date parse, invalid text -> NULL."""
    return F.to_date(F.try_to_timestamp(_c(col), F.lit(fmt)))


# Fixed value: the clock time of an arrival without one.
DEFAULT_TIME = "07:00:00"


def date_and_time(date_col, time_col, default_time: str = DEFAULT_TIME) -> Column:
    """fill a missing clock time, join it to the date, parse with or without seconds."""
    text = F.concat_ws(" ", _c(date_col), F.coalesce(_c(time_col), F.lit(default_time)))
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")),
    ).cast("timestamp_ntz")


def clock_time(col) -> Column:
    """A clock text (with or without seconds) as a time stamp of day 1970-01-01; bad text -> NULL."""
    text = F.concat(F.lit("1970-01-01 "), F.trim(_c(col)))
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")),
                      F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm"))).cast("timestamp_ntz")


def leading_token_number(col, strip: str = "L") -> Column:
    """first blank-separated token, unit letter removed, to double (bad -> NULL)."""
    token = F.replace(F.split(_c(col), " ").getItem(0), F.lit(strip), F.lit(""))
    return safe_double(token)
