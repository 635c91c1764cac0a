"""Laboratory result normalisation (F10, F11, P5 lists).

A raw result is text.  It becomes a typed triple:
``num`` (double), ``txt`` (string, categorical codes only) and ``marker``
(1 when the value is present but not a number, e.g. free text or an empty
result).  The marker is later replaced by the code's mean (F15).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parsing import first_number, safe_double

# Archive and comment test codes that are never analysed.
DENY_CODES = (
    "ARCHSE", "ARCHFL", "ARCHDA", "ARCHUR", "ARCHZE", "ATLAS", "TRE", "STOL",
    "CARDIOPL", "CARDIOSE", "ALLSTR", "ARCHDA2", "ARCHEP", "ARCHZE2", "ASFAC",
    "ASTEKST", "BSPTX", "CYTO", "EXTRA1", "MATPOC", "WOPM",
)

# Codes whose result is a category (text kept, later one-hot encoded).
CATEGORICAL_CODES = (
    "ASTYP", "ALLIND", "ASNMA", "BG", "BRC", "BGRH", "RH", "DIF", "IRA", "KETUP",
    "GRTUP", "SLEUUP", "UGLUP", "SERYUP", "NITUP", "PROUP", "BACUP", "MREB",
    "Afdeling", "Geslacht", "ISE", "LSE", "HSE", "LASP", "RHFK",
)

# The code with a three-way text mapping and its "negative" texts.
MAPPED_CODE = "MREB"
MAPPED_NEGATIVE_TEXTS = ("Oke", "Niet afwijkend", "Negatief")
MAPPED_POSITIVE_TEXT = "Positief"
MAPPED_NEGATIVE = "Negatief"
MAPPED_OTHER = "Bijzonder"

# Codes whose presence alone counts as 1.
PRESENCE_CODES = ("DAT", "SEDUP", "DYSEUP", "KP01", "KP02", "LASLI", "POIK")
# Codes scored as the number of '+' characters.
PLUS_COUNT_CODES = ("ATYL", "FRAG", "TOXK")


def plus_count(col) -> Column:
    """number of '+' characters."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.length(c) - F.length(F.replace(c, F.lit("+"), F.lit("")))).cast("double")


def normalise_result(code: str = "code", result: str = "result") -> dict[str, Column]:
    """ordered rule list on (code, result) -> {'num', 'txt', 'marker'}.

    Rules, first match wins: empty result -> marker; categorical code -> text
    (three-way mapping for the mapped code); presence codes -> 1; plus-count
    codes -> number of '+'; a '<' or '>' in the text -> first number in it;
    otherwise a whole-text number, else marker.
    """
    c, r = F.col(code), F.col(result)
    is_cat = c.isin(*CATEGORICAL_CODES)
    txt = (
        F.when(r.isNull(), None)
        .when(c == MAPPED_CODE,
              F.when(r.isin(*MAPPED_NEGATIVE_TEXTS), F.lit(MAPPED_NEGATIVE))
              .when(r == MAPPED_POSITIVE_TEXT, F.lit(MAPPED_POSITIVE_TEXT))
              .otherwise(F.lit(MAPPED_OTHER)))
        .when(is_cat, r)
    )
    num = (
        F.when(r.isNull() | is_cat, F.lit(None).cast("double"))
        .when(c.isin(*PRESENCE_CODES), F.lit(1.0))
        .when(c.isin(*PLUS_COUNT_CODES), plus_count(r))
        .when(r.contains("<") | r.contains(">"), first_number(r))
        .otherwise(safe_double(r))
    )
    missing = r.rlike(r"(?i)^\s*[+-]?nan\s*$")   # reads as a missing number, not as free text
    marker = F.when(r.isNull(), 1).when(is_cat | missing, 0).when(num.isNull(), 1).otherwise(0)
    return {"num": num, "txt": txt, "marker": marker}
