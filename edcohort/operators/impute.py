"""Imputation of a wide numeric table (I1-I4; dispatcher ``impute``).

Column statistics are one-row aggregates (the fitted parameters); the fill is a
single projection.  An unknown method raises instead of returning nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def impute_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """I1 (zero, zero_fill): NULL -> 0."""
    return df.fillna(0, subset=list(columns))


def column_medians(df: DataFrame, columns: Sequence[str], exact: bool = True,
                   accuracy: int = 100000) -> dict[str, float | None]:
    """Median of each column with linear interpolation between the two middle
    values.  ``exact`` uses value counts + distributed running totals (no
    column held in one task); otherwise ``percentile_approx``."""
    if exact:
        from .ordinal import exact_quantiles
        # all columns in one pass: long (column, value) rows, grouped quantile
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_val"))
                                    for c in columns]))
        long = df.select(cells.alias("_s")).select("_s._col", "_s._val")
        got = {r["_col"]: r["quantile"]
               for r in exact_quantiles(long, "_val", [0.5], group=["_col"]).collect()}
        return {c: got.get(c) for c in columns}
    row = df.agg(*[F.percentile_approx(F.col(c), 0.5, accuracy).alias(f"m{i}")
                   for i, c in enumerate(columns)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(columns)}


def impute_median(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """I2 (median): NULL -> the column median (all-NULL column stays NULL)."""
    med = column_medians(df, columns, exact=exact)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m).cast("double")) for c, m in med.items()})


def impute_indicator(df: DataFrame, columns: Sequence[str], suffix: str = "binary") -> DataFrame:
    """I3 (complex_zero): ``<c>binary`` = 1 when present; values untouched."""
    return df.withColumns({f"{c}{suffix}": F.col(c).isNotNull().cast("int") for c in columns})


def impute_indicator_nonzero(df: DataFrame, columns: Sequence[str], suffix: str = "binary") -> DataFrame:
    """I4 (complex_zero2): ``<c>binary`` = 1 when the value is not 0 (NULL -> 1)."""
    return df.withColumns({f"{c}{suffix}": F.coalesce(F.col(c) != 0, F.lit(True)).cast("int")
                           for c in columns})


METHODS = {
    "zero": impute_zero,
    "zero_fill": impute_zero,
    "median": impute_median,
    "complex_zero": impute_indicator,
    "complex_zero2": impute_indicator_nonzero,
}


def impute(df: DataFrame, columns: Sequence[str], method: str = "complex_zero") -> DataFrame:
    """Dispatcher over the imputation methods by name."""
    if method not in METHODS:
        raise ValueError(f"unknown imputation method {method!r}; expected one of {sorted(METHODS)}")
    return METHODS[method](df, columns)


def _chained(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """I7 (MICE): see ``chained``."""
    from .chained import impute_chained
    return impute_chained(df, columns)


METHODS["MICE"] = _chained
